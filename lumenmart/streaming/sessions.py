"""Sessions as they close, in event time.

A watermark follows the newest event by a delay. A session is closed, and
written once, when the watermark has passed its last event by the gap; until
then it is state, kept in RocksDB, so state holds open sessions only, however
long the stream runs. A user's events of one task are merged before the
shuffle, so a hot user sends a session per task rather than its events.

An event below the watermark may belong to a session that was written already.
Such rows are taken out before, by the same watermark computed from the batches
before their own, and go to an output of their own instead of being dropped
without a trace. What was closed is therefore exactly what a batch job makes of
the rows in time, up to the watermark.

Most sessions of a large batch, as when a stream catches up, begin and end
within it: they begin more than a gap after all events of the batches before,
so state holds none that they could continue, and the watermark after the batch
is past them, so no later event can. They are written at once. Only the others
go through the state, which costs far more for each session.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lumenmart.operators.slots import slot_of
from lumenmart.operators.spans import Spans
from lumenmart.streaming.jobs import run_batches

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EVENT = "user_id bigint, event_ts timestamp"
CLOSED = "user_id bigint, session_start timestamp, session_end timestamp, events_count bigint"
#: Of a batch's rows in time: sessions that it closes, and slots of the others.
PIECES = f"{CLOSED}, batch bigint, open boolean"


class SessionStream:
    """Folders below ``root``: ``late`` rows by batch, ``in_time`` sessions by batch, with slots of those that stay
    open, ``closed`` sessions that were open, checkpoints, newest times.

    Rows without a user or a time are in no session and no output.
    """

    def __init__(self, spark: SparkSession, root: str, delay_seconds: int, gap_seconds: int = 1800):
        self.spark, self.root = spark, root.rstrip("/")
        self.delay, self.gap = delay_seconds, gap_seconds
        self.newest = Spans(spark, f"{self.root}/newest")

    def run(self, raw: DataFrame) -> StreamingQuery:
        """Handle all that has arrived: first the rows by their time, then the sessions. Returns the query of the sessions."""
        run_batches(raw, self._split, f"{self.root}/checkpoints/split")
        with rocksdb(self.spark):
            q = (
                self._closed(self.spark.readStream.schema(CLOSED).option("recursiveFileLookup", "true").parquet(f"{self.root}/in_time/batch=*/open=true"))
                .writeStream.format("parquet")
                .outputMode("append")
                .option("path", f"{self.root}/closed")
                .option("checkpointLocation", f"{self.root}/checkpoints/sessions")
                .trigger(availableNow=True)
                .start()
            )
            q.awaitTermination()
        return q

    def closed(self) -> DataFrame:
        rows = self.spark.read.schema(CLOSED).parquet(f"{self.root}/closed")
        at_once = self.spark.read.schema(PIECES).parquet(f"{self.root}/in_time").where("not open")
        rows = rows.unionByName(at_once.select(*rows.columns))
        return rows.select("user_id", "events_count", *(F.col(c).cast("timestamp_ntz").alias(c) for c in ("session_start", "session_end")))

    def late(self) -> DataFrame:
        rows = self.spark.read.option("recursiveFileLookup", "true").schema(EVENT).parquet(f"{self.root}/late")
        return rows.select("user_id", F.col("event_ts").cast("timestamp_ntz").alias("event_ts"))

    def _split(self, batch: DataFrame, number: int) -> None:
        """Rows below the watermark of the batches before are late. A replay overwrites what the batch left."""
        rows = batch.select(F.col("user_id").cast("bigint"), F.col("timestamp").cast("timestamp").alias("event_ts")).where("user_id is not null and event_ts is not null")
        seen = rows.agg(F.lit(number).cast("bigint").alias("number"), F.max("event_ts").alias("newest"))
        self.newest.put(number, lambda _, folder: seen.write.mode("overwrite").parquet(folder))
        # numbers stay apart, or a batch that is replayed would see its own times
        self.newest.merge(lambda group, _, folder: self.spark.read.parquet(*map(self.newest.path, group)).coalesce(1).write.mode("overwrite").parquet(folder))
        times = self.newest.read().where(F.col("number") <= number)
        mark = times.agg(F.max(F.when(F.col("number") < number, F.col("newest"))).alias("before"), F.max("newest").alias("after")).first()
        before, after = (F.lit(t).cast("timestamp") for t in (mark.before, mark.after))
        is_late = F.coalesce(F.col("event_ts") < before - F.make_dt_interval(secs=F.lit(self.delay)), F.lit(False))
        rows.where(is_late).write.mode("overwrite").parquet(f"{self.root}/late/batch={number}")
        pieces = self._pieces(rows.where(~is_late), before, after)
        pieces.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("open").parquet(f"{self.root}/in_time/batch={number}")

    def _pieces(self, rows: DataFrame, before: Column, after: Column) -> DataFrame:
        """Sessions that no other batch has a part in, and slots as wide as the gap (see `inactivity_sessions`) of all others."""
        gap = F.make_dt_interval(secs=F.lit(self.gap))
        slots = rows.groupBy("user_id", slot_of(F.col("event_ts"), self.gap).alias("slot")).agg(
            F.min("event_ts").alias("lo"), F.max("event_ts").alias("hi"), F.count("*").alias("n")
        )
        w = Window.partitionBy("user_id").orderBy("slot")
        opens = F.when(F.col("lo") <= F.lag("hi").over(w) + gap, 0).otherwise(1)
        slots = slots.withColumn("opens", opens).withColumn("number", F.sum("opens").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        whole = Window.partitionBy("user_id", "number")
        begins, ends = F.min("lo").over(whole), F.max("hi").over(whole)
        # the state's watermark has milliseconds
        passed = F.date_trunc("MILLISECOND", after) - F.make_dt_interval(secs=F.lit(self.delay))
        alone = F.coalesce(begins > before + gap, F.lit(True)) & (ends + gap < passed)
        pieces = slots.withColumn("open", ~alone).groupBy("user_id", "number", "open", F.when(F.col("open"), F.col("slot")))
        summed = pieces.agg(F.min("lo").alias("session_start"), F.max("hi").alias("session_end"), F.sum("n").alias("events_count"))
        return summed.select("user_id", "session_start", "session_end", "events_count", "open")

    def _closed(self, slots: DataFrame) -> DataFrame:
        # first and last event of a slot are never further apart than the gap
        first = F.struct(F.col("session_start").alias("event_ts"), F.col("events_count").alias("n"))
        last = F.struct(F.col("session_end").alias("event_ts"), F.lit(0).cast("bigint").alias("n"))
        ends = F.when(F.col("session_start") == F.col("session_end"), F.array(first)).otherwise(F.array(first, last))
        events = slots.select("user_id", F.inline(ends))
        # a window ends a gap after its last event, and an event at just that time still belongs to it
        window = F.session_window("event_ts", f"{self.gap} seconds")
        sessions = events.withWatermark("event_ts", f"{self.delay} seconds").groupBy("user_id", window.alias("w")).agg(
            F.sum("n").alias("events_count"), F.min("event_ts").alias("session_start"), F.max("event_ts").alias("session_end")
        )
        return sessions.select("user_id", "session_start", "session_end", "events_count")


@contextmanager
def rocksdb(spark: SparkSession):
    """State in RocksDB: on the executors' disks, and only changes go to the checkpoint."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(key, before)
