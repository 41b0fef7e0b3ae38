"""Structured Streaming versions of the loads and rollups.

All jobs take landing rows as a stream and run with `availableNow`, so one run
handles everything that has arrived and then stops. Progress lives in the
query's checkpoint, which plays the part of the batch watermark. Rollups are
sums per micro-batch that are added up when they are read, so a hot user is
pre-aggregated in every batch, no state grows with time, and rows of any age
count.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lumenmart.functions import date_key
from lumenmart.operators.facts import flag, hits
from lumenmart.operators.sinks import Loaded, append_events, delete_insert_table, is_folder, logged_batches
from lumenmart.operators.slots import inactivity_sessions, slot_of
from lumenmart.operators.spans import FANOUT, Span, Spans
from lumenmart.session import shared_dir
from lumenmart.sources.contract import CORE_ACTIONS, RATING_EVENTS


def read_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """Stream of a table folder, or of a single file (streams watch folders only)."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if is_folder(spark, path):
        return reader.parquet(path)
    folder, name = path.rsplit("/", 1)
    return reader.option("pathGlobFilter", name).parquet(folder)


def daily_sessions(events: DataFrame) -> DataFrame:
    """Sums per (day, user, session): what a batch adds to the daily activity."""
    name = F.col("event_name")
    return events.groupBy(date_key("timestamp").alias("date_sk"), "user_id", "session_id").agg(
        F.count("*").alias("events_count"),
        hits(name.isin(*RATING_EVENTS)).alias("ratings"),
        hits(name == "material_downloaded").alias("downloads"),
        hits(name == "material_uploaded").alias("uploads"),
        flag(name.isin(*CORE_ACTIONS)).alias("core"),
    )


def daily_activity(per_session: DataFrame) -> DataFrame:
    """Daily activity from the sums of all batches; a session of several batches counts once."""
    return added_sessions(per_session).groupBy("date_sk", "user_id").agg(
        F.count("session_id").alias("session_count"),
        F.sum("events_count").alias("events_count"),
        F.sum("ratings").alias("ratings_submitted_count"),
        F.sum("downloads").alias("downloads_count"),
        F.sum("uploads").alias("uploads_count"),
        F.max("core").alias("has_completed_core_action"),
    )


def slot_sums(events: DataFrame, gap_seconds: int = 1800) -> DataFrame:
    """First, last and number of a user's events in each slot as wide as the gap (see inactivity_sessions)."""
    return events.groupBy("user_id", slot_of(F.col("timestamp"), gap_seconds).alias("slot")).agg(
        F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"), F.count("*").alias("n")
    )


def sessions_of_slots(sums: DataFrame, gap_seconds: int = 1800) -> DataFrame:
    """Inactivity sessions from the slot sums of all batches."""
    ends = sums.select("user_id", F.explode(F.array("first_ts", "last_ts")).alias("timestamp"), F.lit(0).cast("bigint").alias("n"))
    counted = ends.unionByName(sums.select("user_id", F.col("first_ts").alias("timestamp"), "n"))
    sessions = inactivity_sessions(counted, "user_id", "timestamp", gap_seconds, {"events": F.col("n")})
    return sessions.select("user_id", F.col("events").alias("events_count"), "session_start", "session_end")


def user_days(events: DataFrame) -> DataFrame:
    return events.select("user_id", F.to_date("timestamp").alias("activity_date")).distinct()


def added_sessions(sums: DataFrame) -> DataFrame:
    """Several batches' `daily_sessions` as one."""
    added = [F.sum(c).alias(c) for c in ("events_count", "ratings", "downloads", "uploads")]
    return sums.groupBy("date_sk", "user_id", "session_id").agg(*added, F.max("core").alias("core"))


def added_slots(sums: DataFrame) -> DataFrame:
    """Several batches' `slot_sums` as one."""
    return sums.groupBy("user_id", "slot").agg(F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.sum("n").alias("n"))


#: What makes one row of the rows that several batches leave for a key.
ADDED: dict[Callable[[DataFrame], DataFrame], Callable[[DataFrame], DataFrame]] = {
    daily_sessions: added_sessions,
    slot_sums: added_slots,
    user_days: DataFrame.distinct,
}


# --- running ---------------------------------------------------------------------


def run_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Hand each micro-batch to an idempotent function, and stop at the end."""
    q = (
        stream.writeStream.foreachBatch(handle)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return q


def run_append(raw: DataFrame, path: str, checkpoint: str, log: str | None = None, dag_id: str = "load_events") -> StreamingQuery:
    """Exactly-once ingest: each batch is appended without the ids already stored,
    so a batch that is replayed after a failure adds nothing twice. With `log`,
    every batch leaves an audit row there."""
    spark = raw.sparkSession

    def load(batch: DataFrame, _: int) -> Loaded:
        return append_events(spark, path, batch, "id", "timestamp")

    handle = logged_batches(spark, log, dag_id, load) if log else lambda batch, n: load(batch, n) and None
    return run_batches(raw, handle, checkpoint)


def run_partials(raw: DataFrame, path: str, checkpoint: str, shape: Callable[[DataFrame], DataFrame], fanout: int = FANOUT) -> StreamingQuery:
    """Each batch leaves its own sums in a folder of its number, which a replay
    overwrites. Nothing is kept as state and nothing is late: readers add up
    the sums of all batches. Folders of one size are added up into greater ones,
    so their number grows with the logarithm of the batches."""
    spans = Spans(raw.sparkSession, path, fanout)

    def load(batch: DataFrame, number: int) -> None:
        spans.put(number, lambda _, folder: shape(batch).write.mode("overwrite").parquet(folder))
        spans.merge(lambda group, _, folder: add_up(spans, group, folder, shape))

    return run_batches(raw, load, checkpoint)


def add_up(spans: Spans, group: list[Span], folder: str, shape: Callable[[DataFrame], DataFrame]) -> None:
    sums = spans.spark.read.parquet(*(spans.path(s) for s in group))
    ADDED[shape](sums).write.mode("overwrite").parquet(folder)


def run_delete_insert(
    raw: DataFrame, path: str, checkpoint: str, key: str, ts: str, shape: Callable[[DataFrame], DataFrame]
) -> StreamingQuery:
    """Each batch replaces the rows that have its keys."""
    spark = raw.sparkSession

    def load(batch: DataFrame, _: int) -> None:
        delete_insert_table(spark, path, shape(batch), key, ts)

    return run_batches(raw, load, checkpoint)


def partials(stream: DataFrame, name: str, shape: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run a stream into sums of its batches in the shared folder and read them back."""
    root = shared_dir(stream.sparkSession, name)
    run_partials(stream, f"{root}/data", f"{root}/checkpoint", shape)
    return Spans(stream.sparkSession, f"{root}/data").read()
