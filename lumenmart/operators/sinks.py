"""Loads: idempotent append, upsert, delete+insert, month routing, watermarks,
run log. Parquet has no MERGE, so each load writes whole month folders."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenmart.functions import month_key, surrogate_key
from lumenmart.operators import files
from lumenmart.operators.key_index import KeyIndex
from lumenmart.sources.contract import EPOCH, PIPELINE_RUNS

MONTH = "event_month"
NULL_MONTH = "__HIVE_DEFAULT_PARTITION__"


# --- pure DataFrame semantics ---------------------------------------------------


def first_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key, the first by `order`. An aggregate rather than a window:
    copies of one key are already reduced on the map side."""
    rest = [c for c in df.columns if c != key]
    row = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(key).agg(row).select(key, "_row.*").select(*df.columns)


def insert_if_absent(existing: DataFrame, batch: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Rows of the batch that an insert with `on conflict do nothing` would add."""
    return first_per_key(batch, key, order).join(existing.select(key), key, "left_anti").select(*batch.columns)


def upsert(existing: DataFrame, batch: DataFrame, key: str, overwrite: list[str]) -> DataFrame:
    """Table after an upsert that changes only `overwrite` on existing keys.

    Repeated keys of a batch count once, or the join would repeat their rows.
    """
    batch = first_per_key(batch, key, [c for c in batch.columns if c != key])
    new = batch.select(F.col(key), F.struct(*batch.columns).alias("new"))
    old = existing.select(F.col(key), F.struct(*existing.columns).alias("old"))
    both = old.join(new, key, "full")

    def value(c: str) -> Column:
        if c == key:
            return F.col(key)
        seen = F.col(f"old.{c}") if c not in overwrite else F.coalesce(F.col(f"new.{c}"), F.col(f"old.{c}"))
        return F.when(F.col("old").isNull(), F.col(f"new.{c}")).otherwise(seen).alias(c)

    return both.select(*[value(c) for c in existing.columns])


def delete_insert(existing: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Table after deleting the batch's keys and inserting the batch."""
    return existing.join(batch.select(key), key, "left_anti").select(*batch.columns).unionByName(batch)


# --- stored tables ----------------------------------------------------------------


def table_exists(spark: SparkSession, path: str) -> bool:
    """Also brings back the previous table when a swap was cut short."""
    path = path.rstrip("/")
    fs, p = files.hadoop(spark, path)
    _, old = files.hadoop(spark, f"{path}__old")
    return fs.exists(p) or (fs.exists(old) and fs.rename(old, p))


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, p = files.hadoop(spark, path)
    return fs.getFileStatus(p).isDirectory()


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "false").parquet(path)


def write_months(df: DataFrame, path: str, ts: str, sort_by: list[str], mode: str = "append") -> None:
    """Write month folders.

    The rebalance hint lets Spark size the output by volume: a large month is
    split over many tasks and a small batch ends in few files. Rows are sorted
    in each file, so that row groups can be skipped by key.
    """
    out = with_month(df, ts).hint("rebalance", F.col(MONTH)).sortWithinPartitions(MONTH, *sort_by)
    out.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)


def with_month(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn(MONTH, month_key(ts))


def months_of(df: DataFrame) -> list[str]:
    """Distinct months: one short text per calendar month, so safe to collect."""
    return sorted(NULL_MONTH if r[0] is None else r[0] for r in df.select(MONTH).distinct().collect())


def between_months(df: DataFrame, first: str, last: str) -> DataFrame:
    return df.where(F.col(MONTH).between(first, last))


def only_months(df: DataFrame, months: list[str]) -> DataFrame:
    named = [m for m in months if m != NULL_MONTH]
    keep = F.col(MONTH).isin(*named) if named else F.lit(False)
    return df.where(keep | F.col(MONTH).isNull()) if NULL_MONTH in months else df.where(keep)


@dataclass(frozen=True)
class Loaded:
    extracted: int
    added: int
    newest: datetime | None
    months: list[str]
    newest_arrival: datetime | None = None


def append_events(spark: SparkSession, path: str, batch: DataFrame, key: str, ts: str, arrival: str | None = None) -> Loaded:
    """Idempotent append of the rows whose key is not stored yet, in whatever month.

    The batch goes to a staging folder first, so its size, its newest times, its
    months and the rows to add all come from one reading of the source. Which
    keys are stored is asked of the table's key index, so the table itself is
    not read. The rows to add stay in a folder of their own until the table and
    the index have them; a load that was cut short is completed by the next
    one. A table takes one load at a time.
    """
    path = path.rstrip("/")
    index = KeyIndex(spark, path, key)
    _complete_appends(spark, path, key, ts, index)
    run = uuid.uuid4().hex[:12]
    stage, fresh = f"{path}__stage-{run}", f"{path}__added-{run}"
    with_month(batch, ts).write.mode("overwrite").parquet(stage)
    staged = read_table(spark, stage)
    size = staged.agg(F.count("*").alias("n"), F.max(ts).alias("newest"), F.max(arrival or ts).alias("arrival")).first()
    months = months_of(staged) if size["n"] else []
    stored = table_exists(spark, path)
    if stored and not index.exists():  # written before there was an index
        index.add(read_table(spark, path))
    known = index.holding(staged) if months and stored else staged.select(key).where("false")
    order = [ts, *[c for c in batch.columns if c not in (key, ts)]]
    insert_if_absent(known, staged.drop(MONTH), key, order).write.mode("overwrite").parquet(fresh)
    new = read_table(spark, fresh)
    n = new.count()
    if n:
        write_months(new, path, ts, [ts, key])
        index.add(new, n)
    elif not stored:  # a table without rows still has columns
        new.write.parquet(f"{path}/{MONTH}={NULL_MONTH}")
        index.add(new, 0)
    drop_table(spark, fresh)
    drop_table(spark, stage)
    return Loaded(size["n"], n, size["newest"], months, size["arrival"] if arrival else None)


def _complete_appends(spark: SparkSession, path: str, key: str, ts: str, index: KeyIndex) -> None:
    """Rows that a load had found new but may not have stored: the table gets
    those it lacks, and the index all of them. Of the table only the months of
    these rows are read, since a row is stored in the month of its time."""
    folder, name = path.rsplit("/", 1)
    for left in files.children(spark, folder):
        if left.startswith(f"{name}__added-") and files.complete(spark, f"{folder}/{left}"):
            rows = with_month(read_table(spark, f"{folder}/{left}"), ts)
            lacking = rows
            if table_exists(spark, path):
                there = only_months(read_table(spark, path), months_of(rows)).select(key, ts)
                same = F.col(f"r.{key}").eqNullSafe(F.col(f"t.{key}")) & F.col(f"r.{ts}").eqNullSafe(F.col(f"t.{ts}"))
                lacking = rows.alias("r").join(there.alias("t"), same, "left_anti")
            again = f"{folder}/{name}__stage-{uuid.uuid4().hex[:12]}"
            lacking.drop(MONTH).write.parquet(again)
            write_months(read_table(spark, again), path, ts, [ts, key])
            drop_table(spark, again)
            index.add(rows)
        if left.startswith((f"{name}__added-", f"{name}__stage-")):
            drop_table(spark, f"{folder}/{left}")


def delete_insert_table(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    key: str,
    ts: str,
    sort_by: list[str] | None = None,
    keys_may_move: bool = True,
) -> None:
    """Delete+insert on a month-partitioned table, touched months only.

    Touched are the batch's months and every month that holds one of its keys
    (a corrected event may have moved). A month left without rows is dropped,
    since a dynamic overwrite alone would keep its old files. Where a key always
    keeps its month, `keys_may_move=False` saves the search through the table.

    The batch is read once, into a folder of its own. The months as they will
    be are complete in another before the table is touched, so a run that was
    cut short while it put them in place is completed by the next one.
    """
    path = path.rstrip("/")
    incoming, stage = f"{path}__incoming", f"{path}__months"
    sort_by = sort_by or [ts, key]
    _put_in_place(spark, path, ts, sort_by)
    batch.write.mode("overwrite").parquet(incoming)
    batch = read_table(spark, incoming).select(*batch.columns)
    if not table_exists(spark, path):
        write_months(batch, path, ts, sort_by)
        drop_table(spark, incoming)
        return
    old = read_table(spark, path)
    batch_months = months_of(with_month(batch, ts))
    holding = months_of(old.select(key, MONTH).join(batch.select(key), key, "left_semi")) if keys_may_move else []
    touched = sorted({*batch_months, *holding})
    named = spark.createDataFrame([(m,) for m in touched], "month string")
    named.coalesce(1).write.mode("overwrite").parquet(f"{path}__touched")
    kept = only_months(old, touched).drop(MONTH)
    with_month(delete_insert(kept, batch, key), ts).write.mode("overwrite").parquet(stage)
    _put_in_place(spark, path, ts, sort_by)
    index = KeyIndex(spark, path, key)
    if index.exists():
        index.add(batch)
    drop_table(spark, incoming)


def _put_in_place(spark: SparkSession, path: str, ts: str, sort_by: list[str]) -> None:
    """Overwrite the touched months by the staged ones and drop those that have no rows any more; may be repeated."""
    stage, touched = f"{path}__months", f"{path}__touched"
    if files.complete(spark, stage) and files.complete(spark, touched):
        staged = read_table(spark, stage)
        left = set(months_of(staged))
        write_months(staged.drop(MONTH), path, ts, sort_by, mode="overwrite")
        for row in read_table(spark, touched).collect():  # one per calendar month
            if row.month not in left:
                drop_table(spark, f"{path}/{MONTH}={row.month}")
    drop_table(spark, stage)
    drop_table(spark, touched)


def replace_table(spark: SparkSession, df: DataFrame, path: str, *partition_by: str) -> None:
    """Write next to the table, then swap folders; readers never see half a table."""
    path = path.rstrip("/")
    fresh, old = f"{path}__next", f"{path}__old"
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(fresh)
    fs, target = files.hadoop(spark, path)
    if table_exists(spark, path):
        drop_table(spark, old)
        if not fs.rename(target, files.hadoop(spark, old)[1]):
            raise OSError(f"cannot move {path} aside")
    if not fs.rename(files.hadoop(spark, fresh)[1], target):
        raise OSError(f"cannot move the new rows to {path}")
    drop_table(spark, old)


def drop_table(spark: SparkSession, path: str) -> None:
    files.drop(spark, path)


# --- state ---------------------------------------------------------------------------


class Watermarks:
    """Append-only (source, value, seq) log; the last entry of a source counts."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _last(self, source: str):
        if not table_exists(self.spark, self.path):
            return None
        log = self.spark.read.schema("source string, value string, seq bigint").parquet(self.path)
        return log.where(F.col("source") == source).orderBy(F.desc("seq")).limit(1).first()

    def get(self, source: str) -> str:
        row = self._last(source)
        return EPOCH if row is None or row["value"] is None else row["value"]

    def _put(self, source: str, value: str | None) -> None:
        row = self._last(source)
        seq = 1 if row is None else row["seq"] + 1
        entry = self.spark.createDataFrame([(source, value, seq)], "source string, value string, seq bigint")
        entry.coalesce(1).write.mode("append").parquet(self.path)

    def update(self, source: str, value: str) -> None:
        """Moves forward only: an older value than the stored one is ignored."""
        if datetime.fromisoformat(value) > datetime.fromisoformat(self.get(source)):
            self._put(source, value)

    def reset(self, source: str) -> None:
        self._put(source, None)


_RUN_ROW = (
    "run_id string, dag_id string, lane string, stage string, start_time timestamp_ntz, end_time timestamp_ntz, "
    "duration_seconds double, rows_extracted bigint, rows_loaded bigint, status string, error_message string"
)


@dataclass(frozen=True)
class Run:
    """One audit row: a stage of a run, with its true row counts."""

    dag_id: str
    lane: str
    stage: str
    start: datetime
    end: datetime
    rows_extracted: int = 0
    rows_loaded: int = 0
    status: str = "SUCCESS"
    error: str | None = None
    run_id: str = field(default_factory=lambda: str(uuid.uuid4()))

    def row(self) -> tuple:
        seconds = round((self.end - self.start).total_seconds(), 2)
        return (
            self.run_id, self.dag_id, self.lane, self.stage, self.start, self.end, seconds,
            self.rows_extracted, self.rows_loaded, self.status, self.error,
        )


def log_runs(spark: SparkSession, path: str, runs: list[Run]) -> None:
    """Append audit rows to the run log."""
    if runs:
        rows = spark.createDataFrame([r.row() for r in runs], _RUN_ROW).withColumn("run_sk", surrogate_key("run_id"))
        rows = rows.withColumn("duration_seconds", F.col("duration_seconds").cast("decimal(10,2)"))
        rows.select(*PIPELINE_RUNS.fieldNames()).coalesce(1).write.mode("append").parquet(path)


def logged_batches(spark: SparkSession, path: str, dag_id: str, load: Callable[[DataFrame, int], Loaded]) -> Callable[[DataFrame, int], None]:
    """`load` for foreachBatch, with an audit row for each batch, also for one that fails."""

    def run(batch: DataFrame, number: int) -> None:
        start, loaded, status, error = datetime.now(timezone.utc).replace(tzinfo=None), None, "SUCCESS", None
        try:
            loaded = load(batch, number)
        except Exception as e:
            status, error = "FAILED", str(e)
            raise
        finally:
            end = datetime.now(timezone.utc).replace(tzinfo=None)
            counts = (loaded.extracted, loaded.added) if loaded else (0, 0)
            log_runs(spark, path, [Run(dag_id, "stream", f"batch-{number}", start, end, *counts, status, error)])

    return run


def export_rows(mart: DataFrame, order: str, path: str | None = None, n: int = 10) -> DataFrame:
    """The newest rows of a mart as JSON text: a top-n report for a web page. Ties go by the row's text."""
    rows = mart.select(order, F.to_json(F.struct("*")).alias("row_json"))
    rows = rows.orderBy(F.desc(order), "row_json").limit(n).select(F.col(order).cast("string").alias("sort_value"), "row_json")
    if path:
        rows.select("row_json").coalesce(1).write.mode("overwrite").text(path)
    return rows
