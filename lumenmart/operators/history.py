"""Slowly changing history (type 2): snapshots, change logs, as-of lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenmart.operators.slots import SLOT_SECONDS, as_of, with_neighbour

TRACKED = ("university_id", "course_id", "role", "status")


def version_id(key: str, valid_from: str) -> Column:
    stamp = F.date_format(valid_from, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), stamp))


def first_snapshot(users: DataFrame) -> DataFrame:
    """Version table after the first load: valid from the registration date."""
    versions = users.withColumn("valid_from", F.col("registration_date").cast("timestamp_ntz"))
    versions = versions.withColumn("valid_to", F.lit(None).cast("timestamp_ntz"))
    return versions.select(version_id("user_id", "valid_from").alias("scd_id"), "*")


def merge_snapshot(
    versions: DataFrame, snapshot: DataFrame, as_of_ts: str, key: str = "user_id", tracked: tuple[str, ...] = TRACKED
) -> DataFrame:
    """Version table after one more snapshot.

    Open versions are compared with the snapshot by a null-safe look at the
    tracked columns. A changed key yields two rows (closed and new), a new key
    one, an unchanged or missing key keeps its open row. One join on the key;
    closed versions pass by it.
    """
    now = F.lit(as_of_ts).cast("timestamp_ntz")
    columns = [c for c in versions.columns if c not in ("scd_id", "valid_from", "valid_to")]
    open_rows = versions.where(F.col("valid_to").isNull()).select(
        F.col(key), F.struct(*columns, "valid_from").alias("old")
    )
    fresh = snapshot.select(F.col(key), F.struct(*columns).alias("new"))
    both = open_rows.join(fresh, key, "full")
    same = F.lit(True)
    for c in tracked:
        same = same & F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))

    def row(side: str, valid_from: Column, valid_to: Column) -> Column:
        return F.struct(
            *[F.col(f"{side}.{c}").alias(c) for c in columns],
            valid_from.cast("timestamp_ntz").alias("valid_from"),
            valid_to.cast("timestamp_ntz").alias("valid_to"),
        )

    never = F.lit(None)
    keep = row("old", F.col("old.valid_from"), never)
    rows = (
        F.when(F.col("new").isNull(), F.array(keep))
        .when(F.col("old").isNull(), F.array(row("new", now, never)))
        .when(same, F.array(keep))
        .otherwise(F.array(row("old", F.col("old.valid_from"), now), row("new", now, never)))
    )
    opened = both.select(F.explode(rows).alias("r")).select("r.*")
    merged = opened.select(version_id(key, "valid_from").alias("scd_id"), *columns, "valid_from", "valid_to")
    return versions.where(F.col("valid_to").isNotNull()).select(*merged.columns).unionByName(merged)


def history_from_changes(
    changes: DataFrame, key: str, ts: str, seq: str, tracked: list[str], slot_seconds: int = SLOT_SECONDS
) -> DataFrame:
    """Version table from a change log: runs of equal states become one version.

    Several changes at one instant count as the last of them (by `seq`).
    """
    states = changes.groupBy(key, ts).agg(F.max_by(F.struct(*tracked), seq).alias("_s")).select(key, ts, "_s.*")
    before = with_neighbour(states, key, [ts], tracked, ts, "_prev", forward=False, slot_seconds=slot_seconds)
    same = F.col("_prev").isNotNull()
    for c in tracked:
        same = same & F.col(c).eqNullSafe(F.col(f"_prev.{c}"))
    starts = before.where(~same).drop("_prev")
    ends = with_neighbour(starts, key, [ts], [ts], ts, "_next", forward=True, slot_seconds=slot_seconds)
    return ends.select(
        version_id(key, ts).alias("scd_id"),
        key,
        *tracked,
        F.col(ts).alias("valid_from"),
        F.col(f"_next.{ts}").alias("valid_to"),
        F.col("_next").isNull().alias("is_current"),
    )


def current_versions(versions: DataFrame) -> DataFrame:
    return versions.where(F.col("valid_to").isNull())


def version_at(facts: DataFrame, versions: DataFrame, key: str, fact_ts: str, values: list[str]) -> DataFrame:
    """Facts with the attributes that were valid when they happened."""
    return as_of(facts, versions, key, fact_ts, "valid_from", values)
