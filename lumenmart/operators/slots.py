"""Ordered per-key operators that never put one whole key into one task.

A key (user, session, entity) may own a third of all rows. Each operator cuts
time into slots, works inside (key, slot), and stitches neighbouring slots
through a summary that has one row per (key, slot).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Short enough to cut up the densest keys; a sparse key has about one row per
# slot at any width, so shorter slots cost it nothing.
SLOT_SECONDS = 600


def slot_of(ts: Column, seconds: int) -> Column:
    """Start of the time slot that a timestamp falls into, in microseconds."""
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)
    return micros - F.pmod(micros, F.lit(seconds * 1000000))


def next_pairs(df: DataFrame, key: str, order: list[str], value: str, ts: str, slot_seconds: int = SLOT_SECONDS) -> DataFrame:
    """(key, value, next_value) for each row that has a successor within its key."""
    d = df.select(key, *order, value, slot_of(F.col(ts), slot_seconds).alias("_slot"))
    inside = (
        d.withColumn("_next", F.lead(F.struct(value)).over(Window.partitionBy(key, "_slot").orderBy(*order)))
        .where(F.col("_next").isNotNull())
        .select(key, F.col(value), F.col(f"_next.{value}").alias(f"next_{value}"))
    )
    rank = F.struct(*order)
    edges = d.groupBy(key, "_slot").agg(
        F.min_by(F.struct(value), rank).alias("_first"), F.max_by(F.struct(value), rank).alias("_last")
    )
    across = (
        edges.withColumn("_next", F.lead("_first").over(Window.partitionBy(key).orderBy("_slot")))
        .where(F.col("_next").isNotNull())
        .select(key, F.col(f"_last.{value}").alias(value), F.col(f"_next.{value}").alias(f"next_{value}"))
    )
    return inside.unionByName(across)


def with_neighbour(
    df: DataFrame,
    key: str,
    order: list[str],
    values: list[str],
    ts: str,
    out: str,
    forward: bool,
    slot_seconds: int = SLOT_SECONDS,
) -> DataFrame:
    """Add struct `out`: `values` of the next (or previous) row of the same key.

    Rows without a key are dropped; both uses of the input then filter alike,
    and Spark computes it once.
    """
    d = df.where(F.col(key).isNotNull()).withColumn("_slot", slot_of(F.col(ts), slot_seconds))
    payload = F.struct(*values)
    in_slot = Window.partitionBy(key, "_slot").orderBy(*order)
    by_slot = Window.partitionBy(key).orderBy("_slot")
    rank = F.struct(*order)
    step, edge = (F.lead, F.min_by) if forward else (F.lag, F.max_by)
    edges = (
        d.groupBy(key, "_slot")
        .agg(edge(payload, rank).alias("_edge"))
        .select(key, "_slot", step("_edge").over(by_slot).alias("_stitch"))
    )
    return (
        d.withColumn("_in", step(payload).over(in_slot))
        .join(edges, [key, "_slot"], "left")
        .withColumn(out, F.coalesce("_in", "_stitch"))
        .drop("_slot", "_in", "_stitch")
    )


def as_of(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    fact_ts: str,
    version_ts: str,
    values: list[str],
    slot_seconds: int = SLOT_SECONDS,
) -> DataFrame:
    """Facts with `values` of the newest version that is not younger than the fact.

    `versions` holds at most one row per (key, version_ts). A left join by
    interval would test every version of a key against each of its facts; here
    each side is sorted once per (key, slot).
    """
    v = versions.select(
        F.col(key), F.col(version_ts).alias("_ts"), F.lit(0).alias("_kind"), F.struct(*values).alias("_v"),
        slot_of(F.col(version_ts), slot_seconds).alias("_slot"),
    )
    f = facts.withColumn("_ts", F.col(fact_ts)).withColumn("_kind", F.lit(1))
    f = f.withColumn("_slot", slot_of(F.col(fact_ts), slot_seconds))
    both = f.unionByName(v, allowMissingColumns=True)
    running = (
        Window.partitionBy(key, "_slot").orderBy("_ts", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    inside = both.withColumn("_in", F.last("_v", ignorenulls=True).over(running)).where(F.col("_kind") == 1)

    # What each slot inherits: the last version of any earlier slot of the key.
    marks = (
        f.select(key, "_slot", F.lit(None).cast("timestamp_ntz").alias("_ts"), F.lit(None).cast(v.schema["_v"].dataType).alias("_v"))
        .unionByName(v.select(key, "_slot", "_ts", "_v"))
        .groupBy(key, "_slot")
        .agg(F.max_by("_v", "_ts").alias("_last"))
    )
    earlier = Window.partitionBy(key).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carry = marks.select(key, "_slot", F.last("_last", ignorenulls=True).over(earlier).alias("_carry"))

    found = F.coalesce("_in", "_carry")
    return (
        inside.join(carry, [key, "_slot"], "left")
        .withColumns({c: found[c] for c in values})
        .drop("_ts", "_kind", "_slot", "_v", "_in", "_carry")
    )


def inactivity_sessions(
    events: DataFrame, key: str, ts: str, gap_seconds: int = 1800, measures: dict[str, Column] | None = None
) -> DataFrame:
    """Sessions that end after `gap_seconds` without an event of the key.

    Two events in one slot as wide as the gap cannot be further apart than the
    gap, so events are first added up per (key, slot) on the map side; only
    these sums are ordered. The window sees one row per key and half hour,
    however many events the key has. `measures` are sums carried along.
    """
    measures = measures or {}
    slots = events.groupBy(key, slot_of(F.col(ts), gap_seconds).alias("_slot")).agg(
        F.min(ts).alias("_lo"),
        F.max(ts).alias("_hi"),
        F.count("*").alias("events_count"),
        *[F.sum(c).alias(name) for name, c in measures.items()],
    )
    w = Window.partitionBy(key).orderBy("_slot")
    idle = F.timestamp_diff("MICROSECOND", F.lag("_hi").over(w), F.col("_lo"))
    opens = F.when(idle.isNull() | (idle > gap_seconds * 1000000), 1).otherwise(0)
    numbered = slots.withColumn("_open", opens).withColumn(
        "session_number", F.sum("_open").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    return numbered.groupBy(key, "session_number").agg(
        F.min("_lo").alias("session_start"),
        F.max("_hi").alias("session_end"),
        F.sum("events_count").alias("events_count"),
        *[F.sum(name).alias(name) for name in measures],
    )
