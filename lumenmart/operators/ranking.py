"""Global ranks, tiles, percentiles and trailing distinct counts without a
single-task sort of the detail rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

_KEY_BUCKETS = 4096


def exact_ntile(df: DataFrame, measure: str, key: str, tiles: int, out: str = "tile") -> DataFrame:
    """`ntile(tiles) over (order by measure desc, key)` for unique non-negative keys.

    The position of a row is the number of rows with a larger measure (from the
    histogram of measure values), plus the rows with the same measure in lower
    key ranges, plus its row number in its own (measure, key range) group.
    Surrogate keys are 60-bit hashes, so 4096 equal ranges split any tie evenly.
    """
    ranged = df.withColumn("_range", F.shiftright(F.col(key), 48))
    cells = ranged.groupBy(measure, "_range").agg(F.count("*").alias("_n"))
    # One row per distinct measure value: the only window without partitions.
    per_value = cells.groupBy(measure).agg(F.sum("_n").alias("_rows"))
    above = Window.orderBy(F.desc(measure)).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per_value = per_value.select(
        measure,
        F.coalesce(F.sum("_rows").over(above), F.lit(0)).alias("_above"),
        F.sum("_rows").over(everything).alias("_total"),
    )
    lower = Window.partitionBy(measure).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.withColumn("_below", F.coalesce(F.sum("_n").over(lower), F.lit(0))).join(per_value, measure)
    offsets = offsets.select(measure, "_range", "_total", (F.col("_above") + F.col("_below")).alias("_offset"))
    row = F.row_number().over(Window.partitionBy(measure, "_range").orderBy(key))
    position = F.col("_offset") + F.col("_row") - 1
    # The first (total mod tiles) tiles hold one row more than the others.
    small, extra = F.floor(F.col("_total") / tiles), F.col("_total") % tiles
    big_rows = extra * (small + 1)
    tile = F.when(position < big_rows, F.floor(position / (small + 1))).otherwise(
        extra + F.floor((position - big_rows) / F.greatest(small, F.lit(1)))
    )
    return (
        ranged.withColumn("_row", row)
        .join(offsets, [measure, "_range"])
        .withColumn(out, (tile + 1).cast("int"))
        .drop("_range", "_row", "_total", "_offset")
    )


def nth_row(df: DataFrame, order: list[str], n: int, folder: str) -> Row | None:
    """The `order` columns, as text, of the n-th row by them, nulls first; None if there are fewer rows.

    They go into the folder by range, one range a task. The counts of the ranges
    tell which one holds the row, and only that one is ordered as a whole.
    """
    ranged = df.select(*order).repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    ranged.write.mode("overwrite").parquet(folder)
    stored, before = df.sparkSession.read.parquet(folder), 0
    for r in stored.groupBy("_range").agg(F.count("*").alias("n")).orderBy("_range").collect():  # one per task of the write
        if before + r.n >= n:
            inside = stored.where(F.col("_range") == r["_range"]).orderBy(*order).offset(n - before - 1)
            return inside.select(*[F.col(c).cast("string").alias(c) for c in order]).first()
        before += r.n
    return None


def up_to(df: DataFrame, last: Row) -> DataFrame:
    """Rows that are not after what `nth_row` found."""
    order = list(last.asDict())
    end = F.struct(*[F.lit(last[c]).cast(df.schema[c].dataType).alias(c) for c in order])
    return df.where(F.struct(*order) <= end)


def top_tile_sum(df: DataFrame, measure: str, tiles: int, out: str) -> DataFrame:
    """One row: sum of `measure` over the first of `tiles` equal tiles, largest first.

    Rows with equal measures add the same amount, so the histogram of measure
    values is enough and no row has to be ranked.
    """
    histogram = df.groupBy(measure).agg(F.count("*").alias("_n"))
    before = Window.orderBy(F.desc(measure)).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    size = F.ceil(F.sum("_n").over(everything) / tiles)
    taken = F.least(F.col("_n"), F.greatest(size - F.coalesce(F.sum("_n").over(before), F.lit(0)), F.lit(0)))
    return histogram.withColumn("_taken", taken).agg(
        F.coalesce(F.sum(F.col(measure) * F.col("_taken")), F.lit(0)).cast("bigint").alias(out)
    )


def exact_percentiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float], width: float) -> DataFrame:
    """Interpolated percentiles per group, exact, for any group size.

    Rows are counted per (group, value) on the map side. Coarse buckets of
    `width` give each value's rank offset, so every window is bounded either by
    the number of buckets or by the distinct values in one bucket.
    """
    # Nulls are dropped by their count, after the aggregate: a filter on the value
    # would be pushed down and evaluate a computed value twice per row.
    fine = df.groupBy(*keys, F.col(value).alias("_v")).agg(F.count(value).alias("_n")).where(F.col("_n") > 0)
    fine = fine.withColumn("_b", F.coalesce(F.floor(F.col("_v") / width), F.lit(0)))
    coarse = fine.groupBy(*keys, "_b").agg(F.sum("_n").alias("_bn"))
    in_order = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    coarse = coarse.select(
        *keys,
        "_b",
        F.coalesce(F.sum("_bn").over(in_order), F.lit(0)).alias("_before"),
        F.sum("_bn").over(whole).alias("_total"),
    )
    in_bucket = Window.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = fine.withColumn("_cum", F.sum("_n").over(in_bucket))
    if keys:
        same = [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]
        cond = F.col("r._b") == F.col("c._b")
        for s in same:
            cond = cond & s
        ranked = ranked.alias("r").join(coarse.alias("c"), cond).select("r.*", "c._before", "c._total")
    else:
        ranked = ranked.join(coarse, "_b")
    last = F.col("_before") + F.col("_cum")
    first = last - F.col("_n") + 1
    aggs: list[Column] = []
    for name, p in probs.items():
        target = (F.col("_total") - 1) * F.lit(p) + 1
        lo, hi = F.floor(target), F.ceil(target)
        at = [F.when((first <= r) & (last >= r), F.col("_v")) for r in (lo, hi)]
        aggs += [F.max(at[0]).alias(f"_{name}_lo"), F.max(at[1]).alias(f"_{name}_hi"), F.max(target - lo).alias(f"_{name}_f")]
    picked = ranked.groupBy(*keys).agg(*aggs, F.max("_total").alias("n"))
    return picked.select(
        *keys,
        "n",
        *[
            F.round(F.col(f"_{x}_lo") + (F.col(f"_{x}_hi") - F.col(f"_{x}_lo")) * F.col(f"_{x}_f"), 6).cast("double").alias(x)
            for x in probs
        ],
    )


def trailing_actives(active_days: DataFrame, entity: str, day: str, windows: dict[str, int]) -> DataFrame:
    """Distinct entities in each trailing window, per day that has activity.

    `active_days` has one row per (entity, day). An activity on day d counts
    for the windows ending on d .. d+n-1, but from the entity's next active day
    on that one takes over. So each row adds one interval, an interval is +1 at
    its start and -1 after its end, and the running sum of these is the count:
    one row per entity-day, no copies of rows, no range join.
    """
    w = Window.partitionBy(entity).orderBy(day)
    rows = active_days.select(entity, day).withColumn("_next", F.lead(day).over(w))
    ends = [F.least(F.date_add(day, n), F.coalesce(F.col("_next"), F.date_add(day, n))) for n in windows.values()]
    changes = [F.struct(F.col(day).alias("_d"), F.lit(1).alias("_active"), *[F.lit(1).alias(x) for x in windows])]
    for name, end in zip(windows, ends):
        changes.append(
            F.struct(end.alias("_d"), F.lit(0).alias("_active"), *[F.lit(-1 if x == name else 0).alias(x) for x in windows])
        )
    per_day = (
        rows.select(F.explode(F.array(*changes)).alias("c"))
        .groupBy(F.col("c._d").alias(day))
        .agg(F.sum("c._active").alias("_active"), *[F.sum(f"c.{x}").alias(x) for x in windows])
    )
    # One row per calendar day from here on.
    upto = Window.orderBy(day).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_day.select(
        day, F.col("_active").alias("active"), *[F.sum(x).over(upto).alias(x) for x in windows]
    ).where(F.col("active") > 0)
