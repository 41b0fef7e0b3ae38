"""Mergeable summaries per day: distinct users and quantiles without the detail rows.

A distinct sketch has 2**LG_K registers and a standard error of
1.04 / sqrt(2**LG_K), whatever the number of users; sketches of any days,
platforms and institutions are united register by register. A quantile sketch
keeps a few times `K` values with a rank error of some 1.7 / K. Both are small
columns, so any window or filter reads summaries only, and a late event changes
the summary of its day by one more union.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K, K = 12, 400
#: Four standard errors, and twice the rank error that 99 of 100 sketches keep: what estimates are held to.
USERS_WITHIN, RANK_WITHIN = 4 * 1.04 / 2 ** (LG_K / 2), 0.02


def user_sketches(rows: DataFrame, day: str, user: str, *dims: str) -> DataFrame:
    """One sketch of users per day and combination of `dims`."""
    return rows.groupBy(day, *dims).agg(F.hll_sketch_agg(user, F.lit(LG_K)).alias("users"))


def united(sketches: DataFrame, *keys: str) -> DataFrame:
    """One sketch per combination of `keys`, of the sketches of all loads."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("users").alias("users"))


def trailing_estimates(sketches: DataFrame, day: str, windows: dict[str, int]) -> DataFrame:
    """Per day with a sketch, the estimated users of the last n days. Sketches
    are united by day first, so a window moves one small row per day in it."""
    days = united(sketches, day)
    ends = days.select(F.col(day).alias("_end")).distinct()
    ages = F.sequence(F.lit(0), F.lit(max(windows.values()) - 1))
    reached = days.select("users", F.explode(ages).alias("_age"), day).withColumn("_end", F.date_add(day, F.col("_age")))
    reached = reached.join(ends, "_end", "left_semi")
    estimate = lambda n: F.hll_sketch_estimate(F.hll_union_agg(F.when(F.col("_age") < n, F.col("users"))))
    return reached.groupBy(F.col("_end").alias(day)).agg(*(estimate(n).alias(name) for name, n in windows.items()))


def users_close(estimate: Column, exact: Column) -> Column:
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), USERS_WITHIN * exact)


def value_sketches(rows: DataFrame, value: str, *keys: str) -> DataFrame:
    """One sketch of a whole-number column per combination of `keys`, with the number of values; nulls don't count."""
    known = rows.where(F.col(value).isNotNull())
    return known.groupBy(*keys).agg(F.kll_sketch_agg_bigint(F.col(value).cast("bigint"), F.lit(K)).alias("sketch"), F.count("*").alias("n"))


def merged_values(sketches: DataFrame, *keys: str | Column) -> DataFrame:
    """Sketches of days, or of several loads, as one per combination of `keys`."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_bigint("sketch", F.lit(K)).alias("sketch"), F.sum("n").alias("n"))


def quantile(p: float) -> Column:
    return F.kll_sketch_get_quantile_bigint("sketch", F.lit(p))


def rank_close(below: Column, up_to: Column, n: Column, p: float) -> Column:
    """Whether a value with `below` smaller ones, and `up_to` up to it, stands at rank p of n but for the error."""
    return (below <= (p + RANK_WITHIN) * n) & (up_to >= (p - RANK_WITHIN) * n)
