"""Active days as bits: one 64-bit word per user and 64 days.

Word b holds the days 64 b to 64 b + 63, counted from 1970. A load sets bits in
the words of its days and reads no others, and setting a bit twice does no
harm, so a load may be repeated. Retention, recency and cohort cells are then
bit operations on a user's few words instead of joins with all user days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenmart.operators.sinks import drop_table, read_table, table_exists

BLOCK = "block"


def day_blocks(days: DataFrame, user: str, day: str) -> DataFrame:
    """`user`, `block` and `bits` of the active days."""
    at = F.unix_date(day)
    bit = F.expr(f"shiftleft(1L, unix_date({day}) & 63)")
    return days.where(F.col(user).isNotNull() & F.col(day).isNotNull()).groupBy(user, F.shiftright(at, 6).alias(BLOCK)).agg(F.bit_or(bit).alias("bits"))


def extend_blocks(spark: SparkSession, path: str, days: DataFrame, user: str, day: str) -> list[int]:
    """Add days to the stored words. Returns the blocks that were read and written: one number per 64 days."""
    stage = f"{path.rstrip('/')}__blocks"
    words = day_blocks(days, user, day)
    words.write.mode("overwrite").parquet(f"{stage}/new")
    words = read_table(spark, f"{stage}/new")
    touched = sorted(r[0] for r in words.select(BLOCK).distinct().collect())
    if table_exists(spark, path):
        words = words.unionByName(read_table(spark, path).where(F.col(BLOCK).isin(touched)).select(words.columns))
        words = words.groupBy(user, BLOCK).agg(F.bit_or("bits").alias("bits"))
    words.write.mode("overwrite").parquet(f"{stage}/all")
    out = read_table(spark, f"{stage}/all").hint("rebalance", F.col(BLOCK)).sortWithinPartitions(BLOCK, user)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BLOCK).parquet(path)
    drop_table(spark, stage)
    return touched


def words_of_users(blocks: DataFrame, user: str) -> DataFrame:
    """One row per user: the words by block, six for each year of history."""
    return blocks.groupBy(user).agg(F.map_from_entries(F.collect_list(F.struct(BLOCK, "bits"))).alias("words"))


def _word(words: Column, block: Column) -> Column:
    return F.coalesce(F.try_element_at(words, block), F.lit(0).cast("bigint"))


def active_on(words: Column, day: Column) -> Column:
    at = F.unix_date(day)
    return F.bit_get(_word(words, F.shiftright(at, 6)), at.bitwiseAND(F.lit(63))) == 1


def last_active(words: Column) -> Column:
    """The last active day; null without words."""
    top = F.transform(F.map_entries(words), lambda e: e["key"] * 64 + F.length(F.bin(e["value"])) - 1)
    return F.date_from_unix_date(F.array_max(top))


def active_between(words: Column, first: Column, last: Column) -> Column:
    """Whether a day from `first` to `last` is active; both are days since 1970."""
    ones = F.lit(-1).cast("bigint")

    def hit(block: Column) -> Column:
        start, end = F.greatest(first - block * 64, F.lit(0)), F.least(last - block * 64, F.lit(63))
        mask = F.call_function("shiftleft", ones, start).bitwiseAND(F.call_function("shiftrightunsigned", ones, 63 - end))
        return _word(words, block).bitwiseAND(mask) != 0

    return F.exists(F.sequence(F.shiftright(first, 6), F.shiftright(last, 6)), hit)
