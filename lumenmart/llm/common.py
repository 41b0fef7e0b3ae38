"""Helpers that several operators of this folder use."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenmart.session import shared_dir

# Words are runs of characters other than the six ASCII white-space characters.
# bytes.split() without an argument splits at exactly these.
WORD_GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """True where crc32 of the id's decimal text leaves the remainder; a null id counts as empty text."""
    digits = F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")
    return F.crc32(digits) % modulus == remainder


def saved(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The rows, written to the shared folder and read back: lineage ends here, lost executors cost nothing."""
    path = shared_dir(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh_names(df: DataFrame, *names: str) -> list[str]:
    """Names for columns of one's own that the rows don't have yet, whatever their case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def total(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)
