"""From raw documents to token ids, in stages that are written and read again.

Each stage takes the documents that the stage before kept and returns documents
with the same columns; the last returns token ids. Nulls, empty texts, repeated
rows and other columns follow the rules that the operators state.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenmart.llm import bpe, lines, mixing, quality, simhash
from lumenmart.llm.common import held_out, saved, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Domains by their labels, and the share of words that each should have; what quality rejected has no target.
DOMAINS = {"toxic": "toxic = 1", "poor": "quality = 0", "clean": "quality = 1"}
TARGETS = {"toxic": 0.02, "clean": 0.98}


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled documents call good go on."""
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"), 5, 0))
    model = quality.fit(docs, labels)
    return quality.with_quality(docs.select(*COLUMNS), model).where("predicted = 1").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go; a document without a word left goes with them."""
    kept = lines.without_repeated_lines(docs.select(*COLUMNS), short=True)
    left = (F.col("n_dropped") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    n_chars = F.when(F.col("n_dropped") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return kept.where(left).withColumn("n_chars", n_chars).select(*COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints are linked by two or fewer differing bits, the one with the smallest id stays."""
    return simhash.first_of_each(docs.select(*COLUMNS), threshold=2)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken at the rates up to 1 that bring the domains to their shares of all that is clean."""
    docs = docs.select(*COLUMNS)
    model = mixing.fit_domains(docs, table(spark, sf_dir, "labels"), DOMAINS)
    return mixing.mixed(docs, model, TARGETS, most=1.0, whole="clean").where("copies > 0").select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every text, and the digest of what they decode to."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coded = bpe.round_trip(docs, ranks, public_tokenizers.PATTERN)
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", keep_one_of_each),
    ("mixing", mix_domains),
    ("encode", encode),
]
ORACLE_SQL: str | None = None  # no stage can be expressed in SQL; tests/llm hold brute-force versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = saved(docs, name)
    return docs
