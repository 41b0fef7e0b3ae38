"""The operators of this folder with production parameters, over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenmart.llm import bpe, ctw, language, lines, mixing, quality, rules, runs, simhash, token_files, toxicity, vectors, whitening
from lumenmart.llm.common import WORD_GAP, held_out, table
from lumenmart.session import shared_dir


def op1_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = held_out(F.col("doc_id"), 5, 0)
    model = quality.fit(docs, table(spark, sf_dir, "labels").where(~out))
    scored = quality.with_quality(docs, model, threshold=0.3)
    return scored.select("doc_id", out.alias("held_out"), "score", "predicted")


#: Domains by their labels, and the share of words that each should have.
DOMAINS = {"toxic": "toxic = 1", "poor": "quality = 0", "clean": "quality = 1"}
TARGETS = {"toxic": 0.02, "poor": 0.03, "clean": 0.95}


def op2_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = mixing.fit_domains(docs, table(spark, sf_dir, "labels"), DOMAINS)
    rated = mixing.mixed(docs, model, TARGETS)
    shares = [F.get("posteriors", F.lit(i)).alias(f"p_{name}") for i, name in enumerate(model.names)]
    return rated.select("doc_id", "tokens", *shares, F.round("rate", 6).alias("rate"), "copies")


def op3_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"), threshold=2)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def op4_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op5_toxicity_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = held_out(F.col("doc_id"), 5, 0)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~out))
    scored = toxicity.with_toxicity(docs, model, threshold=0.5)
    return scored.select("doc_id", out.alias("held_out"), "score", "predicted")


def op6_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(table(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 7, 2), across_words=True)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, ranks, public_tokenizers.PATTERN).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdict = rules.outliers(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"))
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return verdict.select(*names, F.round("distance", 3).alias("distance"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.without_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), short=True)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("text_sha256"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), 2, added_tokens=True)
    rows = token_files.read(spark, path).select(
        "seq", "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), token_files.ids_crc32("ids").alias("ids_crc32")
    )
    return rows.join(token_files.starts(spark, path), "seq").select("doc_id", "start", "n_tokens", "ids_crc32")


def planted_repeats(docs: DataFrame) -> DataFrame:
    """Texts where the words of every tenth document by hash go round in a circle from some place on."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.filter(F.split("text", WORD_GAP), lambda w: w != "")
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    circled = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    some = (F.col("h") % 10 == 0) & F.col("text").isNotNull()
    docs = docs.withColumn("h", h).withColumn("words", F.when(some, words)).withColumn("words", F.when(n > 0, F.col("words")))
    docs = docs.withColumns({"a": a, "p": p})
    return docs.select("doc_id", F.coalesce(F.array_join(circled, " "), "text").alias("text"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = planted_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = runs.with_runs(docs)
    # The first of the greatest: by length, then the smallest start and period.
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines_ = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    found = found.withColumn("best", longest)
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines_.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_language_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = held_out(F.col("doc_id"), 4, 2)
    model = language.fit(docs.where(~out))
    return language.with_language(docs.select("doc_id", "text"), model).select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_neighbours": op1_quality_neighbours,
    "op2_soft_mixing": op2_soft_mixing,
    "op3_simhash_anchors": op3_simhash_anchors,
    "op4_inverted_multi_index": op4_inverted_multi_index,
    "op5_toxicity_automata": op5_toxicity_automata,
    "op6_context_tree": op6_context_tree,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_robust_outliers": op8_robust_outliers,
    "op9_line_dedup": op9_line_dedup,
    "op10_token_files": op10_token_files,
    "op11_runs": op11_runs,
    "op12_language_filters": op12_language_filters,
    "op13_whitening": op13_whitening,
}
ORACLE_SQL: dict[str, str] = {}
