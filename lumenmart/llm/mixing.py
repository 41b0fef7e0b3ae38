"""Soft-membership mixing of sources to target weights.

Documents have no domain of their own. A softmax classifier, fitted on a
bounded sample of a labelled table, gives each one posterior probabilities of
the domains, so its words count towards every domain in part. Nonnegative rates
per document are then fitted by least squares, so that the expected words of
each domain match the targets: accelerated projected gradient from rate 1 on,
in the metric of the documents' lengths.

A gradient step moves a document by a combination of its posteriors, so rates
depend on posteriors alone, and documents with equal posteriors (rounded to
1/1000) are summed first. Each iteration is one aggregate over these rows; what
goes between the driver and the rows is one number per domain. A document's
rate is replayed from the steps, without a join.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenmart.llm import features
from lumenmart.llm.common import saved, total

_LOG = logging.getLogger(__name__)

#: Labelled documents that the classifier is fitted on, at most.
MAX_LABELLED = 4000
#: Words that speak for a domain: in so many documents of the sample, with such log odds.
LEAST_DOCS, LEAST_ODDS = 4, 2.5
#: Gradient steps at most, steps between written rates, and the relative miss at which it stops.
MOST_STEPS, WRITTEN_EVERY, PRECISE = 96, 8, 0.001


@dataclass
class Classifier:
    """Softmax over the text's shape and, for each domain, the odds of the telling words in it."""

    names: list[str]
    words: dict[str, list[float]]
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def posteriors(self, texts: list[str]) -> np.ndarray:
        z = ((inputs(texts, self.words, len(self.names)) - self.mean) * self.scale) @ self.weights[:-1] + self.weights[-1]
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def inputs(texts: list[str], words: dict[str, list[float]], domains: int) -> np.ndarray:
    out = np.zeros((len(texts), features.SHAPES * features.STEPS + domains), np.float32)
    telling = words.keys()
    for row, text in zip(out, texts, strict=True):
        row[:-domains] = features.shape_terms(text.encode())
        if found := telling & set(text.lower().translate(_BARE).split()):
            row[-domains:] = np.log1p(np.sum([words[w] for w in sorted(found)], axis=0))
    return out


#: ASCII punctuation and digits end words.
_BARE = str.maketrans({c: " " for c in "0123456789!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"})


def _softmax(x: np.ndarray, y: np.ndarray, classes: int, ridge: float = 1e-4, rounds: int = 2000) -> np.ndarray:
    """Accelerated gradient descent on the penalised log-likelihood."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    target = np.eye(classes, dtype=np.float32)[y]
    step = 1 / (0.5 * float(np.linalg.eigvalsh(x.T @ x)[-1]) / len(x) + ridge)
    w = np.zeros((x.shape[1], classes), np.float32)
    last = w
    for k in range(rounds):
        at = w + k / (k + 3) * (w - last)
        z = x @ at
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        last, w = w, at - step * (x.T @ (p - target) / len(x) + ridge * at)
    return w


def _telling_words(sample: DataFrame, domains: int) -> dict[str, list[float]]:
    """Log odds for each domain (0 where against it) of words that occur in few domains but in several documents."""
    spaced = F.translate(F.lower("text"), "".join(map(chr, _BARE)), " " * len(_BARE))
    words = F.array_distinct(F.filter(F.split(spaced, r"\s+"), lambda w: F.length(w) > 2))
    counts = sample.select("domain", F.explode(words).alias("word")).groupBy("word").agg(*(F.count_if(F.col("domain") == i).alias(f"n{i}") for i in range(domains)))
    sizes = sample.agg(*(F.count_if(F.col("domain") == i).alias(f"n{i}") for i in range(domains))).first()
    every = sum(sizes)
    odds = {}
    for i in range(domains):
        rest = total([F.col(f"n{j}") for j in range(domains) if j != i] or [F.lit(0)])
        odds[f"o{i}"] = F.log((F.col(f"n{i}") + 0.5) / (sizes[i] + 1)) - F.log((rest + 0.5) / (every - sizes[i] + 1))
    strong = [(F.col(f"n{i}") >= LEAST_DOCS) & (F.col(f"o{i}") >= LEAST_ODDS) for i in range(domains)]
    kept = counts.withColumns(odds).select("word", *(F.when(s, F.col(f"o{i}")).otherwise(0.0).alias(f"o{i}") for i, s in enumerate(strong)))
    rows = kept.where(total([F.col(f"o{i}") for i in range(domains)]) > 0).collect()  # words of LEAST_DOCS of MAX_LABELLED documents
    return {r.word: [r[f"o{i}"] for i in range(domains)] for r in rows}


def fit_domains(docs: DataFrame, labels: DataFrame, domains: dict[str, str], max_labelled: int = MAX_LABELLED) -> Classifier:
    """The classifier; ``domains`` gives each name a condition on ``labels``, and the first that holds counts.

    Labels that meet no condition and rows without an id are left out. A
    document labelled twice counts for the first domain among its labels.
    Without labels all domains are equally likely.
    """
    names = list(domains)
    which = F.coalesce(*(F.when(F.expr(condition), F.lit(i)) for i, condition in enumerate(domains.values())), F.lit(None).cast("int"))
    known = labels.where("doc_id is not null").select("doc_id", which.alias("domain")).where("domain is not null")
    known = known.groupBy("doc_id").agg(F.min("domain").alias("domain"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("domain").alias("domain"))
    sample = saved(sample, "labelled")
    words, d = _telling_words(sample, len(names)), len(names)

    @F.arrow_udf("binary")
    def packed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([inputs([x.as_py() or ""], words, d)[0].astype("<f4").tobytes() for x in batch], pa.binary())

    rows = sample.select("doc_id", "domain", packed("text").alias("v")).orderBy("doc_id").collect()
    width = features.SHAPES * features.STEPS + d
    if not rows:
        return Classifier(names, {}, np.zeros(width, np.float32), np.ones(width, np.float32), np.zeros((width + 1, d), np.float32))
    x = np.frombuffer(b"".join(r.v for r in rows), "<f4").reshape(len(rows), width)
    mean, scale = x.mean(axis=0), 1 / np.maximum(x.std(axis=0), 0.1)
    weights = _softmax((x - mean) * scale, np.array([r.domain for r in rows]), d)
    return Classifier(names, words, mean, scale, weights)


def with_posteriors(docs: DataFrame, model: Classifier) -> DataFrame:
    """Adds ``tokens`` (words) and ``posteriors`` (rounded to 1/1000) to every row; nulls are empty texts of no words."""

    @F.arrow_udf("struct<tokens:bigint,p:array<double>>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            words, p = [], [np.empty((0, len(model.names)))]
            for block in features.in_blocks(batch):
                words += [len(t.encode().split()) for t in block]
                p.append(np.round(model.posteriors(block).astype(np.float64), 3))
            flat = np.concatenate(p)
            ends = np.arange(len(flat) + 1, dtype=np.int32) * flat.shape[1]
            yield pa.StructArray.from_arrays([pa.array(words, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.ravel()))], ["tokens", "p"])

    found = docs.withColumn("_found", of(F.col("text")))
    return found.withColumns({"tokens": F.col("_found.tokens"), "posteriors": F.col("_found.p")}).drop("_found")


def _walk(steps: list[tuple[float, np.ndarray]], d: int, rate: Column, before: Column, most: float | None = None) -> tuple[Column, Column]:
    """The rate and the one before, after these steps from a rate and the one before it; rates stay in 0 to ``most``."""
    if not steps:
        return rate, before
    moves = F.array(*(F.struct(F.lit(float(b)).alias("b"), *(F.lit(float(g[i])).alias(f"g{i}") for i in range(d))) for b, g in steps))
    start = F.struct(rate.alias("r"), before.alias("q"))

    def move(s: Column, m: Column) -> Column:
        ahead = s["r"] + m["b"] * (s["r"] - s["q"])
        down = total([F.get("posteriors", F.lit(i)) * m[f"g{i}"] for i in range(d)])
        moved = F.greatest(ahead - down, F.lit(0.0))
        return F.struct((moved if most is None else F.least(moved, F.lit(float(most)))).alias("r"), s["r"].alias("q"))

    end = F.aggregate(moves, start, move)
    return end["r"], end["q"]


def fit_rates(rows: DataFrame, targets: list[float], tokens: float | None = None, most: float | None = None, whole: int | None = None) -> Column:
    """The rate as an expression of ``posteriors``, fitted on ``posteriors`` and ``tokens`` of all rows.

    ``targets`` are weights of the domains. ``tokens`` is the expected total;
    by default the largest for which no domain has to be repeated, or that for
    which the domain ``whole`` is taken whole. A target of 0 or a domain without
    words is left to the others' steps. ``most`` (1 at least) is the highest
    rate. A miss that the steps leave is logged.
    """
    d = len(targets)
    weight = np.array(targets, np.float64) / sum(targets)
    cells = rows.groupBy("posteriors").agg(F.sum("tokens").cast("double").alias("tokens"))
    cells = saved(cells.withColumns({"rate": F.lit(1.0), "before": F.lit(1.0)}), "rates")
    p = [F.get("posteriors", F.lit(i)) for i in range(d)]
    sums = cells.agg(*(F.sum(F.col("tokens") * p[i] * p[j]).alias(f"m{i}_{j}") for i in range(d) for j in range(i + 1)), *(F.sum(F.col("tokens") * p[i]).alias(f"a{i}") for i in range(d))).first()
    have = np.array([sums[f"a{i}"] or 0.0 for i in range(d)])
    used = (weight > 0) & (have > 0)
    if not used.any():
        return F.lit(1.0)
    if tokens is None:
        tokens = have[whole] / weight[whole] if whole is not None and used[whole] else (have[used] / weight[used]).min()
    goal = tokens * weight
    # only a total of 0 asks for less of a domain without a target
    scale = np.where(used, 1 / np.where(goal > 0, goal, 1), 0) if tokens != 0 else np.where(have > 0, 1 / np.maximum(have, 1), 0)
    square = np.array([[sums[f"m{max(i, j)}_{min(i, j)}"] for j in range(d)] for i in range(d)]) * np.outer(scale, scale)
    length = 1 / np.linalg.eigvalsh(square)[-1]
    steps: list[tuple[float, np.ndarray]] = []  # those that the written rates lack
    every: list[tuple[float, np.ndarray]] = []
    momentum, errors = 1.0, []
    for k in range(MOST_STEPS):
        rate, before = _walk(steps, d, F.col("rate"), F.col("before"), most)
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        beta = (momentum - 1) / following if k else 0.0
        momentum = following
        ahead = cells.select("tokens", "posteriors", rate.alias("r"), before.alias("q")).withColumn("y", F.col("r") + beta * (F.col("r") - F.col("q")))
        found = ahead.agg(*(F.sum(F.col("tokens") * F.col(c) * p[i]).alias(f"{c}{i}") for c in "ry" for i in range(d))).first()
        miss = (np.array([found[f"r{i}"] for i in range(d)]) - goal) * scale
        errors.append(float(miss @ miss))
        if np.abs(miss).max() < PRECISE or (k >= 24 and min(errors[-12:]) > 0.98 * min(errors[:-12])):  # reached, or as near as it gets
            break
        if k and errors[-1] > errors[-2]:  # momentum overshot
            momentum, beta = 1.0, 0.0
        at = "y" if beta else "r"
        gradient = length * scale * ((np.array([found[f"{at}{i}"] for i in range(d)]) - goal) * scale)
        steps.append((beta, gradient))
        every.append((beta, gradient))
        if len(steps) == WRITTEN_EVERY:
            rate, before = _walk(steps, d, F.col("rate"), F.col("before"), most)
            cells = saved(cells.select("posteriors", "tokens", rate.alias("rate"), before.alias("before")), "rates")
            steps = []
    if np.abs(miss).max() >= PRECISE:
        _LOG.warning("mixing: %d steps leave the domains at %s of %s words", len(every), np.round(miss / np.where(scale > 0, scale, 1) + goal).tolist(), np.round(goal).tolist())
    return _walk(every, d, F.lit(1.0), F.lit(1.0), most)[0]


def mixed(docs: DataFrame, model: Classifier, targets: dict[str, float], tokens: float | None = None, most: float | None = None, whole: str | None = None) -> DataFrame:
    """Adds ``tokens``, ``posteriors``, ``rate`` and ``copies`` to every row, in place of columns of these names.

    ``copies`` is the rate rounded up or down at random, by a hash of the id
    and the text, so that its expectation is the rate and a repeated run gives
    the same. Repeated rows are rated alike. An empty table stays empty.
    ``most`` and the name of the domain ``whole`` are those of ``fit_rates``.
    """
    rows = saved(with_posteriors(docs, model).drop("rate", "copies"), "posteriors")
    rated = rows.withColumn("rate", fit_rates(rows, [targets.get(n, 0.0) for n in model.names], tokens, most, None if whole is None else model.names.index(whole)))
    chance = F.pmod(F.xxhash64(F.lit("mix"), "doc_id", "text"), F.lit(1_000_003)) / 1_000_003
    copies = F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("int")
    return rated.withColumn("copies", copies.cast("bigint"))
