"""Document quality by nearest-neighbour voting among labelled latent-semantic vectors.

A bounded sample of labelled documents (``max_labelled``) gives a term matrix,
its leading singular directions span the latent space, and the labelled vectors
in it are broadcast (a few MB at most, by that bound). Every document of the
table is projected and its cosines with all labelled vectors are computed
exactly, in blocks. The nearest labelled vectors vote with a weight that grows
with their similarity. The pass over the documents has no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenmart.llm import features

#: Labelled documents that the model may hold, directions of the latent space, voters, and the power of their similarity.
MAX_LABELLED, DIRECTIONS, VOTERS, POWER = 4000, 48, 15, 20
#: Weight of shape terms against trigrams, and of the base rate against the votes.
SHAPE_WEIGHT, BASE_WEIGHT = 2.0, 0.01


@dataclass
class Neighbours:
    idf: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    base: float

    def project(self, terms: np.ndarray) -> np.ndarray:
        scaled = terms.copy()
        words = scaled[:, : features.TRIGRAMS]
        words *= self.idf
        words /= np.linalg.norm(words, axis=1, keepdims=True) + 1e-9
        scaled[:, features.TRIGRAMS :] *= SHAPE_WEIGHT / np.sqrt(features.SHAPES)
        latent = scaled @ self.directions if self.directions.size else scaled
        return latent / (np.linalg.norm(latent, axis=1, keepdims=True) + 1e-9)

    def vote(self, texts: list[str]) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(texts), self.base)
        cosines = self.project(features.term_vectors(texts)) @ self.vectors.T
        k = min(VOTERS, len(self.labels))
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosines, near, 1), 0).astype(np.float64) ** POWER
        score = ((weight * self.labels[near]).sum(1) + BASE_WEIGHT * self.base) / (weight.sum(1) + BASE_WEIGHT)
        return np.where([bool(t.strip()) for t in texts], np.clip(score, 0, 1), self.base)


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, most: int) -> DataFrame:
    """``doc_id``, ``text`` and ``label`` of at most ``most`` labelled ids, those with the smallest hashes.

    A document labelled twice counts as 1 if any label does; of rows with one id, the least text is taken.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(target).isNotNull())
    known = known.groupBy("doc_id").agg(F.max(F.col(target).cast("int")).alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most `most` rows
    return texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", max_labelled: int = MAX_LABELLED) -> Neighbours:
    """The model from labelled documents. Without any, every score is 0.5."""
    sample = labelled_sample(docs, labels, target, max_labelled)
    rows = sample.select("doc_id", "label", features.vector_bytes(F.col("text")).alias("vector")).orderBy("doc_id").collect()
    terms = features.from_bytes([r.vector for r in rows])
    y = np.array([r.label for r in rows], np.float64)
    seen = (terms[:, : features.TRIGRAMS] > 0).sum(0)
    idf = (np.log((len(rows) + 1) / (seen + 1)) + 0.2).astype(np.float32)
    model = Neighbours(idf, np.empty(0, np.float32), np.empty(0), y, float(y.mean()) if len(y) else 0.5)
    if len(rows):
        scaled = model.project(terms)  # no directions yet: the weighted, normalised terms
        _, vectors = np.linalg.eigh(scaled.T @ scaled)
        model.directions = np.ascontiguousarray(vectors[:, -DIRECTIONS:], np.float32)
        model.vectors = model.project(terms).astype(np.float32)
    return model


def score(model: Neighbours, text: Column) -> Column:
    """From 0 to 1, higher if label 1 is likelier; texts without words and nulls get the base rate."""

    @F.arrow_udf("double")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [model.vote(block) for block in features.in_blocks(batch)]
            yield pa.array(np.concatenate(parts) if parts else np.empty(0))

    return of(text)


def with_quality(docs: DataFrame, model: Neighbours, threshold: float = 0.3) -> DataFrame:
    """Adds ``score`` and ``predicted`` to every row, in place of columns of these names.

    Rows are scored one by one: repeated rows score alike, and an empty table stays empty.
    """
    return docs.withColumn("score", score(model, F.col("text"))).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
