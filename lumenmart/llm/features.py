"""Term vectors of whole texts: hashed byte trigrams and terms for the text's shape."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

TRIGRAMS, SHAPES, STEPS = 2048, 8, 12
WIDTH = TRIGRAMS + SHAPES * STEPS
_SYMBOLS = np.frombuffer(b"#*$%&|<>{}[]=_~^\\/@+", np.uint8)


def _shape(data: bytes) -> np.ndarray:
    """Eight shares from 0 to 1: symbols, capitals, exclamation marks, digits, repeated lines, repeated neighbours, redundancy, length."""
    bytes_of = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n = max(len(data), 1)
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    upper, lower = bytes_of[65:91].sum(), bytes_of[97:123].sum()
    shares = [
        6 * bytes_of[_SYMBOLS].sum() / n,
        upper / max(upper + lower, 1),
        6 * bytes_of[33] / n,
        4 * bytes_of[48:58].sum() / n,
        1 - len(set(lines)) / max(len(lines), 1),
        sum(map(bytes.__eq__, words, words[1:])) / max(len(words), 1),
        1 - len(zlib.compress(data, 1)) / n,
        np.log1p(len(words)) / 9,
    ]
    return np.clip(shares, 0, 1)


def shape_terms(data: bytes) -> np.ndarray:
    """Each share split between two of its twelve steps."""
    out = np.zeros(SHAPES * STEPS, np.float32)
    at = np.sqrt(_shape(data)) * (STEPS - 1)
    step = np.minimum(at.astype(int), STEPS - 2)
    first = np.arange(SHAPES) * STEPS + step
    out[first] += 1 - (at - step)
    out[first + 1] += at - step
    return out


def term_vector(text: str) -> np.ndarray:
    """Log counts of trigrams per 2,000, then the shape terms."""
    data = text.encode()
    out = np.zeros(WIDTH, np.float32)
    b = np.frombuffer(data, np.uint8).astype(np.int32)
    if len(b) > 2:
        code = (b[:-2] * 7919 + b[1:-1] * 104729 + b[2:] * 1299709 >> 3) & TRIGRAMS - 1
        out[:TRIGRAMS] = np.log1p(np.bincount(code, minlength=TRIGRAMS) * (2000 / len(code)))
    out[TRIGRAMS:] = shape_terms(data)
    return out


def term_vectors(texts: list[str]) -> np.ndarray:
    return np.array([term_vector(t) for t in texts], np.float32).reshape(len(texts), WIDTH)


def vector_bytes(text: Column) -> Column:
    """The vector as little-endian half floats."""

    @F.arrow_udf("binary")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([term_vector(x.as_py() or "").astype("<f2").tobytes() for x in batch], pa.binary())

    return of(text)


def from_bytes(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(rows), "<f2").astype(np.float32).reshape(len(rows), WIDTH)


def in_blocks(batch: pa.Array, rows: int = 256, chars: int = 4_000_000) -> Iterator[list[str]]:
    """The batch's texts in blocks of bounded size; nulls are empty."""
    block, size = [], 0
    for x in batch:
        text = x.as_py() or ""
        block.append(text)
        size += len(text)
        if len(block) >= rows or size >= chars:
            yield block
            block, size = [], 0
    if block:
        yield block
