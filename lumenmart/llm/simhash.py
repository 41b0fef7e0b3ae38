"""SimHash near-duplicates by anchor-point covering.

Anchors are the codewords of a product code over the first bits of the
fingerprint. Its blocks are binary Golay codes, perfect codes of length 23 and
covering radius 3, so each fingerprint has exactly one home anchor within the
radius in every block. If two fingerprints differ in at most ``threshold``
bits, the home of one lies within radius plus the differing bits of the other,
block by block. So every fingerprint is replicated to all anchors whose excess
over the radius, summed over blocks, is at most the threshold, and homes are
compared with the replicas at their anchor on all 64 bits. That finds every
link.

With two blocks there are 2**24 anchors and some 60 replicas of 16 bytes for
each different fingerprint, whatever the number of documents. A third block,
the Hamming code of length 15, makes it 2**35 anchors and some 150 replicas
(``blocks=("golay23", "golay23", "hamming15")``).

Copies share a fingerprint and are one node of the graph, so they are never
paired. Within an anchor only a spanning forest of the links is emitted.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenmart.llm.common import fresh_names, saved
from lumenmart.llm.components import components

BLOCKS = ("golay23", "golay23")

# Fixed values of the codes: length, generator polynomial, covering radius.
CODES = {
    "golay23": (23, 0b101011100011, 3),
    "hamming15": (15, 0b10011, 1),
}


@lru_cache(4)
def nearest_codeword(code: str) -> np.ndarray:
    """For each word, the number of the one codeword within the covering radius of a perfect cyclic code."""
    length, polynomial, radius = CODES[code]
    check_bits = polynomial.bit_length() - 1
    words = np.zeros(1, np.int32)
    for shift in range(length - check_bits):
        words = np.concatenate([words, words ^ (polynomial << shift)])
    table = np.zeros(1 << length, np.uint16)
    numbers = np.arange(len(words), dtype=np.uint16)
    for weight in range(radius + 1):
        for bits in combinations(range(length), weight):
            table[words ^ sum(1 << b for b in bits)] = numbers
    return table


def _flips(length: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    found = [(sum(1 << b for b in bits), w) for w in range(most + 1) for bits in combinations(range(length), w)]
    return np.array([f for f, _ in found], np.int64), np.array([w for _, w in found], np.int64)


def anchors_of(prints: np.ndarray, threshold: int, blocks: tuple[str, ...] = BLOCKS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row number, anchor, and whether it is the row's home, for every anchor in reach of 64-bit fingerprints."""
    n, offset = len(prints), 0
    row, anchor, excess = np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for code in blocks:
        length, polynomial, _ = CODES[code]
        word = ((prints >> np.uint64(offset)) & np.uint64((1 << length) - 1)).astype(np.int64)
        flips, weights = _flips(length, threshold)
        # a codeword at distance radius + w is the nearest one after w flips
        found = np.sort(nearest_codeword(code)[word[:, None] ^ flips].astype(np.int64) * 8 + weights, axis=1)
        fresh = np.ones(found.shape, bool)
        fresh[:, 1:] = found[:, 1:] >> 3 != found[:, :-1] >> 3
        counts, found = fresh.sum(axis=1), found[fresh]
        begins = np.cumsum(counts) - counts
        times = counts[row]
        at = np.repeat(begins[row] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        bits = length - polynomial.bit_length() + 1
        row = np.repeat(row, times)
        anchor = np.repeat(anchor, times) << bits | found[at] >> 3
        excess = np.repeat(excess, times) + (found[at] & 7)
        keep = excess <= threshold
        row, anchor, excess = row[keep], anchor[keep], excess[keep]
        offset += length
    return row, anchor, excess == 0


def forest(prints: np.ndarray, home: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Links between rows of one anchor, a home on one side at least, that connect what all such links connect."""
    links, left = [], np.arange(len(prints))
    while len(starts := left[home[left]]):
        queue, left = [starts[0]], left[left != starts[0]]
        while queue and len(left):
            u = queue.pop()
            near = np.bitwise_count(prints[left] ^ prints[u]) <= threshold
            near &= home[u] | home[left]
            new = left[near]
            left = left[~near]
            links += zip(repeat(u), new.tolist())
            queue += new.tolist()
    return links


def _links_in(anchor: np.ndarray, prints: np.ndarray, home: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of linked fingerprints from whole runs of equal anchors."""
    starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    sizes = np.diff(np.r_[starts, len(anchor)])
    homes = np.add.reduceat(home.astype(np.int64), starts)
    run = np.repeat(np.arange(len(starts)), sizes)
    # one home: it is compared with all rows of the run at once
    at = np.flatnonzero(home & (homes == 1)[run])
    centre = np.zeros(len(starts), np.uint64)
    centre[run[at]] = prints[at]
    differ = np.bitwise_count(prints ^ centre[run])
    near = (homes == 1)[run] & (differ <= threshold) & (differ > 0)
    a, b = [centre[run[near]]], [prints[near]]
    for r in np.flatnonzero(homes > 1):
        span = slice(starts[r], starts[r] + sizes[r])
        if links := forest(prints[span], home[span], threshold):
            ends = prints[span][np.array(links)]
            a.append(ends[:, 0])
            b.append(ends[:, 1])
    return np.concatenate(a), np.concatenate(b)


def print_links(prints: DataFrame, threshold: int, blocks: tuple[str, ...] = BLOCKS) -> DataFrame:
    """Links ``a``, ``b`` that connect all fingerprints (column ``print``, each once) within the threshold."""

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy().astype(np.int64).view(np.uint64)
            for i in range(0, len(values), 2000):
                part = values[i : i + 2000]
                row, anchor, home = anchors_of(part, threshold, blocks)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(part[row].view(np.int64)), pa.array(home)], ["anchor", "print", "home"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # parts of the last run, which may go on in the next batch

        def done(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
            if parts:
                anchor, values, home = (np.concatenate(x) for x in zip(*parts, strict=True))
                a, b = _links_in(anchor, values.view(np.uint64), home, threshold)
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            anchor, values = (batch.column(i).to_numpy() for i in (0, 1))
            home = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            cut = np.searchsorted(anchor, anchor[-1])
            head, tail = [tuple(x[s] for x in (anchor, values, home)) for s in (slice(0, cut), slice(cut, None))]
            if cut or (held and held[-1][0][-1] != anchor[0]):
                yield from done([*held, head] if cut else held)
                held = []
            held.append(tail)
        yield from done(held)

    replicas = prints.select(F.col("print").cast("bigint")).mapInArrow(replicate, "anchor bigint, print bigint, home boolean")
    cells = replicas.repartition("anchor").sortWithinPartitions("anchor")
    return cells.mapInArrow(compare, "a bigint, b bigint")


@lru_cache(1)
def _hasher():
    from xxhash import xxh64_digest

    return xxh64_digest


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of the text's word shingles, unsigned; 0 without words."""
    words = text.encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    joined = b" ".join(words)
    starts = np.cumsum([0, *(len(w) + 1 for w in words)])
    k = min(shingle, len(words))
    parts = [joined[i:j] for i, j in zip(starts[: len(words) - k + 1].tolist(), (starts[k:] - 1).tolist(), strict=True)]
    hashes = np.frombuffer(b"".join(map(_hasher(), parts, repeat(seed))), np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65536):
        ones += np.unpackbits(hashes[i : i + 65536], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def with_fingerprint(df: DataFrame, text: str = "text", result: str = "print") -> DataFrame:
    """Adds the fingerprint as a signed 64-bit integer; a null text counts as empty."""

    @F.arrow_udf("bigint")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(np.array([fingerprint(x.as_py() or "") for x in batch], np.uint64).view(np.int64))

    return df.withColumn(result, of(F.col(text)))


def _roots(prints: DataFrame, threshold: int, blocks: tuple[str, ...]) -> DataFrame:
    """Adds ``root``, one fingerprint of its group, to rows with a ``print`` of their own each."""
    linked = components(print_links(prints, threshold, blocks))
    return prints.join(linked, prints["print"] == linked["node"], "left").withColumn("root", F.coalesce("component", "print")).drop("node", "component")


def near_duplicates(df: DataFrame, threshold: int = 2, doc_id: str = "doc_id", text: str = "text", blocks: tuple[str, ...] = BLOCKS) -> DataFrame:
    """``doc_id``, ``print`` and ``component_id`` (smallest id reachable over links) of each row.

    Null and empty texts and texts without words have fingerprint 0 and link
    like others. Repeated rows each give a row. Rows with a null id take part;
    a component of such rows only has a null ``component_id``. An empty table
    gives no rows. Other columns are left out.
    """
    docs = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    docs = saved(with_fingerprint(docs).select("doc_id", "print"), "prints")
    prints = docs.groupBy("print").agg(F.min("doc_id").alias("least"))
    rooted = _roots(prints, threshold, blocks)
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return docs.join(rooted.join(named, "root").select("print", "component_id"), "print").select("doc_id", "print", "component_id")


def first_of_each(df: DataFrame, threshold: int = 2, doc_id: str = "doc_id", text: str = "text", blocks: tuple[str, ...] = BLOCKS) -> DataFrame:
    """The least row, by ``doc_id`` and text, of every group of near-duplicates; all columns stay.

    A row without an id stays only where all of its group lack one. Texts
    without words are alike. Rows of one id are told apart by their texts, and
    repeated rows are one group, also where their other columns differ. An
    empty table gives no rows.
    """
    own, root, first = fresh_names(df, "print", "root", "first")
    rows = saved(with_fingerprint(df, text, own), "rows-with-prints")
    prints = rows.select(F.col(own).alias("print")).distinct()
    rooted = _roots(prints, threshold, blocks).select(F.col("print").alias(own), F.col("root").alias(root))
    row = F.struct(F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id), F.col(text)).alias("order"), F.struct(*df.columns).alias("row"))
    least = rows.join(rooted, own).select(root, row.alias(first)).groupBy(root).agg(F.min(first)["row"].alias(first))
    return least.select(*(F.col(first)[c].alias(c) for c in df.columns))
