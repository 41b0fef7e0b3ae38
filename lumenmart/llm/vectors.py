"""Embedding near-duplicates with an inverted multi-index.

Each half of the normalised vectors has its own codebook, fitted by k-means on
a bounded sample; pairs of codewords are the cells of a grid. Every vector is
indexed at its nearest cell and visits the cells nearest to it in the order of
the multi-sequence algorithm. How many it visits is measured: sampled queries
are compared exactly with all vectors, and the number is taken at which the
target share of their true neighbours is reached. Candidates are verified by
their cosine in double precision.

Equal vectors are one node. The vectors of the grid, cell by cell, are cut into
buckets of like size, a large cell into several. A vector travels once to each
bucket that has cells it visits, as 32-bit floats if the column has such, and
cells meet there as matrix products of bounded size. Buckets are worked off in
as many rounds as keep what is shuffled at once at ``ROUND`` times the vectors.
Counts of links are summed in the bucket, and only a spanning forest of the
links of a bucket is emitted.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenmart.llm.common import saved
from lumenmart.llm.components import components

#: Vectors that codebooks are fitted on and queries that measure recall, at most.
SAMPLE, QUERIES = 20_000, 256
#: Vectors per cell aimed at, bounds of a codebook, target recall, cells visited at least.
FILL, LEAST_CODES, MOST_CODES = 8, 4, 1024
TARGET, LEAST_CELLS = 0.995, 8
#: Buckets that a small table is cut into, bytes of the doubles of a bucket and of its visitors at a time, of a matrix of distances, entries of one of links.
BUCKETS, BYTES, CACHE, ENTRIES = 32, 1 << 24, 1 << 21, 1 << 20
#: Bytes that a round may shuffle, as a multiple of those of all vectors, and what it may shuffle in any case.
ROUND, LEAST_ROUND = 1.75, 1 << 28


def unit(raw: bytes, sizes: np.ndarray, dim: int, kind: str) -> np.ndarray:
    """Normalised rows in double precision of vectors of ``sizes`` bytes one after the other; shorter ones are filled up with zeros."""
    values = np.frombuffer(raw, kind)
    own = sizes // np.dtype(kind).itemsize
    if (own == dim).all():
        out = values.reshape(len(sizes), dim).astype(np.float64)
    else:
        out = np.zeros((len(sizes), dim))
        out[np.arange(dim) < own[:, None]] = values
    out /= np.abs(out).max(axis=1, keepdims=True, initial=1e-300)  # neither overflow nor underflow in the squares
    out /= np.linalg.norm(out, axis=1, keepdims=True)
    return out


def _units(v: pa.Array, dim: int, kind: str) -> np.ndarray:
    return unit(b"".join(v.to_pylist()), pc.binary_length(v).to_numpy(), dim, kind)


def _slices(batches: Iterator[pa.RecordBatch], width: int, most: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of at most ``most`` bytes at ``width`` doubles a row, or 16 rows."""
    step = max(16, most // (8 * width))
    for batch in batches:
        for i in range(0, batch.num_rows, step):
            yield batch.slice(i, step)


def _codebook(x: np.ndarray, size: int, rounds: int = 12) -> np.ndarray:
    """k-means from evenly spaced rows; an empty cluster takes the row farthest from its centre."""
    centres = x[np.linspace(0, len(x) - 1, min(size, len(x))).astype(int)].copy()
    for _ in range(rounds):
        nearest, away = np.empty(len(x), np.int64), np.empty(len(x))
        for i in range(0, len(x), 256):  # all distances at once would be 164 MB
            d = _squares(x[i : i + 256], centres)
            nearest[i : i + 256], away[i : i + 256] = d.argmin(axis=1), d.min(axis=1)
        counts = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        full = counts > 0
        centres[full] = sums[full] / counts[full, None]
        spare = np.argsort(-away, kind="stable")
        for k, empty in enumerate(np.flatnonzero(~full)):
            centres[empty] = x[spare[k]]
    return centres


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = (-2 * x) @ centres.T
    out += (x * x).sum(1)[:, None]
    out += (centres * centres).sum(1)
    return np.maximum(out, 0, out=out)


def multi_sequences(first: np.ndarray, second: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row of two matrices of ascending distances the first ``cells`` cells of the grid in ascending sum: places in either row, and the sums.

    Cell (i, j) comes after the (i + 1) * (j + 1) - 1 cells below it, so that only few can be among the first.
    """
    i, j = np.nonzero(np.outer(np.arange(1, first.shape[1] + 1), np.arange(1, second.shape[1] + 1)) <= cells)
    sums = first[:, i] + second[:, j]
    order = np.argsort(sums, axis=1, kind="stable")[:, :cells]
    return i[order], j[order], np.take_along_axis(sums, order, 1)


def multi_sequence(first: list[float], second: list[float], cells: int) -> list[tuple[int, int]]:
    """The cells of the grid in ascending sum of two sorted lists of distances, the first ``cells`` of them."""
    i, j, _ = multi_sequences(np.array([first]), np.array([second]), cells)
    return list(zip(i[0].tolist(), j[0].tolist(), strict=True))


def _least(d: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns of the ``n`` smallest entries of each row, ascending, and these entries."""
    if n < d.shape[1]:
        some = np.sort(np.argpartition(d, n - 1, axis=1)[:, :n], axis=1)
    else:
        some = np.broadcast_to(np.arange(d.shape[1]), d.shape)
    near = np.take_along_axis(d, some, 1)
    order = np.argsort(near, axis=1, kind="stable")
    return np.take_along_axis(some, order, 1), np.take_along_axis(near, order, 1)


@dataclass
class Index:
    dim: int
    kind: str
    left: np.ndarray
    right: np.ndarray
    cells: int = 1
    sample: np.ndarray | None = field(default=None, repr=False)

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.left.shape[1]
        return _squares(x[:, :half], self.left), _squares(x[:, half:], self.right)

    def home(self, x: np.ndarray) -> np.ndarray:
        a, b = self.distances(x)
        return a.argmin(1) * len(self.right) + b.argmin(1)

    def grid(self) -> int:
        return len(self.left) * len(self.right)

    def width(self) -> int:
        """Doubles that ``visits`` needs for a row."""
        n = self.cells
        return int(max(len(self.left), len(self.right), sum(min(len(self.right), n // i) for i in range(1, min(len(self.left), n) + 1))))

    def visits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The home of each row, the cells that it visits, nearest first, and the distance of the last one."""
        a, b = self.distances(x)
        (first, near), (second, far) = _least(a, min(self.cells, a.shape[1])), _least(b, min(self.cells, b.shape[1]))
        i, j, sums = multi_sequences(near, far, min(self.cells, self.grid()))
        home = a.argmin(1) * len(self.right) + b.argmin(1)
        return home, np.take_along_axis(first, i, 1) * len(self.right) + np.take_along_axis(second, j, 1), sums[:, -1]

    def cell_distance(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        a, b = self.distances(x)
        rows = np.arange(len(x))
        return a[rows, cell // len(self.right)] + b[rows, cell % len(self.right)]

    def cell_distances(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """Distances of all rows from all cells."""
        half = self.left.shape[1]
        (one, i), (two, j) = (np.unique(c, return_inverse=True) for c in np.divmod(cell, len(self.right)))
        return _squares(x[:, :half], self.left[one])[:, i] + _squares(x[:, half:], self.right[two])[:, j]


@contextmanager
def _settings(spark: SparkSession):
    """Shuffle files of a query go when it ends, not when the driver collects its garbage; Python gets long rows a few at a time."""
    held = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": str(BYTES)}
    before = {key: spark.conf.get(key, None) for key in held}
    for key, value in held.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def _classes(df: DataFrame, vec_id: str, embedding: str) -> tuple[DataFrame, str]:
    """``vec_id`` and the vector's bytes ``v``, null for a vector that links with nothing; the type of the bytes' numbers."""
    rows = df.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).alias("e"))
    held = rows.schema["e"].dataType
    kind = "<f4" if isinstance(held, T.ArrayType) and isinstance(held.elementType, T.FloatType) else "<f8"

    @F.arrow_udf("binary")
    def packed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            at, numbers = batch.offsets.to_numpy().astype(np.int64), batch.values
            at, numbers = at - at[0], numbers.slice(at[0], at[-1] - at[0])
            x = pc.fill_null(numbers, float("nan")).to_numpy(zero_copy_only=False).astype(kind) + np.zeros(1, kind)  # no -0.0
            bad, some = (np.concatenate([[0], np.cumsum(c)]) for c in (~np.isfinite(x), x != 0))
            fine = (bad[at[1:]] == bad[at[:-1]]) & (some[at[1:]] > some[at[:-1]]) & batch.is_valid().to_numpy(zero_copy_only=False)
            sizes = np.diff(at)
            ends = np.concatenate([[0], np.cumsum(np.where(fine, sizes, 0))]) * x.itemsize
            data = x if fine.all() else x[np.repeat(fine, sizes)]
            yield pa.Array.from_buffers(pa.binary(), len(batch), [pa.array(fine).buffers()[1], pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data.tobytes())])

    numbers = F.col("e") if kind == "<f4" else F.col("e").cast("array<double>")
    return rows.select("vec_id", packed(numbers).alias("v")), kind


def _sampled(classes: DataFrame, n: int, kind: str) -> list[bytes]:
    """The first ``SAMPLE`` vectors by the hash of their doubles."""

    def widened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doubles = [np.frombuffer(x, kind).astype("<f8").tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(doubles, pa.binary())], ["id", "v", "doubles"])

    hashed = classes.select("id", "v").mapInArrow(widened, "id bigint, v binary, doubles binary").select(F.xxhash64("doubles").alias("h"), "id", "v")
    for share in (2 * SAMPLE / n, 1):
        # of a large table only the hashes that can be among the first are sorted
        some = hashed.where(F.col("h") < int(2**64 * share) - 2**63) if share < 1 else hashed
        found = [bytes(r.v) for r in some.orderBy("h", "id").limit(SAMPLE).select("v").collect()]
        if len(found) == min(SAMPLE, n):
            break
    return found


def build_index(classes: DataFrame, threshold: float, target: float = TARGET, kind: str = "<f8") -> Index | None:
    """Codebooks from a sample by hash, and the number of visited cells from exact neighbours of sampled queries."""
    shape = classes.agg(F.count("*").alias("n"), F.max(F.length("v")).alias("bytes")).first()
    if not shape.n:
        return None
    dim = shape.bytes // np.dtype(kind).itemsize
    raw = _sampled(classes, shape.n, kind)
    sample = unit(b"".join(raw), np.array([len(r) for r in raw]), dim, kind)
    size = int(np.clip(np.ceil(np.sqrt(shape.n / FILL)), LEAST_CODES, MOST_CODES))
    half = max(dim // 2, 1)
    index = Index(dim, kind, _codebook(sample[:, :half], size), _codebook(sample[:, half:], size))
    queries = sample[:QUERIES]
    grid = [d.astype(np.float64) for d in index.distances(queries)]

    def rank(k: int, cell: int) -> int:
        """One more than the cells that are nearer to a query than this one."""
        near, far = grid[0][k], grid[1][k]
        reach = near[cell // len(far)] + far[cell % len(far)]
        near, far = near[near + far.min() < reach], far[near.min() + far < reach]
        return int((near[:, None] + far < reach).sum()) + 1

    def ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, int] = {}  # neighbours of a query share few cells
        for batch in _slices(batches, max(dim, len(queries), size), CACHE):
            x = _units(batch.column(0), dim, kind)
            q, r = np.nonzero(queries @ x.T >= threshold)
            who, at = np.unique(r, return_inverse=True)
            pairs, n = np.unique(q * index.grid() + index.home(x[who])[at], return_counts=True)
            for p in set(pairs.tolist()) - known.keys():
                known[p] = rank(*divmod(p, index.grid()))
            yield pa.RecordBatch.from_arrays([pa.array([known[p] for p in pairs.tolist()], pa.int64()), pa.array(n, pa.int64())], ["rank", "n"])

    found = classes.select("v").mapInArrow(ranks, "rank bigint, n bigint")
    seen = found.agg(F.percentile("rank", F.lit(target), F.col("n")).alias("r"), F.sum("n").alias("n")).first()
    reach = seen.r
    if seen.n < 2 * len(queries):  # hardly any besides the queries themselves: points halfway to the threshold stand in
        turned = np.random.default_rng(0).normal(size=queries.shape)
        turned -= (turned * queries).sum(1, keepdims=True) * queries
        turned /= np.maximum(np.linalg.norm(turned, axis=1, keepdims=True), 1e-12)
        c = (1 + threshold) / 2
        cell = index.home(c * queries + np.sqrt(1 - c * c) * turned)
        own = index.cell_distance(queries, cell)
        reach = max(reach, np.quantile([(grid[0][k][:, None] + grid[1][k] < own[k]).sum() + 1 for k in range(len(queries))], target))
    index.cells = min(max(LEAST_CELLS, int(np.ceil(reach))), index.grid())
    index.sample = sample[:1000]
    return index


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Row and column pairs that connect what the true entries of a matrix connect."""
    out, rows_left, columns_left = [], linked.any(1), np.ones(linked.shape[1], bool)
    while (left := np.flatnonzero(rows_left)).size:
        queue = [left[0]]
        rows_left[left[0]] = False
        while queue:
            r = queue.pop()
            for c in np.flatnonzero(linked[r] & columns_left):
                columns_left[c] = False
                out.append((r, c))
                new = np.flatnonzero(linked[:, c] & rows_left)
                rows_left[new] = False
                out += [(n, c) for n in new]
                queue += new.tolist()
    return out


class Layout:
    """Where the cells lie in the buckets: the number of a cell's vectors, the first of them in the order of the grid, and the vectors of a bucket."""

    def __init__(self, count: np.ndarray, size: int):
        self.count, self.size = count, size
        self.first = np.cumsum(count, dtype=np.int64) - count

    def __reduce__(self) -> tuple:
        return Layout, (self.count, self.size)  # the rest need not travel

    @classmethod
    def of(cls, count: np.ndarray, dim: int) -> Layout:
        return cls(count, max(1, min(-(-int(count.sum()) // BUCKETS), BYTES // (8 * dim))))

    def own(self, home: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The bucket of each vector: one of those that its cell lies in."""
        mixed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
        return (self.first[home] + (mixed % self.count[home].astype(np.uint64)).astype(np.int64)) // self.size

    def visited(self, home: np.ndarray, visits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, cell and bucket of all visits that can meet another vector."""
        there = self.count[visits]
        row, k = np.nonzero((there > 1) | (there == 1) & (visits != home[:, None]))
        cell = visits[row, k]
        start = self.first[cell] // self.size
        spread = (self.first[cell] + self.count[cell] - 1) // self.size - start + 1
        of = np.repeat(np.arange(len(cell)), spread)
        bucket = start[of] + np.arange(len(of)) - np.repeat(np.cumsum(spread) - spread, spread)
        return row[of], cell[of], bucket


KIND = "bucket int, visitor boolean, id binary, copies binary, home binary, reach binary, size binary, v binary, row binary, cell binary"
#: Types of the numbers in the binary columns.
PACKED = {"id": "<i8", "copies": "<i8", "home": "<i4", "reach": "<f8", "size": "<i4", "row": "<i4", "cell": "<i4"}


def _place(batches: Iterator[pa.RecordBatch], index: Index, layout: Layout, turn: int, rounds: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``KIND``: a batch's vectors for a bucket of this round, those at home there and those that visit."""
    for batch in batches:
        for part in _slices([batch], index.dim, BYTES):
            raw = part.column(2).to_pylist()
            size = np.array([len(r) for r in raw])
            found = [index.visits(_units(s.column(2), index.dim, index.kind)) for s in _slices([part], max(index.dim, index.width()), CACHE)]
            home, visits, reach = (np.concatenate(c) for c in zip(*found, strict=True))
            ids, copies = part.column(0).to_numpy(), part.column(1).to_numpy()
            own = layout.own(home, ids)
            row, cell, bucket = layout.visited(home, visits)
            out = []
            for visitor, r, c, b in ((False, np.arange(len(raw)), home, own), (True, row, cell, bucket)):
                here = np.flatnonzero(b % rounds == turn)
                here = here[np.lexsort((r[here], b[here]))]
                r, c, b = r[here], c[here], b[here]
                for start, end in zip([0, *(np.flatnonzero(np.diff(b)) + 1)], [*(np.flatnonzero(np.diff(b)) + 1), len(b)], strict=True):
                    if start == end:
                        continue
                    who, at = np.unique(r[start:end], return_inverse=True)
                    numbers = {"id": ids[who], "copies": copies[who], "home": home[who], "reach": reach[who], "size": size[who], "row": at, "cell": c[start:end]}
                    if not visitor:  # one visit each, at home
                        numbers |= {"row": at[:0], "cell": at[:0]}
                    packed = {k: x.astype(PACKED[k]).tobytes() for k, x in numbers.items()}
                    out.append({"bucket": int(b[start]), "visitor": visitor, "v": b"".join([raw[k] for k in who.tolist()])} | packed)
            schema = pa.schema([(c.split()[0], {"int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}[c.split()[1]]) for c in KIND.split(", ")])
            yield pa.RecordBatch.from_pylist(out, schema)


class _Bucket:
    """The vectors at home in a bucket, in the order of their cells, and what their visitors have found."""

    def __init__(self, index: Index, threshold: float, blocks: list[dict]):
        self.index, self.threshold = index, threshold
        homes = _joined(blocks, index)
        order = np.argsort(homes["home"], kind="stable")
        self.homes = {k: homes[k][order] for k in ("id", "copies", "home", "reach", "size", "x")}
        self.links = np.zeros(len(order), np.int64)
        self.tree = np.arange(len(order))  # vectors known to be connected have the same number, that of one of them

    def met(self, blocks: list[dict]) -> Iterator[tuple[list, list, list]]:
        """Links of a spanning forest, and visitors with the links that they get."""
        visitors, homes = _joined(blocks, self.index), self.homes
        order = np.argsort(visitors["cell"], kind="stable")
        rows, cells = visitors["row"][order], visitors["cell"][order]
        starts = np.flatnonzero(np.diff(cells, prepend=-1))
        low, high = (np.searchsorted(homes["home"], cells[starts], side) for side in ("left", "right"))
        links, a, b = np.zeros(len(visitors["id"]), np.int64), [], []
        for start, end, lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(cells)], low.tolist(), high.tolist(), strict=True):
            if lo == hi:  # its vectors are in another bucket
                continue
            step = max(16, ENTRIES // (hi - lo))
            for i in range(start, end, step):
                self._meet(visitors, rows[i : min(i + step, end)], lo, hi, links, a, b)
        who = np.flatnonzero(links)
        yield a, b, [None] * len(a)
        yield visitors["id"][who].tolist(), [None] * len(who), links[who].tolist()

    def _meet(self, visitors: dict, rows: np.ndarray, lo: int, hi: int, links: np.ndarray, a: list, b: list) -> None:
        homes = self.homes
        linked = visitors["x"][rows] @ homes["x"][lo:hi].T >= self.threshold
        linked &= visitors["id"][rows, None] != homes["id"][lo:hi]
        if not linked.any():
            return
        linked &= visitors["size"][rows, None] == homes["size"][lo:hi]
        q, h = np.flatnonzero(linked.any(1)), np.flatnonzero(linked.any(0))
        linked, q, h = linked[np.ix_(q, h)], rows[q], h + lo
        # a home that doesn't visit the visitor's cell learns of the link here
        back = self.index.cell_distances(homes["x"][h], visitors["home"][q]) <= homes["reach"][h, None] + 1e-9
        links[q] += (linked * homes["copies"][h]).sum(1)
        self.links[h] += (linked.T * visitors["copies"][q] * ~back).sum(1)
        trees, at = np.unique(self.tree[h], return_inverse=True)
        order = np.argsort(at, kind="stable")
        joint = np.logical_or.reduceat(linked[:, order], np.searchsorted(at[order], np.arange(len(trees))), axis=1)
        forest = _forest(joint)
        a += visitors["id"][q[[r for r, _ in forest]]].tolist()
        b += homes["id"][trees[[c for _, c in forest]]].tolist()
        if len(trees) > 1:
            self._graft(trees, forest, lo, hi)

    def _graft(self, trees: np.ndarray, forest: list[tuple[int, int]], lo: int, hi: int) -> None:
        """Trees with a row in common become one."""
        into = list(range(len(trees)))

        def find(c: int) -> int:
            while into[c] != c:
                into[c] = into[into[c]]
                c = into[c]
            return c

        first: dict[int, int] = {}
        for r, c in forest:
            one, two = find(first.setdefault(r, c)), find(c)
            into[max(one, two)] = min(one, two)
        own = self.tree[lo:hi]
        at = np.minimum(np.searchsorted(trees, own), len(trees) - 1)
        hit = trees[at] == own
        own[hit] = trees[np.array([find(c) for c in range(len(trees))])][at[hit]]


def _joined(blocks: list[dict], index: Index) -> dict:
    out = {k: np.concatenate([np.frombuffer(x[k], t) for x in blocks]) for k, t in PACKED.items() if k != "row"}
    counts = [len(x["id"]) // 8 for x in blocks]
    rows = [np.frombuffer(x["row"], PACKED["row"]).astype(np.int64) + before for x, before in zip(blocks, np.cumsum([0, *counts]).tolist(), strict=False)]
    return out | {"row": np.concatenate(rows), "x": unit(b"".join([x["v"] for x in blocks]), out["size"], index.dim, index.kind)}


def _compare(batches: Iterator[pa.RecordBatch], index: Index, threshold: float) -> Iterator[pa.RecordBatch]:
    """``a``, ``b`` and ``n`` of ``links``; the rows of a bucket come together, those at home first."""
    most, at, bucket, blocks, n = BYTES // (8 * index.dim), None, None, [], 0

    def rows(a: list, b: list, links: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (a, b, links)], ["a", "b", "n"])

    def ended() -> Iterator[pa.RecordBatch]:
        if bucket:
            if blocks:
                yield from (rows(*x) for x in bucket.met(blocks))
            some = np.flatnonzero(bucket.links)
            yield rows(bucket.homes["id"][some].tolist(), [None] * len(some), bucket.links[some].tolist())

    for batch in batches:
        for i in range(batch.num_rows):
            x = {k: batch.column(k)[i].as_py() for k in batch.schema.names}
            if x["bucket"] != at:
                yield from ended()
                at, bucket, blocks, n = x["bucket"], None, [], 0
            if x["visitor"] and not bucket:
                bucket, blocks = _Bucket(index, threshold, blocks), []
            blocks.append(x)
            n += len(x["id"]) // 8
            if bucket and n >= most:
                yield from (rows(*r) for r in bucket.met(blocks))
                blocks, n = [], 0
    yield from ended()


def links(classes: DataFrame, index: Index, threshold: float) -> DataFrame:
    """Rows ``a``, ``b`` (links of a spanning forest) and ``a``, ``n`` (numbers of links to add up), saved."""
    spark, vectors = classes.sparkSession, classes.select("id", "copies", "v")
    full = vectors.mapInArrow(lambda bs: _home_cells(bs, index), "cell bigint").groupBy("cell").agg(F.count("*").alias("rows")).toArrow()
    count = np.zeros(index.grid(), np.int32)
    count[full.column("cell").to_numpy()] = full.column("rows").to_numpy()
    layout = Layout.of(count, index.dim)
    # how often a vector travels, by a sample
    home, visits, _ = (np.concatenate(c) for c in zip(*(index.visits(index.sample[i : i + 50]) for i in range(0, len(index.sample), 50)), strict=True))
    row, _, bucket = layout.visited(home, visits)
    times = 1 + len(np.unique(np.stack([row, bucket]), axis=1).T) / len(home)
    volume = int(count.sum()) * index.dim * np.dtype(index.kind).itemsize
    rounds = int(np.ceil(times * volume / max(ROUND * volume, LEAST_ROUND)))
    index.sample = None
    out = []
    for turn in range(rounds):
        placed = vectors.mapInArrow(lambda bs, turn=turn: _place(bs, index, layout, turn, rounds), KIND)
        met = placed.repartition("bucket").sortWithinPartitions("bucket", "visitor")
        out.append(saved(met.mapInArrow(lambda bs: _compare(bs, index, threshold), "a bigint, b bigint, n bigint"), "vector-links"))
    return reduce(DataFrame.unionAll, out)


def _home_cells(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches, max(index.dim, len(index.left), len(index.right)), CACHE):
        yield pa.RecordBatch.from_arrays([pa.array(index.home(_units(batch.column("v"), index.dim, index.kind)))], ["cell"])


def near_duplicates(df: DataFrame, threshold: float = 0.95, target: float = TARGET, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of each row.

    Null, empty and zero vectors and those with null or non-finite components
    link with nothing. Only vectors of one length are linked. Repeated rows each
    count. Rows of one id are one node of the graph; rows without an id have no
    component, are not kept, and count as partners only of equal vectors. An
    empty table gives no rows. Other columns are left out.
    """
    with _settings(df.sparkSession):
        packed, kind = _classes(df, vec_id, embedding)
        rows = saved(packed, "vectors")
        classes = rows.where("v is not null").groupBy("v").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
        classes = saved(classes.where("id is not null"), "vector-classes")
        index = build_index(classes, threshold, target, kind)
        if index:
            found = links(classes, index, threshold)
            graph = components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "id")
    alone = F.col("vec_id")
    if index is None:
        return rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), alone.alias("component_id"), alone.isNotNull().alias("kept"))
    digest = F.unhex(F.sha2("v", 256)).alias("digest")  # stands for the vector, which is longer, in the join
    counts = found.where("n is not null").groupBy("a").agg(F.sum("n").alias("n")).withColumnRenamed("a", "id")
    nodes = classes.select("id", "copies", digest).join(counts, "id", "left").join(graph, "id", "left")
    nodes = nodes.select("digest", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component"))
    joined = rows.select("vec_id", digest).join(nodes, "digest", "left")
    component = F.when(alone.isNotNull(), F.coalesce("component", alone))
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.coalesce(component == alone, F.lit(False)).alias("kept"))
