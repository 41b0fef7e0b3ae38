"""Context-tree weighting over bytes.

A text is the sequence of its lower-cased words, each closed by a space, and a
line break at the end. A byte is coded as eight binary decisions. The decision
nodes of a byte hang below each of its contexts: the last 0 to ``DEPTH`` bytes
of the running text (before it, spaces), or without ``across_words`` of the word.
Every node holds a Krichevsky-Trofimov estimate of its zeros and ones in the
training documents, and a node's weighted probability is half its own estimate's
and half the product of its longer contexts'. Predicting mixes the estimates of
all depths by these posterior weights, which gives each byte its code length.

Work goes by different grams (a context of ``DEPTH`` bytes and the byte after
it) of a block of documents, not by bytes:

1. Documents are dealt into blocks of some ``BLOCK_CHARS`` characters where they lie.
2. A block counts its different grams and words. They are packed by part (a hash
   of a gram's last two context bytes, or of a word), as sorted numbers and counts.
3. Packs of a part are summed, ``FAN`` blocks at a time. A part holds whole
   subtrees of the two levels above, which have at most 256 contexts; so a part
   gives the nodes for those, and then the code length of each of its grams.
4. The packs come back to their blocks with code lengths and the words' counts,
   ``FAN`` blocks at a time from a copy of their part's table. A block looks its
   bytes and words up in them.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenmart.llm.common import saved

DEPTH, BLOCK_CHARS = 6, 48_000_000
#: Parts of the grams, and blocks whose packs meet in one group.
PARTS, FAN = 1024, 64
#: Bytes that are looked at together, and grams that are sorted together.
_BYTES, _GRAMS = 1 << 20, 1 << 21
#: Code lengths are handed on in steps of a millionth of a decimal digit.
_STEP = 2.0**-20
_PAD, _END = b" " * DEPTH, b"\n"


def words_of(text: str) -> list[bytes]:
    return text.encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits


# --- grams ---------------------------------------------------------------------------


def _codes(data: bytes) -> np.ndarray:
    """The gram of every byte behind the first ``DEPTH``."""
    codes, width = np.frombuffer(data, np.uint8).astype(np.int64), 1
    # strings of 1, 2, 4 and then 7 bytes, each of a shorter one and the bytes that follow it
    while width <= DEPTH and len(codes):
        more = min(width, DEPTH + 1 - width)
        codes = codes[: max(0, len(codes) - more)] << 8 * more | codes[more:] & ((1 << 8 * more) - 1)
        width += more
    return codes


def grams_of(words: list[bytes]) -> np.ndarray:
    """The grams of the words and their closing spaces, each word by itself."""
    lengths = np.array([len(w) + 1 for w in words], np.int64)
    within = np.arange(lengths.sum()) + np.repeat(np.arange(len(words)) * DEPTH, lengths)
    return _codes(b"".join([_PAD + w + b" " for w in words]))[within]


def text_grams(words: list[bytes], across_words: bool) -> Iterator[np.ndarray]:
    """The grams of every byte of a text, some ``_BYTES`` at a time."""
    if across_words:
        running = _PAD + b"".join([w + b" " for w in words]) + _END
        for at in range(0, len(running) - DEPTH, _BYTES):
            yield _codes(running[at : at + _BYTES + DEPTH])
        return
    for at in range(0, len(words), _BYTES >> 4):
        yield grams_of(words[at : at + (_BYTES >> 4)])
    yield _codes(_PAD + _END)


def pack(numbers: np.ndarray) -> bytes:
    """All first bytes, then all second bytes and so on: sorted or small numbers compress well this way."""
    return numbers.view(np.uint8).reshape(len(numbers), numbers.itemsize).T.tobytes()


def unpack(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8).reshape(size, len(data) // size).T.copy().view(kind).ravel()


def part_of(codes: np.ndarray) -> np.ndarray:
    return ((codes >> 8 & 0xFFFF) * 40503 & 0xFFFF) * PARTS >> 16


def join_words(words: list[bytes]) -> bytes:
    return b" ".join(words)  # no word holds a space


def split_words(data: bytes) -> list[bytes]:
    return data.split(b" ") if data else []


def first_of_equal(ordered: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([np.ones(min(1, len(ordered)), bool), ordered[1:] != ordered[:-1]]))


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The different keys in order, and the sums of their counts."""
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")  # merges runs that are sorted already
    key, count = key[order], count[order]
    begins = first_of_equal(key)
    return key[begins], np.add.reduceat(count, begins) if len(key) else count


class Counts:
    """Grams and words of a block, with their times in training texts."""

    def __init__(self):
        self.new: list[np.ndarray] = []
        self.size = 0
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []
        self.words: Counter = Counter()
        self.others: set[bytes] = set()

    def add(self, text: str, train: bool, across_words: bool) -> None:
        words = words_of(text)
        for codes in text_grams(words, across_words):
            codes <<= 1
            codes |= train
            self.new.append(codes)
            self.size += len(codes)
            if self.size >= _GRAMS:
                self.sort_new()
        words.append(_END)
        self.words.update(words) if train else self.others.update(words)

    def sort_new(self) -> None:
        """One more run; runs are merged when the later ones outgrow the first, so that each gram is merged a few times."""
        if self.new:
            marked = np.concatenate(self.new)
            self.new, self.size = [], 0
            marked.sort()
            begins = first_of_equal(marked >> 1)
            keys = marked[begins] >> 1
            marked &= 1
            self.runs.append((keys, np.add.reduceat(marked, begins)))
            if sum(len(k) for k, _ in self.runs[1:]) > max(_GRAMS, len(self.runs[0][0])):
                self.merge()

    def merge(self) -> None:
        none = np.zeros(0, np.int64)
        self.runs = [summed([k for k, _ in self.runs] or [none], [n for _, n in self.runs] or [none])]

    def rows(self, block: int) -> Iterator[pa.RecordBatch]:
        self.sort_new()
        self.merge()
        keys, n = self.runs[0]
        part = part_of(keys)
        order = np.argsort(part, kind="stable")
        ends = np.searchsorted(part[order], np.arange(PARTS + 1))
        times = dict.fromkeys(self.others, 0) | self.words
        words: dict[int, list[bytes]] = defaultdict(list)
        for word in times:
            words[zlib.crc32(word) % PARTS].append(word)
        for p in range(PARTS):
            at, own = order[ends[p] : ends[p + 1]], words[p]
            if len(at) or own:
                counted = np.array([times[w] for w in own], np.int64)
                row = {"block": block, "part": p, "grams": pack(keys[at]), "n": pack(n[at]), "words": join_words(own), "times": pack(counted)}
                yield pa.RecordBatch.from_pylist([row], PACKS)


PACKS = pa.schema([("block", pa.int64()), ("part", pa.int32()), *((c, pa.binary()) for c in ("grams", "n", "words", "times"))])


def deal(docs: DataFrame) -> DataFrame:
    """Rows with a ``block``: neighbours with ``BLOCK_CHARS`` characters, and the row that goes beyond."""

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, chars = TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            own = []
            for size in batch.column("size").to_pylist():
                if chars >= BLOCK_CHARS:
                    block, chars = block + 1, 0
                own.append(block)
                chars += size
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), *batch.columns[:-1]], ["block", *batch.schema.names[:-1]])

    chars = docs.agg(F.sum(F.length("text").cast("bigint"))).first()[0] or 0
    # fewer, larger blocks where the partitions are small; with larger partitions this changes nothing
    together = docs.coalesce(max(1, -(-chars // BLOCK_CHARS)))
    return together.withColumn("size", F.length("text")).mapInArrow(numbered, f"block bigint, {', '.join(f'{c} {t}' for c, t in docs.dtypes)}")


def count(dealt: DataFrame, across_words: bool) -> DataFrame:
    """Per block and part its grams and words with their times in training. A block may come in several pieces."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, counts = None, Counts()
        for batch in batches:
            for own, text, train in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                if own != block:
                    if block is not None:
                        yield from counts.rows(block)
                    block, counts = own, Counts()
                counts.add(text.as_py(), train, across_words)
        if block is not None:
            yield from counts.rows(block)

    schema = "block bigint, part int, grams binary, n binary, words binary, times binary"
    return dealt.select("block", "text", (~F.col("held_out")).alias("train")).mapInArrow(counted, schema)


def merged(packs: DataFrame, blocks: int) -> DataFrame:
    """The packs of each part summed, ``FAN`` blocks at a time, with the ``tokens`` and ``types`` of training in it."""

    def add_up(rows: pa.Table) -> pa.Table:
        grams, n = summed([unpack(x, np.int64) for x in rows["grams"].to_pylist()], [unpack(x, np.int64) for x in rows["n"].to_pylist()])
        times: Counter = Counter()
        for own, count in zip(rows["words"].to_pylist(), rows["times"].to_pylist(), strict=True):
            for word, k in zip(split_words(own), unpack(count, np.int64).tolist(), strict=True):
                times[word] += k
        counts = np.array(list(times.values()), np.int64)
        packed = {"grams": pack(grams), "n": pack(n), "words": join_words(list(times)), "times": pack(counts)}
        numbers = {"tokens": int(counts.sum()), "types": int((counts > 0).sum())}
        return pa.table({"part": rows["part"][:1], "block": rows["block"][:1]} | {k: [v] for k, v in (packed | numbers).items()})

    tasks = min(PARTS, int(packs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    schema = "part int, block bigint, grams binary, n binary, words binary, times binary, tokens bigint, types bigint"
    while True:
        blocks = max(1, -(-blocks // FAN))
        packs = packs.withColumn("block", F.pmod(F.xxhash64("block"), F.lit(blocks)))
        # as many tasks as asked for, since little data means much work here
        packs = (packs.repartition(tasks, "part") if blocks == 1 else packs).groupBy("part", "block").applyInArrow(add_up, schema)
        if blocks == 1:
            return packs.drop("block")


# --- the tree ------------------------------------------------------------------------


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after moving x up by six."""
    y = x + 6
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5))


def _block(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability that the Krichevsky-Trofimov estimator gives to so many zeros and ones."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0) - np.log(np.pi)


def nodes_at(codes: np.ndarray, counts: np.ndarray, depth: int) -> list[dict]:
    """For each of the eight decisions, the nodes below the contexts of one depth: keys, counts, and each gram's node."""
    context = (codes >> 8) & ((1 << 8 * depth) - 1)
    out = []
    for bit in range(8):
        prefix = (codes & 255) >> (8 - bit) | 1 << bit
        keys, at = np.unique(context << 8 | prefix, return_inverse=True)
        one = (codes >> (7 - bit)) & 1
        ones = np.bincount(at, counts * one, len(keys))
        zeros = np.bincount(at, counts, len(keys)) - ones
        out.append({"keys": keys, "at": at, "zeros": zeros, "ones": ones, "own": _block(zeros, ones)})
    return out


def weigh(levels: dict[int, list[dict]], deepest: int, top: int) -> None:
    """Adds the log weighted probability ``all`` to the nodes from the deepest level up to ``top``."""
    for depth in range(deepest, top - 1, -1):
        for bit, node in enumerate(levels[depth]):
            if depth == deepest and "all" not in node:
                node["all"] = node["own"]
            elif "all" not in node:
                child = levels[depth + 1][bit]
                parent = (child["keys"] >> 8 & ((1 << 8 * depth) - 1)) << 8 | child["keys"] & 255
                below = np.bincount(np.searchsorted(node["keys"], parent), child["all"], len(node["keys"]))
                node["all"] = np.logaddexp(node["own"], below) - np.log(2)


def _estimate(node: dict, one: np.ndarray) -> np.ndarray:
    at = node["at"]
    return (np.where(one, node["ones"][at], node["zeros"][at]) + 0.5) / (node["zeros"][at] + node["ones"][at] + 1)


def _share(node: dict) -> np.ndarray:
    """Posterior weight of the node's own estimate."""
    return np.exp(np.minimum(node["own"] - np.log(2) - node["all"], 0))[node["at"]]


def code_lengths(codes: np.ndarray, levels: dict[int, list[dict]]) -> np.ndarray:
    """Log10 probability of each gram's byte; ``levels`` has all depths, weighed, with the grams' nodes."""
    out = np.zeros(len(codes))
    for bit in range(8):
        one = (codes >> (7 - bit)) & 1 == 1
        p = _estimate(levels[DEPTH][bit], one)
        for depth in range(DEPTH - 1, -1, -1):
            node = levels[depth][bit]
            share = _share(node)
            p = share * _estimate(node, one) + (1 - share) * p
        out += np.log10(p)
    return out


def _levels(codes: np.ndarray, counts: np.ndarray) -> dict[int, list[dict]]:
    levels = {d: nodes_at(codes, counts.astype(np.float64), d) for d in range(2, DEPTH + 1)}
    weigh(levels, DEPTH, 2)
    return levels


def tree_table(parts: DataFrame) -> DataFrame:
    """``part``, ``grams`` and their ``logp``, from the parts' ``grams`` and counts ``n`` in training."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for batch in batches:
            for row in batch.to_pylist():
                yield row["part"], unpack(row["grams"], np.int64), unpack(row["n"], np.int64)

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, codes, counts in each(batches):
            if not len(codes):  # words only
                continue
            for bit, node in enumerate(_levels(codes, counts)[2]):
                columns = [np.full(len(node["keys"]), bit, np.int32), node["keys"], node["zeros"], node["ones"], node["all"]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["bit", "key", "zeros", "ones", "whole"])

    # two context bytes and a node of the byte: at most 2**16 * 255 rows, some 2,000 * 60 in texts
    rows = parts.mapInArrow(tops, "bit int, key bigint, zeros double, ones double, whole double")
    found = rows.toArrow().to_pandas().sort_values(["bit", "key"])
    upper: dict[int, list[dict]] = {0: [], 1: [], 2: []}
    for bit in range(8):
        own = found[found["bit"] == bit]
        upper[2].append({"keys": own["key"].to_numpy(), "zeros": own["zeros"].to_numpy(), "ones": own["ones"].to_numpy(), "all": own["whole"].to_numpy()})
        for depth in (1, 0):
            child = upper[depth + 1][bit]
            parent = (child["keys"] >> 8 & ((1 << 8 * depth) - 1)) << 8 | child["keys"] & 255
            keys, at = np.unique(parent, return_inverse=True)
            node = {"keys": keys, "zeros": np.bincount(at, child["zeros"], len(keys)), "ones": np.bincount(at, child["ones"], len(keys))}
            node["own"] = _block(node["zeros"], node["ones"])
            upper[depth].append(node)
    weigh(upper, 2, 0)
    above = {d: [{k: x[k] for k in ("keys", "zeros", "ones", "own", "all")} for x in upper[d]] for d in (0, 1)}  # 257 contexts at most

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, codes, counts in each(batches):
            levels = _levels(codes, counts) if len(codes) else {}
            for d in (0, 1) if levels else ():
                context = (codes >> 8) & ((1 << 8 * d) - 1)
                levels[d] = [x | {"at": np.searchsorted(x["keys"], context << 8 | (codes & 255) >> (8 - b) | 1 << b)} for b, x in enumerate(above[d])]
            logp = np.rint((code_lengths(codes, levels) if levels else np.zeros(0)) / -_STEP).astype(np.int32)
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "grams": [pack(codes)], "logp": [pack(logp)]})

    return parts.mapInArrow(predict, "part int, grams binary, logp binary")


# --- documents -----------------------------------------------------------------------


def _answers(packs: DataFrame, table: DataFrame, blocks: int) -> DataFrame:
    """The packs' ``block``, ``grams`` and ``words`` with their ``logp`` and ``times``."""
    schema = "block bigint, grams binary, logp binary, words binary, times binary"

    def look_up(asked: pa.Table, table: pa.Table) -> pa.Table:
        grams, logp, times = np.zeros(0, np.int64), np.zeros(0, np.int32), {}
        for row in table.to_pylist():  # one
            grams, logp = unpack(row["grams"], np.int64), unpack(row["logp"], np.int32)
            times = dict(zip(split_words(row["words"]), unpack(row["times"], np.int64).tolist(), strict=True))
        found = [pack(logp[np.searchsorted(grams, unpack(x, np.int64))]) for x in asked["grams"].to_pylist()]
        counts = [pack(np.array([times[w] for w in split_words(x)], np.int64)) for x in asked["words"].to_pylist()]
        columns = [asked["block"], asked["grams"], pa.array(found, pa.binary()), asked["words"], pa.array(counts, pa.binary())]
        return pa.table(columns, ["block", "grams", "logp", "words", "times"])

    groups = max(1, -(-blocks // FAN))
    asked = packs.select("part", F.pmod(F.xxhash64("block"), F.lit(groups).cast("bigint")).alias("group"), "block", "grams", "words")
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint")))
    copies = table.select("part", copies.alias("group"), "grams", "logp", "words", "times")
    return asked.groupBy("part", "group").cogroup(copies.groupBy("part", "group")).applyInArrow(look_up, schema)


def score(df: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", across_words: bool = False) -> DataFrame:
    """Scores of every row: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``,
    ``score`` (log10 probability of the text) and ``bits_per_byte``.

    Trained on the rows where ``held_out`` is false. Tokens are words and one
    end per row; the base is the add-one unigram model over them. A null text
    counts as empty and holds its end alone. Repeated rows each train and are
    scored alike. Without training rows all estimates are even. An empty table
    gives no rows. Other columns are left out.
    """
    docs = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), held_out.alias("held_out"))
    docs = docs.withColumn("held_out", F.coalesce("held_out", F.lit(False)))
    dealt = saved(deal(docs), "dealt", compression="zstd")
    counts = saved(count(dealt, across_words), "block-counts", compression="zstd")
    blocks = counts.agg(F.count_distinct("block")).first()[0]
    sums = saved(merged(counts, blocks), "grams", compression="zstd")
    table = saved(tree_table(sums), "code-lengths", compression="zstd").join(sums.select("part", "words", "times"), "part")
    known = sums.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("types"), F.lit(0)).alias("types")).first()
    tokens, floor = known.tokens, float(np.log10(known.tokens + known.types + 1))
    told = _answers(counts, table, blocks)

    def tell(block: pa.Table, told: pa.Table) -> pa.Table:
        grams = np.concatenate([np.zeros(0, np.int64), *(unpack(x, np.int64) for x in told["grams"].to_pylist())])
        steps = np.concatenate([np.zeros(0, np.int32), *(unpack(x, np.int32) for x in told["logp"].to_pylist())])
        order = np.argsort(grams)
        grams, logp = grams[order], steps[order] * -_STEP
        times: dict[bytes, int] = {}
        for words, counts in zip(told["words"].to_pylist(), told["times"].to_pylist(), strict=True):
            times.update(zip(split_words(words), unpack(counts, np.int64).tolist(), strict=True))
        scores, sizes = np.zeros(block.num_rows), np.zeros(block.num_rows)

        def add(numbers: list[int], codes: list[np.ndarray]) -> None:
            lengths, codes = [len(c) for c in codes], np.concatenate(codes)
            order = np.argsort(codes)  # ascending look-ups stay in the processor's cache
            found = np.empty(len(codes))
            found[order] = logp[np.searchsorted(grams, codes[order])]
            np.add.at(scores, numbers, np.add.reduceat(found, np.cumsum([0, *lengths[:-1]])))
            np.add.at(sizes, numbers, lengths)

        rows, held, size = [], ([], []), 0
        for number, text in enumerate(block["text"]):
            own = words_of(text.as_py())
            for codes in filter(len, text_grams(own, across_words)):
                held[0].append(number)
                held[1].append(codes)
                size += len(codes)
                if size >= _BYTES:
                    add(*held)
                    held, size = ([], []), 0
            own.append(_END)
            n = np.fromiter(map(times.__getitem__, own), np.float64, len(own))
            rows.append((len(n), int((n > 0).sum()), (np.log10(n + 1) - floor).sum()))
        if held[0]:
            add(*held)
        rows = [(*row, score, -score * np.log2(10) / n_bytes) for row, score, n_bytes in zip(rows, scores, sizes, strict=True)]
        out = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), *[pa.float64()] * 3), strict=True)]
        given = {"doc_id": block["doc_id"], "held_out": block["held_out"]}
        return pa.table(given | dict(zip(("n_tokens", "n_known", "base_score", "score", "bits_per_byte"), out, strict=True)))

    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double, bits_per_byte double"
    scored = dealt.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(tell, schema).withColumn("train_tokens", F.lit(tokens).cast("bigint"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")
