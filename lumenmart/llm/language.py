"""Language identification with bit-sliced Bloom filters of n-grams.

One table serves all languages: a row holds one bit per language, so column l
is the Bloom filter of language l, and the AND of the rows that an n-gram is
hashed to is the set of all languages that contain it. A text's n-grams give a
popcount per language. A filter with a share f of its bits set says yes to
f**HASHES of the n-grams that it doesn't hold; the counts are corrected for
that, and the language with the largest corrected count is the answer.

N-grams are those of the words of a text, letters only, in lower case, with one
mark at each end. To learn from, a text counts each of its different words
once, so one that repeats itself doesn't fill a filter. A language contains an
n-gram that makes up at least ``LEAST_SHARE`` of its n-grams of that length, unless the share is less than a ``NOISE``-th of that in
another language: passages in another tongue and wrong labels would otherwise
fill the filters alike. Shares don't change with the size of the corpus, so a
filter holds at most len(LENGTHS) / LEAST_SHARE n-grams however much text there
is. Counts cover all texts to learn from; they are summed per task, then
shuffled by language and n-gram. Rows of the table are made by a bitwise OR per
row on Spark, and only the finished table, some 12 rows for each n-gram of the
largest filter, comes to the driver.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenmart.llm.common import fresh_names, saved

#: Lengths of the n-grams, the share that an n-gram has at least in a language, and how much rarer than elsewhere it may be.
LENGTHS, LEAST_SHARE, NOISE = (2, 3, 4), 1e-4, 20
#: Rows that an n-gram is hashed to; rows of the table per n-gram of the largest filter (1 % false positives there).
HASHES, ROWS_PER_GRAM = 3, 12.4
#: Different words that a task holds before it passes on what they add up to; words that are scored together.
HELD_WORDS, PORTION = 1 << 18, 1 << 18
#: For texts without a letter.
UNDETERMINED = "und"

_LETTERS = re.compile(r"[^\W\d_]+")


def letter_words(text: str | None) -> list[str]:
    """Runs of letters, in lower case."""
    found = _LETTERS.findall((text or "").lower())
    if all(map(str.isalpha, found)):
        return found
    return [w for x in found for w in "".join(c if c.isalpha() else " " for c in x).split()]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def grams(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length, 64-bit hashes of the n-grams and the number of the word that each is from."""
    points = np.frombuffer("".join(f" {w} " for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    word = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    h = _mixed(points + np.uint64(0x51ED2701))
    for n in range(2, max(LENGTHS) + 1):
        if len(h) < 2:
            return
        h = _mixed(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + points[n - 1 :])
        if n in LENGTHS:
            whole = word[: len(h)] == word[n - 1 :]
            yield h[whole], word[: len(h)][whole]


def _row(gram: np.ndarray, k: int, rows: int) -> np.ndarray:
    step = np.uint64((k + 1) * 0x9E3779B97F4A7C15 % 2**64)
    return (_mixed(gram + step) % np.uint64(rows)).astype(np.int64)


def gram_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``size``, ``gram`` (a hash) and ``n``, over the whole texts of all rows with a language."""

    def summed(lang: str, words: Counter) -> Iterator[pa.RecordBatch]:
        weight = np.fromiter(words.values(), np.int64, len(words))
        for size, (gram, word) in zip(LENGTHS, grams(list(words)), strict=False):
            different, where = np.unique(gram, return_inverse=True)
            n = np.bincount(where, weight[word], len(different)).astype(np.int64)
            for i in range(0, len(different), 10_000):
                g = different[i : i + 10_000].view(np.int64)
                columns = [pa.array([lang] * len(g)), pa.array([size] * len(g), pa.int32()), pa.array(g), pa.array(n[i : i + 10_000])]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "size", "gram", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = held.setdefault(lang, Counter())
                words.update(set(letter_words(text)))
                if len(words) > HELD_WORDS:
                    yield from summed(lang, held.pop(lang))
        for lang, words in held.items():
            yield from summed(lang, words)

    counted = docs.where("lang is not null and text is not null").select("lang", "text").mapInArrow(count, "lang string, size int, gram bigint, n bigint")
    return counted.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Languages:
    """``names`` by falling number of documents; ``table`` has a row of 64-bit slices with one bit per language."""

    names: list[str]
    table: np.ndarray
    held: list[int]

    @property
    def false_rates(self) -> np.ndarray:
        bits = np.unpackbits(self.table.view(np.uint8), axis=1, bitorder="little")
        return bits.mean(axis=0)[: len(self.names)] ** HASHES

    def containing(self, gram: np.ndarray) -> np.ndarray:
        """One row of bits per n-gram: the languages that contain it."""
        slices = self.table[_row(gram, 0, len(self.table))]
        for k in range(1, HASHES):
            slices = slices & self.table[_row(gram, k, len(self.table))]
        return slices


def fit(docs: DataFrame, least_share: float = LEAST_SHARE) -> Languages | None:
    """The table of all languages in ``lang``; None without a text to learn from."""
    counts = saved(gram_counts(docs), "gram-counts")
    per_lang = docs.where("lang is not null and text is not null").groupBy("lang").agg(F.count("*").alias("docs"))
    totals = counts.groupBy("lang", "size").agg(F.sum("n").alias("all"))
    known = {r.lang for r in totals.select("lang").distinct().collect()}  # one row per language
    names = [r.lang for r in per_lang.orderBy(F.desc("docs"), "lang").collect() if r.lang in known]
    if not names:
        return None
    shares = counts.join(F.broadcast(totals), ["lang", "size"]).select("lang", "gram", (F.col("n") / F.col("all")).alias("share"))
    common = shares.where(F.col("share") >= least_share)
    most = common.groupBy("gram").agg(F.max("share").alias("most"))
    held = saved(common.join(most, "gram").where(F.col("share") * NOISE >= F.col("most")).select("lang", "gram"), "held-grams")
    sizes = {r.lang: r.n for r in held.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    rows = int(ROWS_PER_GRAM * max(sizes.values(), default=1)) + 64

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {lang: i for i, lang in enumerate(names)}
        for batch in batches:
            lang = np.array([number[x] for x in batch.column(0).to_pylist()], np.int64)
            gram = batch.column(1).to_numpy().view(np.uint64)
            bit = (np.uint64(1) << (lang % 64).astype(np.uint64)).view(np.int64)
            for k in range(HASHES):
                yield pa.RecordBatch.from_arrays([pa.array(_row(gram, k, rows)), pa.array(lang // 64), pa.array(bit)], ["row", "slice", "bits"])

    placed = held.mapInArrow(place, "row bigint, slice bigint, bits bigint").groupBy("row", "slice").agg(F.bit_or("bits").alias("bits"))
    found = placed.toArrow()
    table = np.zeros((rows, (len(names) + 63) // 64), np.uint64)
    if found.num_rows:
        table[found["row"].to_numpy(), found["slice"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return Languages(names, table, [sizes.get(x, 0) for x in names])


def _votes(model: Languages, words: list[str]) -> np.ndarray:
    """For each word: its n-grams, and how many of them each language contains."""
    out = np.zeros((len(words), 1 + len(model.names)), np.int64)
    for gram, word in grams(words):
        for i in range(0, len(gram), PORTION):
            slices, at = model.containing(gram[i : i + PORTION]), word[i : i + PORTION]
            out[:, 0] += np.bincount(at, minlength=len(words))
            for k in range(len(model.names)):
                bit = (slices[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)
                out[:, 1 + k] += np.bincount(at[bit == 1], minlength=len(words))
    return out


def _portions(texts: list[str | None]) -> Iterator[list[list[str]]]:
    held, n = [], 0
    for t in texts:
        words = letter_words(t)
        if held and n + len(words) > PORTION:
            yield held
            held, n = [], 0
        held.append(words)
        n += len(words)
    if held:
        yield held


def identify(model: Languages | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """The language of each text and the share of its n-grams that the language contains, corrected."""
    names: list[str] = []
    scores: list[float] = []
    rates = model.false_rates if model else None
    for portion in _portions(texts):
        number: dict[str, int] = {}
        for words in portion:
            for w in words:
                if w not in number:
                    number[w] = len(number)
        if not model or not number:
            names += [model.names[0] if model and words else UNDETERMINED for words in portion]
            scores += [0.0] * len(portion)
            continue
        votes = _votes(model, list(number))
        for words in portion:
            if not words:
                names.append(UNDETERMINED)
                scores.append(0.0)
                continue
            times = np.bincount(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
            used = np.flatnonzero(times)
            all_, *hits = (times[used] @ votes[used]).tolist()
            share = np.maximum(np.array(hits) - all_ * rates, 0) / (1 - rates) / all_
            best = int(share.argmax())
            names.append(model.names[best])
            scores.append(min(float(share[best]), 1.0))
    return names, scores


def with_language(df: DataFrame, model: Languages | None, text: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score``.

    A null text, or one without a letter, is ``und`` with score 0, as is every
    text where nothing was learned. A text with letters always gets a learned
    language; the one with more documents, then the smaller name, wins ties and
    texts whose n-grams no language contains (score 0). Repeated rows give
    equal results, very long texts are taken whole, an empty table stays empty.
    Columns of the two names are replaced, others stay.
    """

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            names, scores = identify(model, batch.to_pylist())
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    (name,) = fresh_names(df, "found")
    out = df.withColumn(name, predicted(F.col(text)))
    return out.withColumns({"lang_pred": F.col(f"{name}.lang_pred"), "score": F.col(f"{name}.score")}).drop(name)
