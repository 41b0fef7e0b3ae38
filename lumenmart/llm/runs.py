"""Periodic runs of words, found with string synchronising sets.

A run is a maximal stretch of words with smallest period ``q`` that is at least
``LEAST_EXPONENT`` periods long. Periods below ``SMALL`` are read off directly
from words that equal the word ``q`` before; these highly periodic regions are
also what the synchronising sets leave out. For the other periods there is a
set of positions for each scale t = SMALL, 2 SMALL, 4 SMALL, ...: position i
belongs to it if the smallest hash of a stretch of t words that starts in
[i, i + t] is that of i or of i + t, where stretches with a period of t/4 or
less don't count. Membership depends on the 2t words from i on alone, so equal
contexts are either all members or none is, and any 2t neighbouring positions
that are not highly periodic hold a member among the first t.

A run with period p in [t, 2t) is at least 4p long. It holds a member s among
its first t positions, and the context of s, 2t words, comes again at s + p
and nowhere between, or the run had a smaller period. So pairs of neighbouring
members with equal contexts, t to 2t apart, propose all periods. A proposal is
kept if equality reaches four periods by the hashes of dyadic stretches, and is
then extended over the words themselves, so no run is ever reported by hash
alone; two different contexts under one 64-bit hash could at most hide a run.

The work is n log n for n words and vectorised over many texts at once: texts
of a batch stand one after another, the longest first, with a word that occurs
nowhere else after each, and a scale looks only at texts that have 4t words.
Nothing is shuffled. A text's arrays take some 8 log2(n) bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenmart.llm.common import fresh_names

#: Periods that are read off directly; the first scale. A power of two, at least 4.
SMALL = 8
#: Periods that a run has at least, and words.
LEAST_EXPONENT, LEAST_LENGTH = 4, 6
#: Words that are looked at together; a longer text is looked at alone.
BATCH_WORDS = 1 << 18

_NONE = np.uint64(2**64 - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers by shifts and odd factors."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _doubled(h: np.ndarray, reach: int) -> np.ndarray:
    """Hashes of stretches twice as long, from those of length ``reach``."""
    if len(h) <= reach:
        return h[:0]
    return _mixed(h[:-reach] * np.uint64(0x9E3779B97F4A7C15) + h[reach:])


def _stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each stretch of true flags."""
    turns = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return turns[::2], turns[1::2]


def _small_runs(w: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of the runs with a period below ``SMALL``, smallest periods first."""
    found: dict[tuple[int, int], int] = {}
    for q in range(1, SMALL):
        if len(w) < LEAST_EXPONENT * q:
            break
        start, end = _stretches(w[q:] == w[:-q])
        end = end + q
        long = end - start >= LEAST_EXPONENT * q
        for a, b in zip(start[long].tolist(), end[long].tolist(), strict=True):
            found.setdefault((a, b), q)  # the same stretch with a divisor of q is that run
    return [(a, b, q) for (a, b), q in found.items()]


def _lce(levels: list[np.ndarray], x: np.ndarray, y: np.ndarray, forward: bool) -> np.ndarray:
    """How far words agree from x and y on (or before them), up to eight times the longest stretch."""
    out = np.zeros(len(x), np.int64)
    live = np.ones(len(x), bool)
    for k in [len(levels) - 1] * 8 + list(range(len(levels) - 2, -1, -1)):
        h, reach = levels[k], 1 << k
        a, b = (x + out, y + out) if forward else (x - out - reach, y - out - reach)
        inside = live if k == len(levels) - 1 else np.ones(len(x), bool)
        inside = inside & (np.maximum(a, b) < len(h)) & (np.minimum(a, b) >= 0)
        same = np.zeros(len(x), bool)
        same[inside] = h[a[inside]] == h[b[inside]]
        out[same] += reach
        live &= same
    return out


def _agree(w: np.ndarray, x: int, y: int, forward: bool) -> int:
    """Words that agree from x and y on (or before them), compared in growing pieces."""
    out, step = 0, 64
    while True:
        if forward:
            a, b = w[x + out : x + out + step], w[y + out : y + out + step]
            n = min(len(a), len(b))
            a, b = a[:n], b[:n]
        else:
            n = min(step, x - out, y - out)
            a, b = w[x - out - n : x - out][::-1], w[y - out - n : y - out][::-1]
        if not n:
            return out
        other = np.flatnonzero(a != b)
        if len(other):
            return out + int(other[0])
        out, step = out + n, step * 2


def _members(h: np.ndarray, t: int, periodic: list[tuple[int, int, int]]) -> np.ndarray:
    """Positions of the synchronising set of scale t; ``h`` are the hashes of t words."""
    ids = h.copy()
    for a, b, q in periodic:
        if 4 * q <= t and b - a >= t:
            ids[a : b - t + 1] = _NONE
    least, width = ids, 1
    while width < t:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if len(ids) <= t or not len(least):
        return np.zeros(0, np.int64)
    ends = ids[t:]
    least = np.minimum(least[: len(ends)], ends)  # of the t + 1 stretches that start in [i, i + t]
    return np.flatnonzero((least != _NONE) & ((least == ids[: len(least)]) | (least == ends[: len(least)])))


def _proposals(levels: list[np.ndarray], members: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Members and the distance to the next one with an equal context, where the two may lie in a run."""
    context = levels[-1]  # of 2t words
    members = members[members < len(context)]
    order = np.argsort(context[members], kind="stable")
    at, key = members[order], context[members][order]
    x, d = at[:-1], np.diff(at)
    near = (key[1:] == key[:-1]) & (d >= t) & (d < 2 * t)
    x, d = x[near], d[near]
    right = _lce(levels, x + 2 * t, x + d + 2 * t, True)
    left = _lce(levels, x, x + d, False)
    far = left + 2 * t + right + d >= LEAST_EXPONENT * d
    return x[far], d[far]


def runs_of_words(w: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs, by start in ``w``.

    ``w`` holds the numbers of the words of several texts one after another,
    each with a last word that occurs nowhere else; ``sizes`` are the texts'
    lengths with it, in falling order.
    """
    found = _small_runs(w)
    if not len(sizes):
        return found
    ends = np.cumsum(sizes)
    levels = [_mixed(w.astype(np.uint64) + np.uint64(0x51ED2701))]
    for k in range(1, SMALL.bit_length()):
        levels.append(_doubled(levels[-1], 1 << (k - 1)))
    t = SMALL
    while (texts := int(np.searchsorted(-sizes, -(LEAST_EXPONENT * t), side="right"))) > 0:
        n = int(ends[texts - 1])  # texts that may hold a run of this scale come first
        levels = [h[: max(n - (1 << k) + 1, 0)] for k, h in enumerate(levels)]
        periodic = [r for r in found if r[0] < n]
        members = _members(levels[-1], t, periodic)
        levels.append(_doubled(levels[-1], t))
        x, d = _proposals(levels, members, t)
        part, seen = w[:n], {}
        for s, p in sorted(zip(x.tolist(), d.tolist(), strict=True)):
            if seen.get(p, -1) >= s + p:  # lies in the run that was found last for this period
                continue
            start, end = s - _agree(part, s, s + p, False), s + p + _agree(part, s, s + p, True)
            seen[p] = end
            if end - start >= LEAST_EXPONENT * p:
                found.append((start, end, p))
        t *= 2
    return sorted(set(found))


def runs_of_texts(texts: list[list[bytes]], least_length: int = LEAST_LENGTH) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each text, by start and period."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    number: dict[bytes, int] = {}
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    pieces, sizes = [], []
    for i in order:
        for word in texts[i]:
            if word not in number:
                number[word] = len(number)
        pieces.append(np.fromiter(map(number.__getitem__, texts[i]), np.int64, len(texts[i])))
        sizes.append(len(texts[i]) + 1)
    whole = np.concatenate([np.append(p, -1 - k) for k, p in enumerate(pieces)]) if pieces else np.zeros(0, np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    for a, b, q in runs_of_words(whole, np.array(sizes, np.int64)):
        if b - a >= least_length:
            k = int(np.searchsorted(starts, a, side="right")) - 1
            out[order[k]].append((a - int(starts[k]), b - a, q))
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in out]


def without_repeats(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Words that no run contains after its first period."""
    if not runs:
        return words
    drop = np.zeros(len(words), bool)
    for start, length, period in runs:
        drop[start + period : start + length] = True
    return [w for w, gone in zip(words, drop.tolist(), strict=True) if not gone]


def _portions(texts: list[bytes | None]) -> Iterator[list[list[bytes]]]:
    """Texts as words, in portions of about ``BATCH_WORDS`` words."""
    held, n = [], 0
    for t in texts:
        words = (t or b"").split()  # splits at the six ASCII white-space characters
        if held and n + len(words) > BATCH_WORDS:
            yield held
            held, n = [], 0
        held.append(words)
        n += len(words)
    if held:
        yield held


def with_runs(df: DataFrame, text: str = "text", least_length: int = LEAST_LENGTH) -> DataFrame:
    """Adds ``n_words``, ``runs`` (start, length and period of each, by start and period) and ``collapsed``.

    Words are what stands between the six ASCII white-space characters;
    ``collapsed`` joins those by one space that no run contains after its first
    period. A null, empty or blank text has no words, no runs and an empty
    ``collapsed``. Ties need no rule: all runs are listed. Repeated rows give
    equal results; very long texts are taken whole; an empty table stays empty.
    Columns of the three names are replaced, others stay as they are.
    """
    kind = "struct<n_words:bigint,runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:binary>"
    arrow = pa.struct(
        [
            ("n_words", pa.int64()),
            ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
            ("collapsed", pa.binary()),
        ]
    )

    @F.arrow_udf(kind)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = []
            for portion in _portions(batch.to_pylist()):
                for words, runs in zip(portion, runs_of_texts(portion, least_length), strict=True):
                    listed = [{"start": s, "length": n, "period": q} for s, n, q in runs]
                    rows.append({"n_words": len(words), "runs": listed, "collapsed": b" ".join(without_repeats(words, runs))})
            yield pa.array(rows, arrow)

    (name,) = fresh_names(df, "found")
    out = df.withColumn(name, found(F.col(text).cast("binary")))
    added = {"n_words": F.col(f"{name}.n_words"), "runs": F.col(f"{name}.runs"), "collapsed": F.col(f"{name}.collapsed").cast("string")}
    return out.withColumns(added).drop(name)
