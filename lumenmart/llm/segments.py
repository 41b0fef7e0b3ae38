"""Token ids of whole texts from a memo of their space-delimited pieces.

A byte-level pre-token holds white space only as one leading space or as a run
of white space. So a text may be cut before every space and around every line
break whose neighbours are not white space, and the pieces encoded on their
own. Pieces repeat a lot, so each process encodes a piece once and keeps its
ids as little-endian 32-bit integers. Texts with longer runs of white space
are cut by the tokenizer's own pattern as a whole.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable

import numpy as np
import pyarrow as pa

_RUN = re.compile(r"\s[ \n]|[ \n]\s")
#: White space other than spaces and line breaks; none of it lies above U+3000.
_OTHER_SPACE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
#: A Latin word and the punctuation after it are two pre-tokens, found here without the pattern.
_WORD = re.compile("( ?[A-Za-zÀ-ÖØ-öø-ɏ]+)([.,;:!?]*)").fullmatch
#: Pieces that a process keeps, twice: those in use and those of the generation before.
MEMO_PIECES = 150_000


class Memo(dict):
    """A dictionary that makes missing values. Of the last ``most`` values and as many before, those in use are kept."""

    def __init__(self, make: Callable, most: int = MEMO_PIECES):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        value = self.old.get(key, self)
        if value is self:
            value = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def id_bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}i", *ids)


def has_run(text: str) -> bool:
    """Whether white space follows white space, one of them a space or line break. Plain searches go before the pattern."""
    if "  " in text or "\n\n" in text or " \n" in text or "\n " in text:
        return True
    return any(c in text for c in _OTHER_SPACE) and _RUN.search(text) is not None


class Segments:
    """``encode(text)`` gives the ids' bytes, from ``cut`` (text to pre-tokens) and ``merge`` (pre-token to ids' bytes)."""

    def __init__(self, cut: Callable[[str], list[str]], merge: Callable[[str], bytes], most: int = MEMO_PIECES):
        self.cut = cut
        self.pre_token = Memo(merge, most)
        self.first = Memo(self.piece, most // 4)
        self.spaced = Memo(lambda p: self.piece(" " + p), most)
        self.line_break = self.piece("\n")

    def piece(self, text: str) -> bytes:
        known = self.pre_token
        if word := _WORD(text):
            return known[word[1]] + known[word[2]] if word[2] else known[word[1]]
        return b"".join([known[p] for p in self.cut(text)])

    def encode(self, text: str) -> bytes:
        if has_run(text):
            return self.piece(text)
        first, spaced, out = self.first, self.spaced.__getitem__, []
        for line in text.split("\n"):
            head, *rest = line.split(" ")
            out.append(first[head])
            out.extend(map(spaced, rest))
            out.append(self.line_break)
        out.pop()
        return b"".join(out)


def id_lists(buffers: list[bytes]) -> pa.ListArray:
    """Arrow lists of 32-bit integers from their bytes."""
    ends = np.cumsum([0, *(len(b) // 4 for b in buffers)], dtype=np.int64)
    values = np.frombuffer(b"".join(buffers), dtype="<i4")
    if ends[-1] > np.iinfo(np.int32).max:
        raise ValueError("over 2**31 ids in one batch; lower spark.sql.execution.arrow.maxRecordsPerBatch")
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values))
