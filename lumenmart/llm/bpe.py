"""Byte-level BPE encoding and decoding with a sentencepiece model made from the ranks.

The vocabulary file lists byte strings and ranks. Every byte is written as one
printable character, so each entry becomes a piece whose score is its negative
rank, and merging the best-scored neighbours is merging the lowest rank first.
The model is serialised from the vocabulary; nothing is trained. Pre-tokens are
encoded one by one, so no merge crosses their borders; an entry of the
vocabulary that is a pre-token itself is taken whole. Decoding maps ids back to
bytes.

Nulls count as empty texts; empty texts have no ids; rows are independent, so
repeated rows, ties and empty tables need no rule. A column named like the
result is replaced.
"""

from __future__ import annotations

import base64
from codecs import charmap_decode
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenmart.llm.segments import MEMO_PIECES, Segments, id_bytes, id_lists


def read_ranks(path: str) -> dict[bytes, int]:
    """Byte string -> rank of a rank file, one base64 entry and its rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


@lru_cache(1)
def byte_letters() -> dict[int, str]:
    """One printable character for each byte: itself if printable Latin-1, else the next free one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


@lru_cache(1)
def letters_table() -> str:
    """The characters of bytes 0 to 255 in a row, as ``charmap_decode`` takes them."""
    return "".join(byte_letters()[b] for b in range(256))


def serialised_model(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece BPE model whose ids are the ranks, with identity normalisation."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    letters = byte_letters()
    model = pb.ModelProto()
    tokens = {rank: token for token, rank in ranks.items()}
    for rank in range(max(tokens) + 1):
        piece = model.pieces.add()
        if rank in tokens:
            piece.piece, piece.score, piece.type = "".join(letters[b] for b in tokens[rank]), -float(rank), 1
        else:  # a free id gets an unused piece, so that ids stay ranks
            piece.piece, piece.score, piece.type = f" {rank}", 0.0, 5
    unknown = model.pieces.add()
    unknown.piece, unknown.score, unknown.type = "<unk>", 0.0, 2
    spec = model.trainer_spec
    spec.model_type, spec.vocab_size, spec.unk_id = 2, len(model.pieces), len(model.pieces) - 1
    spec.bos_id = spec.eos_id = spec.pad_id = -1
    norm = model.normalizer_spec
    norm.name, norm.add_dummy_prefix, norm.remove_extra_whitespaces, norm.escape_whitespaces = "identity", False, False, False
    return model.SerializeToString()


@lru_cache(2)
def _segments(model: bytes, pattern: str) -> Segments:
    import regex
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_proto=model)
    letters = letters_table()
    whole = {sp.id_to_piece(i): i for i in range(sp.get_piece_size() - 1)}
    find = regex.compile(pattern).findall

    def merge(pre_token: str) -> bytes:
        piece = charmap_decode(pre_token.encode(), "strict", letters)[0]
        one = whole.get(piece)
        return id_bytes([one] if one is not None else sp.encode(piece))

    return Segments(find, merge, MEMO_PIECES // 3)


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", result: str = "ids") -> DataFrame:
    """Adds the ids of every whole text as array<int>."""
    model = serialised_model(ranks)

    @F.arrow_udf("array<int>")
    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        segments = _segments(model, pattern)
        for batch in batches:
            yield id_lists([segments.encode(x.as_py() or "") for x in batch])

    return df.withColumn(result, ids_of(F.col(text)))


@lru_cache(2)
def _token_bytes(model: bytes) -> list[bytes]:
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_proto=model)
    back = {letter: b for b, letter in byte_letters().items()}
    return [bytes(map(back.get, p)) if set(p) <= back.keys() else b"" for p in map(sp.id_to_piece, range(sp.get_piece_size()))]


def decode(df: DataFrame, ranks: dict[bytes, int], ids: str = "ids", result: str = "decoded") -> DataFrame:
    """Adds the bytes that the ids stand for, as binary; null ids give no bytes."""
    model = serialised_model(ranks)

    @F.arrow_udf("binary")
    def bytes_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = _token_bytes(model).__getitem__
        for batch in batches:
            yield pa.array([b"".join(map(tokens, x.values.to_numpy().tolist())) if x.is_valid else b"" for x in batch], pa.binary())

    return df.withColumn(result, bytes_of(F.col(ids)))


def round_trip(df: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Adds the ids and the bytes decoded from them in one pass, with one Python process per task."""
    model = serialised_model(ranks)

    @F.arrow_udf("struct<ids:array<int>,decoded:binary>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        segments, tokens = _segments(model, pattern), _token_bytes(model).__getitem__
        for batch in batches:
            buffers = [segments.encode(x.as_py() or "") for x in batch]
            back = pa.array((b"".join(map(tokens, memoryview(b).cast("i"))) for b in buffers), pa.binary(), size=len(buffers))
            yield pa.StructArray.from_arrays([id_lists(buffers), back], ["ids", "decoded"])

    pair = df.withColumn("_pair", both(F.col(text)))
    return pair.withColumns({ids: F.col("_pair.ids"), decoded: F.col("_pair.decoded")}).drop("_pair")
