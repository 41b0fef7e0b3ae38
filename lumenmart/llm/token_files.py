"""Token ids of documents as ORC files in document order.

One row per document: ``seq`` (position in file order: file number in the high
bits, row number in the low 33), ``doc_id``, ``n_tokens`` and ``ids``. Files
follow ascending ``doc_id``. ORC keeps ids in run-length encoded integer
streams, splits files into stripes that tasks read in parallel, and holds row
indexes and Bloom filters on ``doc_id`` and ``seq``, so a lookup by id reads
only the row groups that may hold it, and offsets come from ``seq`` and
``n_tokens`` without touching ids.

Null texts count as empty and give the end id alone. A null ``doc_id`` sorts
first. Rows of one ``doc_id`` are ordered by text; repeated rows are all kept.
An empty table gives files without rows. Other columns are not written.

The strings of the tokenizer's added tokens are ordinary text, or with
``added_tokens`` their ids, as the library's ``encode`` has it.
"""

from __future__ import annotations

import zlib
from codecs import charmap_decode
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from lumenmart.llm.bpe import letters_table
from lumenmart.llm.segments import MEMO_PIECES, Segments, id_bytes, id_lists

#: ORC layout: row groups of 1,000 documents, stripes of 32 MB.
LAYOUT = {
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(32 << 20),
    "orc.bloom.filter.columns": "doc_id,seq",
    "orc.bloom.filter.fpp": "0.01",
    "compression": "zstd",
}
SCHEMA = "seq bigint, doc_id bigint, n_tokens bigint, ids array<int>"


@lru_cache(2)
def _added(tokenizer_json: str):
    """The tokenizer as it is, and the strings of its added tokens."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(tokenizer_json)
    return tokenizer, [t.content for t in tokenizer.get_added_tokens_decoder().values()]


def encoder(tokenizer_json: str, added_tokens: bool) -> Callable[[str], bytes]:
    """From a text to its ids; with ``added_tokens`` the library takes the texts that hold one.

    The tokenizer is looked up here, once for many texts: a lookup compares the
    whole of ``tokenizer_json``.
    """
    plain = _segments(tokenizer_json).encode
    if not added_tokens:
        return plain
    tokenizer, strings = _added(tokenizer_json)

    def encoded(text: str) -> bytes:
        if any(s in text for s in strings):
            return id_bytes(tokenizer.encode(text, add_special_tokens=False).ids)
        return plain(text)

    return encoded


@lru_cache(2)
def _segments(tokenizer_json: str) -> Segments:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(tokenizer_json)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    # Each pre-token is encoded once here, so the library's own cache of merges only costs time.
    getattr(tokenizer.model, "_resize_cache", lambda _: None)(1)
    tokens, letters = tokenizer.model.tokenize, letters_table()
    pre = tokenizer.pre_tokenizer

    def merge(pre_token: str) -> bytes:
        return id_bytes([t.id for t in tokens(charmap_decode(pre_token.encode(), "strict", letters)[0])])

    def cut(text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in pre.pre_tokenize_str(text)]

    return Segments(cut, merge, 2 * MEMO_PIECES)


def write(df: DataFrame, path: str, tokenizer_path: str, end_id: int, doc_id: str = "doc_id", text: str = "text", added_tokens: bool = False) -> None:
    """Encodes every whole text, appends ``end_id`` and writes the files.

    Texts are dealt out and sorted before they are encoded, so that Spark's
    sampling for the ranges doesn't encode anything twice.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer_json = f.read()
    end = np.array([end_id], dtype="<i4").tobytes()

    @F.arrow_udf("array<int>")
    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = encoder(tokenizer_json, added_tokens)
        for batch in batches:
            yield id_lists([encode(x or "") + end for x in batch.to_pylist()])

    rows = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    numbered = ordered.select(F.monotonically_increasing_id().alias("seq"), "doc_id", ids_of("text").alias("ids"))
    files = numbered.select("seq", "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids")
    files.write.options(**LAYOUT).orc(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the files; filters on ``doc_id`` or ``seq`` prune stripes and row groups."""
    return spark.read.schema(SCHEMA).orc(path)


def starts(spark: SparkSession, path: str) -> DataFrame:
    """``seq`` and ``start``, the number of ids before the row: one running sum per file plus the files' totals."""
    rows = read(spark, path).select("seq", "n_tokens", F.shiftright("seq", 33).alias("file"))
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    files = totals.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("file").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    running = rows.withColumn("inner", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    return running.join(files, "file").select("seq", (F.col("base") + F.col("inner")).alias("start"))


@F.arrow_udf(LongType())
def ids_crc32(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Unsigned crc32 of the ids as little-endian 32-bit integers."""
    for batch in batches:
        yield pa.array([zlib.crc32(x.values.to_numpy().astype("<u4").tobytes()) for x in batch], pa.int64())
