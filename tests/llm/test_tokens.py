"""Token ids against the libraries, exactly; ORC files against the rows written."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lumenmart.llm import bpe, queries, token_files
from lumenmart.session import shared_dir
from tests.llm.conftest import ODD

SF = "/root/testdata/sf0.001"
JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def tokenizer():
    own = Tokenizer.from_file(JSON)
    own.encode_special_tokens = True
    return own


def ids(buffer):
    return np.frombuffer(buffer, "<i4").tolist()


def strange_texts(n):
    rng = random.Random(5)
    parts = [*"ab Z\n\n  \t'sd.,!?1_", "é", "ß", "½", "中", "　", "\x1c", "\x85", "\r", "😀", "'re", " the", "can't", "<|endoftext|>"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(n)]


def test_ranks_are_read_as_written(ranks):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        token, rank = f.readlines()[1000].split()
    assert ranks[base64.b64decode(token)] == int(rank)


def test_pieces_of_strange_texts_equal_whole_texts(ranks, reference, tokenizer):
    merged = bpe._segments(bpe.serialised_model(ranks), public_tokenizers.PATTERN)
    with open(JSON, encoding="utf-8") as f:
        filed = token_files._segments(f.read())
    for text in strange_texts(3000):
        assert ids(merged.encode(text)) == reference.encode_ordinary(text), repr(text)
        assert ids(filed.encode(text)) == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_odd_rows_encode_and_decode(odd, ranks, reference):
    rows = bpe.round_trip(odd, ranks, public_tokenizers.PATTERN).select("doc_id", "text", "ids", "decoded").collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert r.ids == reference.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
    apart = bpe.decode(bpe.encode(odd.where("doc_id = 6"), ranks, public_tokenizers.PATTERN), ranks).first()
    assert bytes(apart.decoded).decode() == ODD[-1][1]


def test_op7_on_a_table(spark, reference):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.op7_byte_bpe(spark, SF).collect():
        own = reference.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(own)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, own)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_op10_on_a_table(spark, tokenizer):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = {r.doc_id: r for r in queries.op10_token_files(spark, SF).collect()}
    start = 0
    for doc_id in sorted(docs):
        own = tokenizer.encode(docs[doc_id], add_special_tokens=False).ids + [2]
        r = rows[doc_id]
        assert (r.start, r.n_tokens) == (start, len(own))
        assert r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
        start += len(own)


def test_files_keep_odd_rows_in_order(spark, odd, tokenizer):
    path = shared_dir(spark, "odd-tokens")
    token_files.write(odd, path, JSON, 2)
    rows = token_files.read(spark, path).orderBy("seq").collect()
    assert [r.doc_id for r in rows] == [None, 1, 1, 2, 3, 4, 5, 6]
    assert rows[3].ids == [2] and rows[4].ids == [2]
    assert rows[7].ids == tokenizer.encode(ODD[-1][1], add_special_tokens=False).ids + [2]
    starts = [r.start for r in token_files.starts(spark, path).orderBy("seq").collect()]
    assert starts == np.cumsum([0, *(len(r.ids) for r in rows)])[:-1].tolist()


def test_empty_table_gives_no_rows(spark, documents):
    path = shared_dir(spark, "no-tokens")
    token_files.write(documents([(1, "x")]).where("false"), path, JSON, 2)
    assert token_files.read(spark, path).count() == 0


def test_lookups_push_the_id_down(spark):
    path = shared_dir(spark, "pushed")
    token_files.write(spark.read.parquet(f"{SF}/documents.parquet"), path, JSON, 2)
    one = token_files.read(spark, path).where(F.col("doc_id") == 17)
    assert one.count() == 1
    assert "EqualTo(doc_id,17)" in one._jdf.queryExecution().toString()


def test_op10_encodes_added_tokens_like_the_library(spark, tmp_path):
    texts = ["a <|endoftext|> b", *strange_texts(300)]
    schema = "doc_id bigint, text string"
    spark.createDataFrame(list(enumerate(texts)), schema).write.parquet(str(tmp_path / "documents.parquet"))
    library = Tokenizer.from_file(JSON)  # as it is
    assert library.encode(texts[0], add_special_tokens=False).ids == [64, 220, 50256, 275]
    rows = {r.doc_id: r for r in queries.op10_token_files(spark, str(tmp_path)).collect()}
    start = 0
    for i, text in enumerate(texts):
        own = library.encode(text, add_special_tokens=False).ids + [2]
        assert (rows[i].start, rows[i].n_tokens, rows[i].ids_crc32) == (start, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        start += len(own)
