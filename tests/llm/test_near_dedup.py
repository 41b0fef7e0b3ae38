"""The near-dedup stage of the pipeline against all pairs of fingerprints."""

import random
from itertools import combinations

import corpus_pipeline
from lumenmart.llm import simhash
from tests.llm.test_copies import plain_fingerprint, roots

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def changed(rng, text, times):
    own = text.split()
    for _ in range(times):
        own[rng.randrange(len(own))] = f"new{rng.randrange(10**6)}"
    return " ".join(own)


def test_one_of_each_group_stays(spark):
    rng = random.Random(8)
    bases = [" ".join(f"w{rng.randrange(5000)}" for _ in range(rng.randint(3, 400))) for _ in range(50)]
    texts = bases + [changed(rng, rng.choice(bases), rng.randint(0, 2)) for _ in range(150)] + ["", None, " ", "one two", "One  two"]
    rng.shuffle(texts)
    prints = [plain_fingerprint(t) for t in texts]
    pairs = [(i, j) for i, j in combinations(range(len(texts)), 2) if (prints[i] ^ prints[j]).bit_count() <= 2]
    assert any(prints[i] != prints[j] for i, j in pairs)
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], SCHEMA)
    got = corpus_pipeline.keep_one_of_each(spark, docs, "")
    assert got.columns == list(corpus_pipeline.COLUMNS)
    left = {r.doc_id: r.text for r in got.collect()}
    assert sorted(left) == sorted(set(roots(range(len(texts)), pairs).values()))
    assert all(texts[i] == t for i, t in left.items())


def test_rows_without_an_id_of_their_own(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text), (1, "other words of the same id altogether"), (2, text), (None, text), (None, "only here and without an id"), (None, "only here and without an id")]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], SCHEMA)
    got = sorted((r.doc_id or 0, r.text) for r in corpus_pipeline.keep_one_of_each(spark, docs, "").collect())
    assert got == [(0, rows[4][1]), (1, rows[1][1]), (1, text)]


def test_odd_rows_keep_their_columns(odd):
    got = simhash.first_of_each(odd.selectExpr("*", "'y' as root", "'z' as first", "1 as component", "2 as node")).collect()
    assert sorted((r.doc_id or 0) for r in got) == [0, 1, 2, 5, 6] and {(r.print, r.root, r.component) for r in got} == {("x", "y", 1)}
    assert simhash.first_of_each(odd.where("false")).count() == 0
