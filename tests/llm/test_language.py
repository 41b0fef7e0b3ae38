"""Language filters: sets against plain counts, and held-out accuracy."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenmart.llm import language, queries
from lumenmart.llm.common import held_out

SF = "/root/testdata/sf0.01"


def plain_grams(words):
    out = Counter()
    for w in words:
        marked = f" {w} "
        for n in language.LENGTHS:
            out.update(marked[i : i + n] for i in range(len(marked) - n + 1))
    return out


def hash_of(gram):
    """The hash that the operator gives an n-gram, by way of a word that holds it."""
    points = np.frombuffer(gram.encode("utf-32-le"), np.uint32).astype(np.uint64)
    h = language._mixed(points[:1] + np.uint64(0x51ED2701))
    for p in points[1:]:
        h = language._mixed(h * np.uint64(0x9E3779B97F4A7C15) + p)
    return int(h.view(np.int64)[0])


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_counts_equal_plain_counts(spark):
    rows = [("a", "Über den Wolken, über 3 Wölfen²"), ("a", "den den"), ("b", "σίγμα x"), ("b", None), (None, "nothing")]
    got = {(r.lang, r.gram): r.n for r in language.gram_counts(spark.createDataFrame(rows, "lang string, text string")).collect()}
    want = {}
    for lang, text in rows[:3]:
        for gram, n in plain_grams(set(language.letter_words(text))).items():
            want[lang, hash_of(gram)] = want.get((lang, hash_of(gram)), 0) + n
    assert got == want


def test_letters():
    assert language.letter_words("Ab1c² d_e ÉÀ 中文 ½x") == ["ab", "c", "d", "e", "éà", "中文", "x"]
    assert language.letter_words("12 ² ½ _ !") == [] == language.letter_words(None)


def test_filters_hold_their_grams_and_few_others(docs):
    learn = docs.where(~held_out(F.col("doc_id"), 4, 2))
    model = language.fit(learn)
    assert sorted(model.names) == ["de", "en", "es", "fr"] and model.names[0] == "en"
    counts = {}
    for r in learn.select("lang", "text").collect():
        counts.setdefault(r.lang, Counter()).update(plain_grams(set(language.letter_words(r.text))))
    shares = {}
    for lang, c in counts.items():
        all_ = Counter()
        for g, n in c.items():
            all_[len(g)] += n
        for g, n in c.items():
            shares.setdefault(g, {})[lang] = n / all_[len(g)]
    grams = [g for g, s in shares.items() if max(s.values()) >= language.LEAST_SHARE]
    bits = model.containing(np.array([hash_of(g) for g in grams], np.int64).view(np.uint64))[:, 0]
    extra = 0
    for g, mask in zip(grams, bits.tolist(), strict=True):
        most = max(shares[g].values())
        for k, lang in enumerate(model.names):
            held = shares[g].get(lang, 0) >= language.LEAST_SHARE and shares[g][lang] * language.NOISE >= most
            assert not held or mask >> k & 1
            extra += not held and mask >> k & 1
    assert extra < 0.02 * 4 * len(grams)
    other = model.containing(np.random.default_rng(1).integers(0, 2**63, 20_000).astype(np.uint64))[:, 0]
    for k, rate in enumerate(model.false_rates):
        assert abs(float((other >> np.uint64(k) & np.uint64(1)).mean()) - rate) < 0.004


def test_held_out_accuracy(spark, docs):
    got = queries.op12_language_filters(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null")
    right = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.min("score"), F.max("score")).first()
    assert right[0] >= 0.97 and 0 <= right[1] <= right[2] <= 1


def test_more_languages_than_bits_of_a_slice(spark):
    """Languages that differ in their letters only; more than 64 need a second slice."""
    texts = [(f"l{k:02d}", " ".join(chr(0x4E00 + 40 * k + (i * 7 + j) % 40) * 2 for i in range(30) for j in range(2))) for k in range(70)]
    df = spark.createDataFrame([(i, lang, t) for i, (lang, t) in enumerate(texts)], "doc_id bigint, lang string, text string")
    model = language.fit(df)
    assert model.table.shape[1] == 2
    assert all(r.lang == r.lang_pred for r in language.with_language(df, model).collect())


def test_odd_rows(spark, odd):
    model = language.fit(odd)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.with_language(odd, model).collect()}
    assert got[2] == got[3] == got[4] == ("und", 0.0)
    assert got[1][0] == "en" and got[6][0] == "de"
    nothing = language.fit(odd.where("false"))
    assert nothing is None
    assert {r.lang_pred for r in language.with_language(odd, nothing).collect()} == {"und"}
    unlike = spark.createDataFrame([(1, "中文", "x")], "doc_id bigint, text string, found string")
    assert [tuple(r) for r in language.with_language(unlike, model).collect()] == [(1, "中文", "x", "en", 0.0)]
    assert language.with_language(odd.where("false"), model).count() == 0
