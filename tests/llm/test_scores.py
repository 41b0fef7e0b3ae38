"""Classifiers on held-out rows, the language model and the rules against plain versions."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lumenmart.llm import ctw, mixing, quality, queries, rules, toxicity
from lumenmart.llm.common import held_out
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def label_of(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def test_quality_on_held_out_rows(spark, label_of):
    rows = queries.op1_quality_neighbours(spark, SF).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    good = [r.score for r in rows if r.held_out and r.doc_id in label_of and label_of[r.doc_id].quality == 1]
    junk = [r.score for r in rows if r.held_out and r.doc_id in label_of and label_of[r.doc_id].quality == 0]
    assert np.mean([g > j for g in good for j in junk]) > 0.97
    assert np.mean([g >= 0.3 for g in good]) > 0.98


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"  # the smaller tables show too few toxic documents of each language
    label_of = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op5_toxicity_automata(spark, sf).collect()
    assert len(rows) == 10000
    held = [r for r in rows if r.held_out and r.doc_id in label_of]
    toxic = [r.score for r in held if label_of[r.doc_id] == 1]
    clean = [r.score for r in held if label_of[r.doc_id] == 0]
    assert np.mean([t > c for t in toxic for c in clean]) > 0.93
    assert np.mean([c < 0.5 for c in clean]) > 0.98


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_finds_what_edit_distance_finds():
    rng = np.random.default_rng(3)
    entries = [("idiot", False), ("worthless", False), ("scum", False), ("lostra", True), ("disgusting", False)]
    lexicon = toxicity.Lexicon(entries)
    words = ["idiot", "idot", "idi0t", "scum", "scumm", "lostraxyz", "lstrabc", "worhtless", "wrthles", "table", ""]
    for text, _ in entries * 40:
        w = list(text)
        for _ in range(rng.integers(0, 4)):
            at = rng.integers(0, len(w) + 1)
            w[at : at + rng.integers(0, 2)] = list("abciostx"[rng.integers(0, 8)])[: rng.integers(0, 2)]
        words.append("".join(w))
    for word in words:
        found = []
        for n, (text, open_) in enumerate(entries):
            e = min((edits(text, word[:k]) for k in range(len(word) + 1)), default=9) if open_ else edits(text, word)
            if e <= lexicon.allowed(text, open_):
                found.append((e, n))
        got = lexicon.find(word)
        assert (got is None) == (not found), word
        assert got is None or got == min(found), word


def test_quotation_counts_less_than_abuse():
    model = toxicity.Model([("idiot", False)], {(0, 0): 5.0}, np.array([-3.0, 2.0, -1.0, 0.5, 0.5, 1.0]))
    assert model.score("you are an idiot , really") > 0.5
    assert model.score('he wrote "you are an idiot" in the letter') < 0.5
    assert model.score("") < 0.5


def test_scores_of_odd_rows(spark, odd, labels):
    scored = quality.with_quality(odd, quality.fit(odd, labels)).collect()
    toxic = toxicity.with_toxicity(odd, toxicity.fit(odd, labels)).collect()
    assert len(scored) == len(toxic) == 8
    assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in scored + toxic)
    nothing = labels.where("false")
    assert {r.score for r in quality.with_quality(odd, quality.fit(odd, nothing)).collect()} == {0.5}
    assert {r.predicted for r in toxicity.with_toxicity(odd, toxicity.fit(odd, nothing)).collect()} == {0}
    empty = odd.where("false")
    assert quality.with_quality(empty, quality.fit(empty, labels)).count() == 0
    assert toxicity.with_toxicity(empty, toxicity.fit(empty, labels)).count() == 0


def test_neighbours_vote_like_all_cosines(spark, labels, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    model = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"), max_labelled=100)
    texts = [r.text for r in docs.collect()]
    x = model.project(quality.features.term_vectors(texts))
    for text_scores, row in zip(model.vote(texts), x):
        cos = model.vectors @ row
        near = np.argsort(-cos, kind="stable")[: quality.VOTERS]
        w = np.maximum(cos[near], 0).astype(float) ** quality.POWER
        plain = ((w * model.labels[near]).sum() + quality.BASE_WEIGHT * model.base) / (w.sum() + quality.BASE_WEIGHT)
        assert text_scores == pytest.approx(plain, abs=1e-3)


# --- language model --------------------------------------------------------------------


def words(text):
    return re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


class PlainTree:
    """Context-tree weighting node by node, from dictionaries."""

    def __init__(self, sequences):
        self.count = defaultdict(lambda: [0, 0])
        self.contexts = defaultdict(set)
        for grams, n in sequences:
            for gram in grams:
                for depth in range(ctw.DEPTH + 1):
                    context = gram[ctw.DEPTH - depth : ctw.DEPTH]
                    if depth:
                        self.contexts[context[1:]].add(context)
                    for prefix, bit in self.bits(gram[-1]):
                        self.count[context, prefix][bit] += n
        self.whole_of = {}

    @staticmethod
    def bits(byte):
        prefix = 1
        for i in range(7, -1, -1):
            yield prefix, byte >> i & 1
            prefix = prefix << 1 | byte >> i & 1

    def own(self, node):
        a, b = self.count.get(node, (0, 0))
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def whole(self, node):
        if node not in self.whole_of:
            context, prefix = node
            own = self.own(node)
            if len(context) < ctw.DEPTH:
                below = sum(self.whole((longer, prefix)) for longer in self.contexts[context] if (longer, prefix) in self.count)
                own = float(np.logaddexp(own, below)) - math.log(2)
            self.whole_of[node] = own
        return self.whole_of[node]

    def log10(self, gram):
        out = 0.0
        for prefix, bit in self.bits(gram[-1]):
            p = None
            for depth in range(ctw.DEPTH, -1, -1):
                node = gram[ctw.DEPTH - depth : ctw.DEPTH], prefix
                counts = self.count.get(node, (0, 0))
                estimate = (counts[bit] + 0.5) / (sum(counts) + 1)
                if p is None:
                    p = estimate
                else:
                    share = math.exp(self.own(node) - math.log(2) - self.whole(node))
                    p = share * estimate + (1 - share) * p
            out += math.log10(p)
        return out


def grams(word):
    data = b" " * ctw.DEPTH + word.encode() + b" "
    return [data[i : i + ctw.DEPTH + 1] for i in range(len(data) - ctw.DEPTH)]


TEXTS = ["The cat sat on the mat", "the cat", None, "", "Übergröße the mat\nmats", "a dog sat", "the dog's mat unknownword", "THE end end end"]


def test_context_tree_against_a_plain_one(documents):
    docs = documents(TEXTS)
    held = F.col("doc_id").isin(5, 6)
    rows = {r.doc_id: r for r in ctw.score(docs, held).collect()}
    train = Counter(w for i, t in enumerate(TEXTS) if i not in (5, 6) for w in words(t))
    ends = len(TEXTS) - 2
    end = b" " * ctw.DEPTH + b"\n"
    everything = {w: 0 for t in TEXTS for w in words(t)} | train
    tree = PlainTree([(grams(w), n) for w, n in everything.items()] + [([end], ends)])
    tokens, types = sum(train.values()) + ends, len(train) + 1
    for i, text in enumerate(TEXTS):
        own = words(text)
        r = rows[i]
        assert (r.n_tokens, r.train_tokens, r.held_out) == (len(own) + 1, tokens, i in (5, 6))
        assert r.n_known == sum(train[w] > 0 for w in own) + 1
        base = sum(math.log10((n + 1) / (tokens + types + 1)) for n in [*(train[w] for w in own), ends])
        assert r.base_score == pytest.approx(base)
        plain = sum(tree.log10(g) for w in own for g in grams(w)) + tree.log10(end)
        assert r.score == pytest.approx(plain, rel=1e-4)


def test_small_blocks_give_the_same_scores(documents, monkeypatch):
    docs = documents(TEXTS)
    plain = {r.doc_id: r.score for r in ctw.score(docs, F.lit(False), across_words=True).collect()}
    for name, size in (("BLOCK_CHARS", 20), ("FAN", 2), ("_BYTES", 16), ("_GRAMS", 5)):
        monkeypatch.setattr(ctw, name, size)
    cut = {r.doc_id: r.score for r in ctw.score(docs, F.lit(False), across_words=True).collect()}
    assert plain == pytest.approx(cut)


def test_numbers_survive_packing():
    for kind in (np.int64, np.int32):
        for numbers in ([], [3], [1, 1 << 20, 7]):
            own = np.array(numbers, kind)
            assert np.array_equal(ctw.unpack(ctw.pack(own), kind), own)


def test_probabilities_of_a_byte_sum_to_one():
    codes = ctw.grams_of([b"abc", b"abd", b"xbc"])
    context = codes[2] >> 8 << 8
    every = np.concatenate([codes, context + np.arange(256)])
    counts = np.concatenate([np.ones(len(codes)), np.zeros(256)])
    levels = {d: ctw.nodes_at(every, counts, d) for d in range(ctw.DEPTH + 1)}
    ctw.weigh(levels, ctw.DEPTH, 0)
    assert (10 ** ctw.code_lengths(every, levels)[-256:]).sum() == pytest.approx(1)


def test_language_model_of_odd_and_no_rows(odd):
    rows = ctw.score(odd, held_out(F.col("doc_id"), 7, 2)).collect()
    assert len(rows) == 8 and all(r.score < 0 and math.isfinite(r.score) for r in rows)
    assert ctw.score(odd.where("false"), F.lit(False)).count() == 0
    assert ctw.score(odd, F.lit(True)).count() == 8


# --- rules -----------------------------------------------------------------------------


def plain_counts(text):
    own = re.findall(r"[^\x20\x09-\x0d]+", text or "")
    windows = [tuple(own[i : i + 5]) for i in range(len(own) - 4)]
    often = Counter(windows)
    covered = {k for i, w in enumerate(windows) if often[w] > 1 for k in range(i, i + 5)}
    full = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    return len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text or "")), len(full) - len(set(full)), len(covered)


def test_counts_of_odd_rows(odd, documents):
    texts = ["a b c d e a b c d e f", "x x x x x x x", "one\none\n one\n\n", "é#*$ %&|<> 😀", "a b c d e f g a b c d e z c d e f g"]
    for frame in (odd.where("doc_id <> 5 or doc_id is null"), documents(texts)):
        for r in rules.statistics(frame).collect():
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_counts(r.text)
    long = rules.statistics(odd.where("doc_id = 5")).first()
    assert (long.n_words, long.n_repeat_words) == (100_000, 100_000)


def test_outliers_go_and_the_rest_stays(spark):
    rng = np.random.default_rng(1)
    vocabulary = ["".join(rng.choice(list("abcdefghij"), rng.integers(2, 9))) for _ in range(3000)]
    rows = []
    for i in range(400):
        text = " ".join(rng.choice(vocabulary, rng.integers(40, 400)))
        source = "hot" if i < 300 else f"s{i % 5}"
        rows.append((i, text if i % 40 else re.sub(" ", "*** ", text), "en", source))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in rules.outliers(docs, min_rows=50).select("doc_id", "kept").collect()}
    assert all(kept[i] == (i % 40 != 0) for i in range(400))
    plan = rules.outliers(docs, min_rows=50)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_small_groups_and_odd_rows_have_no_verdict(odd):
    rows = rules.outliers(odd.drop("distance")).select("doc_id", "kept", "base_failed", "distance").collect()
    assert len(rows) == 8 and all(r.kept == (not r.base_failed) and r.distance is None for r in rows)
    assert rules.outliers(odd.where("false")).count() == 0


# --- mixing ----------------------------------------------------------------------------


def test_rates_reach_the_targets(spark):
    rng = np.random.default_rng(2)
    p = np.round(rng.dirichlet([0.3, 0.3, 0.8], 2000), 3)
    n = rng.integers(0, 500, 2000)
    rows = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(n, p)], "tokens bigint, posteriors array<double>")
    for weights in ([0.5, 0.3, 0.2], [0.1, 0.2, 0.7]):
        fitted = rows.select("posteriors", mixing.fit_rates(rows, weights).alias("rate"))
        rates = {tuple(r.posteriors): r.rate for r in fitted.collect()}
        rate = np.array([rates[tuple(x)] for x in p])
        goal = ((n @ p) / weights).min() * np.array(weights)
        assert rate.min() >= 0
        assert (n * rate) @ p == pytest.approx(goal, rel=0.01)


def test_mixing_odd_rows(spark, odd, labels):
    model = mixing.fit_domains(odd, labels, queries.DOMAINS)
    rows = mixing.mixed(odd, model, queries.TARGETS).collect()
    assert len(rows) == 8 and all(r.rate >= 0 and r.copies in (math.floor(r.rate), math.floor(r.rate) + 1) for r in rows)
    assert {r.tokens for r in rows if r.doc_id in (2, 3, 4)} == {0}
    assert mixing.mixed(odd.where("false"), model, queries.TARGETS).count() == 0
    even = mixing.fit_domains(odd, labels.where("false"), queries.DOMAINS)
    assert {tuple(r.posteriors) for r in mixing.with_posteriors(odd, even).collect()} == {(0.333, 0.333, 0.333)}


def test_op2_shares(spark):
    rows = queries.op2_soft_mixing(spark, SF).collect()
    words = {d: sum(r.tokens * r.rate * r[f"p_{d}"] for r in rows) for d in queries.TARGETS}
    whole = sum(words.values())
    assert all(words[d] / whole == pytest.approx(share, abs=0.01) for d, share in queries.TARGETS.items())
