"""Runs against a search that tries every period at every place."""

import hashlib
import random
import zlib

from lumenmart.llm import queries, runs

SF = "/root/testdata/sf0.001"


def all_runs(words, least_length=6):
    """(start, length, period): every maximal stretch that is four of its smallest periods long."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least_length, 4 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((a, b - a, q) for (a, b), q in found.items())


def made_up(rng):
    """Words of a small alphabet, with stretches that repeat a root some times, roots that are periodic inside among them."""
    letters = [bytes([97 + k]) for k in range(rng.choice([1, 2, 3, 5, 20]))]
    out = []
    for _ in range(rng.randint(0, 12)):
        if rng.random() < 0.4:
            out += [rng.choice(letters) for _ in range(rng.randint(1, 12))]
            continue
        root = [rng.choice(letters) for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 31, 32, 33, 40]))]
        if rng.random() < 0.3:
            root = root[:1] * rng.randint(1, 40) + [b"z"]
        out += (root * 7)[: int(len(root) * rng.uniform(1, 6.5))]
    return out


def test_runs_equal_a_search_of_all_periods():
    rng = random.Random(3)
    for _ in range(150):
        texts = [made_up(rng) for _ in range(rng.randint(1, 6))]
        assert runs.runs_of_texts(texts) == [all_runs(t) for t in texts]


def test_members_depend_on_their_context_only():
    """Equal contexts of 2t words are both members or both none, and others are never far away."""
    rng = random.Random(5)
    w = runs.np.array([rng.randint(0, 1) for _ in range(3000)], runs.np.int64)
    levels = [runs._mixed(w.astype(runs.np.uint64))]
    for k in range(4):
        levels.append(runs._doubled(levels[-1], 1 << k))
    for t, h in ((8, levels[3]), (16, levels[4])):
        members = set(runs._members(h, t, runs._small_runs(w)).tolist())
        by_context = {}
        for i in range(len(w) - 2 * t):
            by_context.setdefault(w[i : i + 2 * t].tobytes(), set()).add(i in members)
        assert all(len(seen) == 1 for seen in by_context.values())
        assert 0 < len(members) < len(w) / 2


def test_long_texts():
    rng = random.Random(7)
    root = [b"%d" % rng.randint(0, 9999) for _ in range(777)]
    assert runs.runs_of_texts([root * 100 + [b"x"]]) == [[(0, 77700, 777)]]
    assert runs.runs_of_texts([[b"a"] * 200_000]) == [[(0, 200_000, 1)]]


def test_odd_rows(spark, odd):
    got = {r.doc_id: r for r in runs.with_runs(odd).collect()}
    assert (got[2].n_words, got[2].runs, got[2].collapsed) == (0, [], "") == (got[3].n_words, got[3].runs, got[3].collapsed)
    assert (got[4].n_words, got[4].collapsed) == (0, "")
    assert [tuple(r) for r in got[5].runs] == [(0, 100_000, 5)] and got[5].collapsed == "lorem ipsum dolor sit amet"
    assert got[None].collapsed == "a text without an id" and got[1].kept == "x"
    twice = runs.with_runs(odd.selectExpr("*", "'y' as found", "'y' as runs")).where("doc_id = 1").collect()
    assert len(twice) == 2 and twice[0].found == "y" and twice[0].runs == []
    assert runs.with_runs(odd.where("false")).count() == 0
    assert [len(r.runs) for r in runs.with_runs(odd.where("doc_id = 5"), least_length=200_000).collect()] == [0]


def expected(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = all_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    first = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *first, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_equals_plain_loops(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    short = [d for d in docs if len(d.text or "") < 20_000]
    got = {r.doc_id: tuple(r) for r in queries.op11_runs(spark, SF).collect()}
    assert len(got) == len(docs)
    want = {d.doc_id: expected(d.doc_id, d.text) for d in short}
    assert {k: got[k] for k in want} == want
    assert sum(w[1] > 0 for w in want.values()) > 5
