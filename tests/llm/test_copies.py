"""SimHash, embeddings, components and lines against brute force."""

import random
import re
import time
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from xxhash import xxh64_intdigest

from lumenmart.llm import lines, simhash, vectors
from lumenmart.llm.components import components


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_random_graphs(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    links += [(400 + i, 401 + i) for i in range(40)]  # a chain
    links += [(1000, 1001 + i) for i in range(50)] + [(None, 3), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert got == roots({n for ab in real for n in ab}, real)


def test_no_links_no_components(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("code", ["golay23", "hamming15"])
def test_codes_cover_every_word_once(code):
    length, _, radius = simhash.CODES[code]
    table = simhash.nearest_codeword(code)
    sizes = np.bincount(table)
    ball = sum(len(list(combinations(range(length), w))) for w in range(radius + 1))
    assert (sizes == ball).all() and len(sizes) * ball == 1 << length


@pytest.mark.parametrize("blocks", [("golay23", "golay23"), ("golay23", "hamming15", "golay23")])
def test_fingerprints_within_the_threshold_meet_at_a_home(blocks):
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    for flips in (1, 2):
        others = prints.copy()
        for i in range(len(others)):
            for bit in rng.choice(64, flips, replace=False):
                others[i] ^= np.uint64(1 << int(bit))
        row, anchor, home = simhash.anchors_of(np.concatenate([prints, others]), 2, blocks)
        homes = {r: a for r, a, h in zip(row, anchor, home) if h}
        reached = {(r, a) for r, a in zip(row, anchor)}
        assert len(homes) == 120
        assert all((i + 60, homes[i]) in reached for i in range(60))


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_of_odd_rows(odd):
    rows = simhash.with_fingerprint(odd).select("text", "print").collect()
    for r in rows:
        if len(r.text or "") < 1000:
            assert r["print"] % (1 << 64) == plain_fingerprint(r.text)
    groups = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(odd).collect()}
    assert groups == {(1, 1), (2, 2), (3, 2), (4, 2), (5, 5), (6, 6), (None, None)}


def test_links_of_fingerprints_against_all_pairs(spark):
    rng = random.Random(3)
    seeds = [rng.getrandbits(64) for _ in range(40)]
    prints = set(seeds)
    for s in seeds * 6:
        prints.add(s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3))))
    centre = rng.getrandbits(64)  # many near fingerprints at one anchor
    prints |= {centre ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(20)}
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    links = simhash.print_links(spark.createDataFrame([(p,) for p in signed], "print bigint"), 2).collect()
    real = [(a, b) for a, b in combinations(signed, 2) if ((a ^ b) % (1 << 64)).bit_count() <= 2]
    assert roots(signed, [(r.a, r.b) for r in links]) == roots(signed, real)
    assert all(((r.a ^ r.b) % (1 << 64)).bit_count() <= 2 for r in links)
    assert len(links) < 20 * len(signed)


def test_empty_tables(documents):
    nothing = documents([(1, "x")]).where("false")
    assert simhash.near_duplicates(nothing).count() == 0
    assert lines.without_repeated_lines(nothing).count() == 0


# --- embeddings ------------------------------------------------------------------------


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(300, 16))
    near = base[rng.integers(0, 300, 200)] + rng.normal(size=(200, 16)) * 0.15
    hot = base[7] + rng.normal(size=(120, 16)) * 0.1
    x = np.concatenate([base, near, hot, base[:20], np.repeat(base[3:4], 30, axis=0)]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    bad = [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [float("nan")] + [1.0] * 15), (2004, [None] + [1.0] * 15), (2005, [float("inf")] + [1.0] * 15)]
    got = {r.vec_id: r for r in vectors.near_duplicates(spark.createDataFrame(rows + bad, "vec_id bigint, embedding array<float>")).collect()}
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    linked = u @ u.T >= 0.95
    np.fill_diagonal(linked, False)
    found = np.array([got[i].n_links for i in range(len(x))])
    assert (found <= linked.sum(1)).all()
    assert found.sum() >= 0.98 * linked.sum()
    expected = roots(range(len(x)), zip(*np.nonzero(linked)))
    assert np.mean([got[i].component_id == expected[i] for i in range(len(x))]) > 0.97
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i, _ in bad)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def all_links(x, sizes=None):
    u = np.asarray(x, np.float64)
    u = u / np.linalg.norm(u, axis=1, keepdims=True)
    linked = u @ u.T >= 0.95
    np.fill_diagonal(linked, False)
    return linked if sizes is None else linked & (sizes[:, None] == sizes)


def test_many_near_copies_in_little_memory(spark, monkeypatch):
    monkeypatch.setitem(spark.sparkContext.environment, "WORKERS_OF", "this test")
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=64) + rng.normal(size=(2600, 64)) * 0.09, rng.normal(size=(1500, 64))]).astype(np.float32)
    df = spark.createDataFrame(pa.table({"vec_id": pa.array(range(len(x)), pa.int64()), "embedding": pa.array(x.tolist(), pa.list_(pa.float32()))}))
    got = {r.vec_id: r for r in vectors.near_duplicates(df).collect()}
    assert [got[i].n_links for i in range(len(x))] == all_links(x).sum(1).tolist()
    assert [got[i].component_id for i in range(len(x))] == [0] * 2600 + list(range(2600, len(x)))

    def peak(batches):
        for _ in batches:
            time.sleep(0.2)  # so that each worker gets a task
            with open("/proc/self/status") as f:
                yield pa.RecordBatch.from_pydict({"kb": [int(line.split()[1]) for line in f if line.startswith("VmHWM")]})

    assert spark.range(0, 64, 1, 16).mapInArrow(peak, "kb bigint").agg({"kb": "max"}).first()[0] < 400_000


def test_cells_over_many_buckets_and_rounds(spark, monkeypatch):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(150, 12))
    x = np.concatenate([base, base[rng.integers(0, 150, 150)] + rng.normal(size=(150, 12)) * 0.1, base[5] + rng.normal(size=(80, 12)) * 0.1])
    sizes = np.full(len(x), 12)
    short = rng.choice(len(x), 60, replace=False)
    x[short, 8:], sizes[short] = 0, 8
    df = spark.createDataFrame([(i, v[:n].tolist()) for i, (v, n) in enumerate(zip(x, sizes))], "vec_id bigint, embedding array<double>")
    # equal but for their length
    df = df.union(spark.createDataFrame([(1000 + int(i), x[i, :8].tolist() + [0.0] * 4) for i in short[:5]], df.schema))
    x, sizes = np.concatenate([x, x[short[:5]]]), np.concatenate([sizes, np.full(5, 12)])
    one = sorted(vectors.near_duplicates(df).collect())
    for name, value in (("BUCKETS", 60), ("ROUND", 0.5), ("LEAST_ROUND", 1)):
        monkeypatch.setattr(vectors, name, value)
    assert sorted(vectors.near_duplicates(df).collect()) == one
    linked = all_links(x, sizes)
    found = np.array([r.n_links for r in one])
    assert (found <= linked.sum(1)).all() and found.sum() >= 0.98 * linked.sum()


def test_multi_sequence_is_ascending():
    rng = np.random.default_rng(0)
    a, b = np.sort(rng.random(9)), np.sort(rng.random(7))
    cells = vectors.multi_sequence(a.tolist(), b.tolist(), 63)
    sums = [a[i] + b[j] for i, j in cells]
    assert sums == sorted(sums) and len(set(cells)) == 63


def test_no_usable_vector(spark):
    rows = vectors.near_duplicates(spark.createDataFrame([(1, None), (2, [0.0])], "vec_id bigint, embedding array<float>")).collect()
    assert [(r.vec_id, r.n_links, r.component_id, r.kept) for r in sorted(rows)] == [(1, 0, 1, True), (2, 0, 2, True)]


# --- lines -----------------------------------------------------------------------------


def words(line):
    return tuple(w for w in re.split(r"[\x20\x09-\x0d]+", line.lower()) if w)


def within_one_word(x, y):
    if abs(len(x) - len(y)) > 1:
        return False
    short = min(len(x), len(y))
    lead = next((i for i in range(short) if x[i] != y[i]), short)
    tail = next((i for i in range(short) if x[-1 - i] != y[-1 - i]), short)
    return lead + tail >= max(len(x), len(y)) - 1


def test_lines_against_all_pairs(documents):
    rng = random.Random(6)
    vocabulary = "red blue green old new big small cat dog tree".split()
    known = [[rng.choice(vocabulary) for _ in range(rng.randint(3, 16))] for _ in range(120)]
    texts = []
    for _ in range(60):
        out = []
        for _ in range(rng.randint(0, 8)):
            line = list(rng.choice(known))
            for _ in range(rng.choice([0, 0, 1, 2])):
                place = rng.randrange(len(line) + 1)
                line[place : place + rng.randint(0, 1)] = [rng.choice(vocabulary)] * rng.randint(0, 1)
            out.append(rng.choice([" ", "  ", "\t"]).join(line) + rng.choice(["", " ", "\r"]))
        texts.append("\n".join(out))
    texts += [f"page {i} of the long template that all pages share with each other" for i in range(300)]
    seen, expected = [], {}
    for i, text in enumerate(texts):
        out = []
        for line in text.split("\n"):
            w = words(line)
            if len(w) < lines.MIN_WORDS:
                out.append(line)
                continue
            if not any(within_one_word(w, s) for s in seen):
                out.append(line)
            seen.append(w)
        expected[i] = "\n".join(out)
    got = {r.doc_id: r.text for r in lines.without_repeated_lines(documents(texts)).select("doc_id", "text").collect()}
    assert got == expected


def test_lines_of_odd_rows(odd):
    rows = lines.without_repeated_lines(odd).select("doc_id", "text", "n_lines", "n_dropped").collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == 8
    assert by_id[2].text is None and by_id[2].n_lines == 0
    assert by_id[3].text == "" and by_id[5].n_dropped == 0 and by_id[None].n_dropped == 0
    assert sum(r.n_dropped for r in rows) == 0  # rows of one id are one document


def test_line_dedup_runs_no_python(documents):
    plan = lines.without_repeated_lines(documents(["a b c d e f", "a b c d e f"]))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
