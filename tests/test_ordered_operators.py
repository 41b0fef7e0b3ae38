"""Operators that split hot keys, against plain Python on data where one key owns most rows."""

import random
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenmart.operators.ranking import exact_ntile, exact_percentiles, top_tile_sum, trailing_actives
from lumenmart.operators.slots import as_of, inactivity_sessions, next_pairs, with_neighbour

START = datetime(2026, 1, 1)


@pytest.fixture(scope="module")
def events():
    rnd = random.Random(7)
    out = []
    for i in range(600):
        user = 1 if rnd.random() < 0.5 else rnd.randint(2, 12)
        ts = START + timedelta(seconds=rnd.randint(0, 4 * 86400))
        out.append((i, user, ts, f"s{rnd.randint(0, 4)}"))
    # Same instant, same key.
    out += [(1000 + i, 1, START + timedelta(hours=5), "s0") for i in range(5)]
    return out


@pytest.fixture(scope="module")
def df(spark, events):
    return spark.createDataFrame(events, "id bigint, user bigint, ts timestamp_ntz, screen string")


def by_user(events):
    groups = {}
    for e in sorted(events, key=lambda e: (e[2], e[0])):
        groups.setdefault(e[1], []).append(e)
    return groups


@pytest.mark.parametrize("slot", [60, 3600, 10 * 86400])
def test_next_pairs(df, events, slot):
    expected = sorted((u, a[3], b[3]) for u, es in by_user(events).items() for a, b in zip(es, es[1:]))
    got = next_pairs(df, "user", ["ts", "id"], "screen", "ts", slot)
    assert sorted(tuple(r) for r in got.collect()) == expected


@pytest.mark.parametrize("forward", [True, False])
def test_with_neighbour(df, events, forward):
    expected = []
    for es in by_user(events).values():
        for i, e in enumerate(es):
            j = i + 1 if forward else i - 1
            expected.append((e[0], es[j][0] if 0 <= j < len(es) else None))
    got = with_neighbour(df, "user", ["ts", "id"], ["id"], "ts", "nb", forward, 7200).select("id", "nb.id")
    assert dict(tuple(r) for r in got.collect()) == dict(expected)


def test_as_of(spark, df, events):
    rnd = random.Random(3)
    moments = {(rnd.randint(1, 8), START + timedelta(minutes=rnd.randint(0, 5000))) for _ in range(60)}
    moments.add((1, START + timedelta(hours=5)))
    versions = [(u, t, f"v{i}") for i, (u, t) in enumerate(sorted(moments))]
    v = spark.createDataFrame(versions, "user bigint, since timestamp_ntz, role string")
    got = as_of(df, v, "user", "ts", "since", ["role"], 3600)
    assert set(got.columns) == {"id", "user", "ts", "screen", "role"}
    expected = {}
    for e in events:
        known = [x for x in versions if x[0] == e[1] and x[1] <= e[2]]
        expected[e[0]] = max(known, key=lambda x: x[1])[2] if known else None
    assert {r["id"]: r["role"] for r in got.collect()} == expected


@pytest.mark.parametrize("gap", [600, 1800, 7200])
def test_inactivity_sessions(df, events, gap):
    expected = []
    for u, es in by_user(events).items():
        session = []
        for e in es:
            if session and (e[2] - session[-1][2]).total_seconds() > gap:
                expected.append((u, session[0][2], session[-1][2], len(session)))
                session = []
            session.append(e)
        expected.append((u, session[0][2], session[-1][2], len(session)))
    got = inactivity_sessions(df, "user", "ts", gap).select("user", "session_start", "session_end", "events_count")
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected)


@pytest.mark.parametrize("n", [1, 4, 10, 23, 137])
def test_exact_ntile_and_top_sum(spark, n):
    rnd = random.Random(n)
    data = [(rnd.getrandbits(60), rnd.choice([1, 1, 1, 2, 5])) for _ in range(n)]
    d = spark.createDataFrame(data, "k bigint, m bigint")
    expected = {r["k"]: r["t"] for r in d.selectExpr("k", "ntile(10) OVER (ORDER BY m DESC, k) AS t").collect()}
    assert {r["k"]: r["tile"] for r in exact_ntile(d, "m", "k", 10).collect()} == expected
    top = sum(m for k, m in data if expected[k] == 1)
    assert top_tile_sum(d, "m", 10, "s").first()["s"] == top


def test_exact_percentiles(spark):
    rnd = random.Random(1)
    data = [("hot", rnd.choice([0, 7, 7, 7, 1500])) for _ in range(400)]
    data += [(g, rnd.randint(0, 10**6)) for g in "ab" for _ in range(rnd.randint(1, 90))]
    data += [("a", None), (None, 5), (None, 6)]
    got = exact_percentiles(spark.createDataFrame(data, "g string, v bigint"), ["g"], "v", {"p50": 0.5, "p90": 0.9}, 1000)
    for r in got.collect():
        values = [v for g, v in data if g == r["g"] and v is not None]
        assert r["n"] == len(values)
        assert r["p50"] == pytest.approx(np.percentile(values, 50), abs=1e-5)
        assert r["p90"] == pytest.approx(np.percentile(values, 90), abs=1e-5)
    whole = exact_percentiles(spark.createDataFrame(data, "g string, v bigint"), [], "v", {"p": 0.25}, 10).first()
    assert whole["p"] == pytest.approx(np.percentile([v for _, v in data if v is not None], 25), abs=1e-5)


def test_trailing_actives(spark):
    rnd = random.Random(5)
    first = date(2026, 1, 1)
    days = {(u, first + timedelta(days=rnd.randint(0, 60))) for u in range(30) for _ in range(6)}
    days = {d for d in days if d[1].day != 13}
    got = trailing_actives(spark.createDataFrame(sorted(days), "u bigint, d date"), "u", "d", {"w": 7, "m": 30})
    expected = []
    for day in sorted({d for _, d in days}):
        within = lambda n: len({u for u, d in days if day - timedelta(days=n) < d <= day})
        expected.append((day, within(1), within(7), within(30)))
    assert sorted(tuple(r) for r in got.collect()) == expected


def test_measures_travel_with_sessions(df):
    got = inactivity_sessions(df, "user", "ts", 1800, {"zeros": (F.col("screen") == "s0").cast("int")})
    assert got.agg(F.sum("zeros")).first()[0] == df.where("screen = 's0'").count()
