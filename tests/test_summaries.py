"""Bitmaps and sketches: words, merging by loads, and what a load reads."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from lumenmart.operators import bitmaps, sketches
from lumenmart.operators.sinks import read_table

FIRST = dt.date(1969, 11, 1)


def days_of_users(spark, n=400):
    rng = random.Random(2)
    rows = [(rng.randint(1, 8), FIRST + dt.timedelta(days=rng.randint(0, 20_500))) for _ in range(n)]
    rows += [(9, FIRST), (9, dt.date(2024, 1, 1)), (None, FIRST), (1, None)]
    return rows, spark.createDataFrame(rows, "u int, d date")


def test_words_answer_what_the_days_say(spark):
    rows, df = days_of_users(spark)
    days = {}
    for u, d in rows:
        if u and d:
            days.setdefault(u, set()).add(d)
    words = bitmaps.words_of_users(bitmaps.day_blocks(df, "u", "d"), "u")
    rng = random.Random(3)
    asked = [(u, rng.choice(sorted(days[u])) + dt.timedelta(days=rng.randint(-1, 1)), rng.randint(0, 200)) for u in days for _ in range(40)]
    probe = spark.createDataFrame(asked, "u int, day date, width int").join(words, "u")
    start = F.unix_date("day")
    got = probe.select(
        "u", "day", "width", bitmaps.active_on(F.col("words"), F.col("day")).alias("on"), bitmaps.last_active(F.col("words")).alias("last"),
        bitmaps.active_between(F.col("words"), start, start + F.col("width")).alias("within"),
    ).collect()
    assert len(got) == len(asked)
    for r in got:
        assert r.on == (r.day in days[r.u]) and r.last == max(days[r.u])
        assert r.within == any(r.day <= d <= r.day + dt.timedelta(days=r.width) for d in days[r.u])


def test_a_load_touches_its_own_blocks_only(spark, tmp_path):
    path = str(tmp_path / "words")
    year = [(u, dt.date(2023, 1, 1) + dt.timedelta(days=k)) for u in range(5) for k in range(u, 365, 9)]
    bitmaps.extend_blocks(spark, path, spark.createDataFrame(year, "u int, d date"), "u", "d")
    before = {f: os.stat(f"{path}/{f}").st_mtime_ns for f in os.listdir(path) if f.startswith("block=")}
    assert len(before) == 7
    late = [(1, dt.date(2023, 3, 3)), (7, dt.date(2023, 12, 31)), (7, dt.date(2023, 12, 31))]
    for _ in range(2):  # a load that is repeated changes nothing
        touched = bitmaps.extend_blocks(spark, path, spark.createDataFrame(late, "u int, d date"), "u", "d")
    assert len(touched) == 2
    after = {f: os.stat(f"{path}/{f}").st_mtime_ns for f in os.listdir(path) if f.startswith("block=")}
    assert {f for f in after if after[f] != before.get(f)} == {f"block={b}" for b in touched}
    whole = bitmaps.day_blocks(spark.createDataFrame(year + late, "u int, d date"), "u", "d")
    assert sorted(map(tuple, read_table(spark, path).select("u", "block", "bits").collect())) == sorted(map(tuple, whole.collect()))
    assert sorted(os.listdir(tmp_path)) == ["words"]


def test_sketches_of_loads_are_those_of_all_rows(spark):
    rows = spark.range(60_000).select((F.col("id") * 7919 % 20_011).alias("user"), F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 40).cast("int")).alias("day"), (F.col("id") % 3).alias("kind"))
    rows = rows.cache()
    one = sketches.user_sketches(rows, "day", "user", "kind")
    half = F.col("user") % 2 == 0
    two = sketches.user_sketches(rows.where(half), "day", "user", "kind").unionByName(sketches.user_sketches(rows.where(~half), "day", "user", "kind"))
    windows = {"week": 7, "month": 30}
    estimates = {r.day: r for r in sketches.trailing_estimates(one, "day", windows).collect()}
    assert len(estimates) == 40
    merged = {r.day: r for r in sketches.trailing_estimates(sketches.united(two, "day", "kind"), "day", windows).collect()}
    by_day = {}
    for r in rows.select("day", "user").distinct().collect():
        by_day.setdefault(r.day, set()).add(r.user)
    for day, r in estimates.items():
        for name, n in windows.items():
            exact = len(set().union(*(by_day.get(day - dt.timedelta(days=k), set()) for k in range(n))))
            assert abs(r[name] - exact) <= sketches.USERS_WITHIN * exact
            assert abs(merged[day][name] - exact) <= sketches.USERS_WITHIN * exact


def test_quantiles_of_merged_days(spark):
    rng = random.Random(6)
    values = [(k % 30, int(rng.lognormvariate(5, 2))) for k in range(30_000)] + [(1, None)]
    days = sketches.value_sketches(spark.createDataFrame(values, "day int, v bigint"), "v", "day")
    weeks = sketches.merged_values(days, (F.floor(F.col("day") / 7)).alias("week"))
    got = weeks.select("week", "n", *(sketches.quantile(p).alias(f"p{int(100 * p)}") for p in (0.5, 0.9, 0.99))).collect()
    for r in got:
        exact = sorted(v for d, v in values if d // 7 == r.week and v is not None)
        assert r.n == len(exact)
        for p, x in ((0.5, r.p50), (0.9, r.p90), (0.99, r.p99)):
            below, to = sum(v < x for v in exact) / len(exact), sum(v <= x for v in exact) / len(exact)
            assert below <= p + sketches.RANK_WITHIN and to >= p - sketches.RANK_WITHIN
