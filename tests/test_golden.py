"""Hand-checked fixtures: 180 days of 200 users, the small cohort, the role change."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lumenmart.functions import surrogate_key_of
from lumenmart.operators import dimensions, history
from lumenmart.plans import marts, metrics


@pytest.fixture(scope="module")
def half_year(spark):
    """Users 1..n(d) are active on day d: 50, 35 or 20 of them."""
    users = spark.range(1, 201).selectExpr(
        "id AS user_sk", "id AS user_id", "id % 3 + 1 AS university_sk", "date'2026-01-01' AS registration_date",
        "true AS is_current",
    )
    days = spark.range(180).selectExpr(
        "date_add(date'2026-01-01', cast(id as int)) AS day",
        "CASE WHEN id % 30 = 0 THEN 50 WHEN id % 30 < 7 THEN 35 ELSE 20 END AS n",
    )
    active = days.select(F.expr("cast(date_format(day, 'yyyyMMdd') as int) AS date_sk"), F.explode(F.sequence(F.lit(1), "n")).alias("u"))
    active = active.withColumn("user_sk", F.col("u").cast("bigint"))
    daily = active.selectExpr(
        "date_sk", "user_sk", "user_sk % 3 + 1 AS university_sk", "12L AS events_count", "1 AS has_completed_core_action"
    )
    events = active.select(
        "user_sk", F.explode(F.array(F.lit("screen_viewed"), F.lit("discipline_rated"))).alias("event_name"),
        F.expr("cast(to_date(cast(date_sk as string), 'yyyyMMdd') as timestamp_ntz) AS event_ts"), "date_sk",
    )
    sessions = active.selectExpr(
        "date_sk * 1000L + u AS session_sk", "date_sk AS session_start_date_sk", "user_sk", "420L AS session_duration_seconds",
        "5L AS screens_viewed_count",
    )
    ratings = active.where("u <= 10").selectExpr("date_sk", "user_sk", "4 AS dificuldade", "3 AS esforco")
    return {"users": users, "daily": daily, "events": events, "sessions": sessions, "ratings": ratings}


def test_sizes(half_year):
    assert half_year["daily"].count() == 4320
    assert half_year["events"].count() == 8640
    assert half_year["ratings"].count() == 1800
    assert half_year["sessions"].count() == 4320


def test_retention(half_year):
    r = marts.mrt_retention(half_year["daily"], half_year["users"]).collect()
    assert [tuple(x) for x in r] == [(date(2026, 1, 1), 200, 35, 20, 20, 50, 0.175, 0.1, 0.25)]


def test_engagement_of_june_29(half_year):
    m = marts.mrt_engagement(half_year["daily"], half_year["sessions"], half_year["users"])
    r = m.where("activity_date = date'2026-06-29'").first()
    assert (r["dau"], r["wau"], r["mau"]) == (20, 20, 50)
    assert (r["stickiness_dau_mau"], r["feature_adoption_rate"]) == (0.4, 0.1)
    assert (r["dormant_users_count"], r["power_users_count"], r["bounce_rate"]) == (150, 5, 0.0)
    assert (r["avg_session_duration_seconds"], r["sessions_per_user"]) == (420.0, 1.0)


def test_activation(half_year):
    r = marts.mrt_activation(half_year["events"], half_year["users"]).first()
    assert (r["total_cohort_new_users"], r["activated_users_7d"], r["activation_rate_7d"]) == (200, 50, 0.25)


def test_feature_events(half_year):
    m = marts.mrt_product(half_year["daily"], half_year["ratings"], half_year["sessions"])
    got = {r["feature_key"]: (r["total_events_count"], r["rank_most_used"]) for r in m.collect()}
    assert got == {marts.FEATURES[0]: (51840, 1), marts.FEATURES[1]: (1800, 3), marts.FEATURES[2]: (4320, 2)}


@pytest.fixture(scope="module")
def small_cohort(spark):
    rows = [(20260101, 1001, 1), (20260101, 1003, 0), (20260101, 1004, 1), (20260108, 1001, 1), (20260108, 1004, 1), (20260131, 1001, 1)]
    return spark.createDataFrame(rows, "date_sk int, user_sk bigint, has_completed_core_action int")


def test_retention_by_first_activity(small_cohort):
    r = metrics.retention_first_activity(small_cohort).first()
    assert tuple(r) == (date(2026, 1, 1), 3, 2, 1, 66.67, 33.33)


def test_north_star(small_cohort):
    got = sorted(tuple(r) for r in metrics.north_star_weekly(small_cohort).collect())
    assert got == [(2026, 1, 3, 2, 66.67), (2026, 2, 2, 2, 100.0), (2026, 5, 1, 1, 100.0)]


T1, T2 = datetime(2026, 1, 15, 8), datetime(2026, 6, 1, 10)


def test_role_change_makes_two_versions(spark):
    log = spark.createDataFrame(
        [(42, T1, 1, "Aluno"), (42, datetime(2026, 3, 1), 2, "Aluno"), (42, T2, 3, "Coordenador")],
        "user_id bigint, ts timestamp_ntz, seq bigint, role string",
    )
    got = history.history_from_changes(log, "user_id", "ts", "seq", ["role"]).orderBy("valid_from")
    assert [tuple(r)[2:] for r in got.collect()] == [("Aluno", T1, T2, False), ("Coordenador", T2, None, True)]


def test_snapshot_merge(spark):
    columns = "user_id bigint, university_id bigint, course_id bigint, role string, registration_date date, status string"
    day = date(2026, 1, 15)
    one = spark.createDataFrame([(42, 1, 101, "Aluno", day, "ativo"), (43, 1, None, "Aluno", day, "ativo")], columns)
    versions = history.first_snapshot(one)
    two = spark.createDataFrame([(42, 1, 101, "Coordenador", day, "ativo"), (44, 2, 7, "Aluno", day, "ativo")], columns)
    merged = history.merge_snapshot(versions, two, "2026-06-01 10:00:00")
    got = {(r["user_id"], r["role"]): (r["valid_from"], r["valid_to"]) for r in merged.collect()}
    midnight = datetime(2026, 1, 15)
    assert got == {
        (42, "Aluno"): (midnight, T2),
        (42, "Coordenador"): (T2, None),
        (43, "Aluno"): (midnight, None),
        (44, "Aluno"): (T2, None),
    }
    # Nothing changes when the same snapshot comes again; closed versions stay closed.
    again = history.merge_snapshot(merged, two, "2026-07-01 00:00:00")
    assert sorted(map(str, again.collect())) == sorted(map(str, merged.collect()))
    users = dimensions.dim_users(merged)
    assert users.select("user_sk").distinct().count() == 4
    assert users.where("is_current").count() == 3
    assert users.where("course_sk IS NULL").count() == 1
    assert users.where("user_id = 44").first()["university_sk"] == surrogate_key_of("2")


def test_version_at(spark):
    changes = [(42, T1, 1, "Aluno"), (42, T2, 3, "Coordenador")]
    log = spark.createDataFrame(changes, "user_id bigint, ts timestamp_ntz, seq bigint, role string")
    versions = history.history_from_changes(log, "user_id", "ts", "seq", ["role"])
    moments = [(1, T1 - timedelta(seconds=1)), (2, T1), (3, T2 - timedelta(seconds=1)), (4, T2), (5, T2 + timedelta(days=99))]
    facts = spark.createDataFrame([(i, 42, t) for i, t in moments] + [(6, 7, T2)], "id int, user_id bigint, at timestamp_ntz")
    got = {r["id"]: r["role"] for r in history.version_at(facts, versions, "user_id", "at", ["role"]).collect()}
    assert got == {1: None, 2: "Aluno", 3: "Aluno", 4: "Coordenador", 5: "Coordenador", 6: None}


def test_calendar(spark):
    cal = dimensions.dim_date(spark, "2025-12-29", "2026-01-04")
    r = {str(x["full_date"]): x for x in cal.collect()}
    assert len(r) == 7
    assert (r["2025-12-29"]["iso_year"], r["2025-12-29"]["week_of_year"], r["2025-12-29"]["year"]) == (2026, 1, 2025)
    assert r["2026-01-03"]["is_weekend"] and not r["2026-01-02"]["is_weekend"]
    assert r["2026-01-01"]["month_name"] == "January" and r["2026-01-04"]["day_of_week"] == 7
    terms = dimensions.dim_academic_periods(dimensions.dim_date(spark, "2026-01-01", "2026-12-31"))
    assert sorted(x["academic_period"] for x in terms.collect()) == ["2026.1", "2026.2"]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_fuzzy_names_against_all_pairs(spark):
    rnd = random.Random(2)
    names = {"Ana Silva", "ana silva", "Anna Silva", "Ama Silva", "nAa Silva", "Ana Silv", "na Silva", "Bruno Costa", "a", "b", "ab"}
    names |= {"".join(rnd.choice("abc") for _ in range(rnd.randint(1, 6))) for _ in range(150)}
    d = spark.createDataFrame([(n,) for n in sorted(names)], "docente_name_clean string")
    got = {r["docente_name_clean"]: r["resolved_name"] for r in dimensions.resolve_professors(d).collect()}
    assert got == {n: min(m for m in names if edits(n.lower(), m.lower()) <= 1) for n in names}
