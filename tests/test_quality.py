import pytest
from pyspark.sql import functions as F

from lumenmart.plans import quality
from lumenmart.plans.registry import AS_OF, mart


def test_corrupt_rating_is_found(star):
    ratings = star.fct_ratings
    assert quality.invalid_scores(ratings).count() == 0
    one = ratings.agg(F.min("rating_id")).first()[0]
    bad = ratings.withColumn("dificuldade", F.when(F.col("rating_id") == one, 99).otherwise(F.col("dificuldade")))
    assert [r["rating_id"] for r in quality.invalid_scores(bad).collect()] == [one]


def test_future_duplicate_and_negative(star):
    events = star.event_rows
    assert quality.future_events(events, AS_OF).count() == 0
    assert quality.future_events(events, "2020-01-01 00:00:00").count() == events.count()
    assert quality.repeated_keys(events, "event_id").count() == 0
    assert quality.repeated_keys(events.unionByName(events.limit(3)), "event_id").count() == 3
    assert quality.negative_sessions(star.fct_sessions).count() == 0


def test_row_checks(spark):
    df = spark.createDataFrame([("web",), ("tv",), (None,)], "platform string")
    assert quality.null_rows(df, "platform").count() == 1
    assert [r[0] for r in quality.unaccepted_rows(df, "platform", ("web",)).collect()] == ["tv"]


def test_orphans_ignore_null_and_unknown(spark):
    fact = spark.createDataFrame([(1,), (2,), (2,), (None,), (-1,)], "fk bigint")
    dim = spark.createDataFrame([(1,)], "sk bigint")
    assert [tuple(r) for r in quality.orphan_keys(fact, "fk", dim, "sk").collect()] == [(2, 2)]


def test_gate(spark):
    results = spark.createDataFrame([("a", 0), ("b", 2)], "check string, failures bigint")
    assert quality.gate(results, warn_only=("b",)) == [("b", 2)]
    with pytest.raises(quality.QualityError, match="b: 2 rows"):
        quality.gate(results)


def test_metric_bounds(star):
    engagement, content = mart(star, "mrt_engagement"), mart(star, "mrt_content")
    assert quality.metric_bounds(engagement, content).count() == 0
    broken = engagement.withColumn("stickiness_dau_mau", F.lit(1.2))
    assert quality.metric_bounds(broken, content).count() == engagement.count()


UUID = "0a1b2c3d-0000-4000-8000-00000000000{}"


def test_contract(spark):
    good = {
        "id": UUID.format(1), "event_name": "login_failed", "category": "Auth", "priority": "Critical", "schema_version": "1",
        "session_id": UUID.format(2), "user_id": 1, "platform": "web", "app_version": "1.2.3",
        "payload": '{"method": "sso", "failure_reason": "x"}',
    }
    wrong = {
        "ok_event_id": {"id": "7"},
        "ok_event_name": {"event_name": "Login-Failed"},
        "ok_schema_version": {"schema_version": "0"},
        "ok_session_id": {"session_id": "s"},
        "ok_platform": {"platform": "mobile"},
        "ok_app_version": {"app_version": "1.2"},
        "ok_known_event": {"event_name": "login_faild"},
        "ok_category": {"category": "Search"},
        "ok_priority": {"priority": "Low"},
        "ok_payload": {"payload": '{"method": "sso"}'},
    }
    rows = [("good", good)] + [(rule, {**good, **change}) for rule, change in wrong.items()]
    df = spark.createDataFrame([{"case": c, **r} for c, r in rows])
    checked = {r["case"]: r for r in quality.check_contract(df).collect()}
    assert checked["good"]["is_valid"]
    for rule in wrong:
        assert not checked[rule][rule] and not checked[rule]["is_valid"], rule
    valid, quarantined = quality.split_quarantine(quality.check_contract(df))
    assert (valid.count(), quarantined.count()) == (1, 10)


def test_schema_drift(star):
    def drift(df):
        return {(r["kind"], r["name"]) for r in quality.schema_drift(df).where("kind <> 'field_unknown'").collect()}

    assert drift(star.raw_events) == set()
    odd = star.raw_events.withColumnRenamed("platform", "device").withColumn("event_name", F.lit("new_event"))
    assert drift(odd) == {("column_missing", "platform"), ("column_unknown", "device"), ("event_unknown", "new_event")}


def test_payload_types(spark):
    df = spark.createDataFrame(
        [("login_failed", '{"method": "sso"}'), ("search_performed", '{"query_length": "long", "result_count": 3}'),
         ("discipline_rated", '{"passou": "perhaps"}')], "event_name string, payload string"
    )
    got = sorted((r["event_name"], r["field"]) for r in quality.unknown_payload_types(df).collect())
    assert got == [("discipline_rated", "passou"), ("search_performed", "query_length")]


def test_rating_scores_with_odd_payloads(spark):
    from lumenmart.operators.facts import fct_ratings

    payloads = ['{"dificuldade": 4, "esforco": "2", "passou": true}', '{"dificuldade": "x", "passou": 0}', "{broken", '{"passou": "false"}', "{}"]
    df = spark.createDataFrame([(str(i), p) for i, p in enumerate(payloads)], "event_id string, payload_json string").selectExpr(
        "1L AS event_sk", "event_id", "20260101 AS event_date_sk", "1L AS user_sk", "cast(null as bigint) AS course_sk",
        "cast(null as bigint) AS professor_sk", "7L AS period_sk", "'professor_rated' AS event_name", "payload_json",
        "timestamp_ntz'2026-01-01 00:00:00' AS event_ts",
    )
    got = [(r["dificuldade"], r["esforco"], r["passou"], r["course_sk"]) for r in fct_ratings(df).orderBy("rating_id").collect()]
    assert got == [(4, 2, 1, -1), (3, 3, 0, -1), (3, 3, 1, -1), (3, 3, 0, -1), (3, 3, 1, -1)]


def test_payload_types_of_planted_rows(spark):
    from lumenmart.sources.catalog import payload_fields

    kinds = {"integer": '"7"', "string": "7", "boolean": '"true"', "number": '"x"', "array": "{}", "object": "[]"}
    fields = payload_fields(spark).collect()
    rows = [(r.event_name, f'{{"{r.field}": {kinds[r.field_type]}, "other": 1}}') for r in fields]
    rows += [(r.event_name, f'{{"{r.field}": null}}') for r in fields] + [(fields[0].event_name, "no json"), (fields[0].event_name, "{}")]
    found = quality.unknown_payload_types(spark.createDataFrame(rows, "event_name string, payload string")).collect()
    assert {(r.event_name, r.field, r.events) for r in found} == {(r.event_name, r.field, 1) for r in fields}


def test_orphans_are_counted_without_a_join(spark):
    """Repeated members, members nobody uses, keys of another check, unknown and missing keys; no broadcast that grows with the users."""
    used = spark.createDataFrame([(0, 1), (0, 1), (0, 2), (0, 3), (0, 3), (0, -1), (1, 2), (1, None)], "n int, key bigint")
    members = spark.createDataFrame([(0, 1), (0, 1), (0, 9), (1, 3), (1, None), (0, -1), (2, 5)], "n int, key bigint")
    found = quality._orphans(used, members)
    assert sorted(tuple(r) for r in found.collect()) == [(0, 3), (1, 1)]
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_suite_broadcasts_no_members(spark, star, tmp_path):
    plan = quality.dq_suite(star, "2024-02-01 00:00:00")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan


def test_members_of_one_file_are_dealt_out(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    keys = spark.range(1000).coalesce(1).selectExpr("array(0, 3) AS checks", "id AS key")
    try:
        sizes = [r["count"] for r in quality._members(keys).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 2000 and len(sizes) > 1
