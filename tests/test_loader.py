import pytest
from pyspark.sql import functions as F

from lumenmart.operators import sinks
from lumenmart.operators.ranking import nth_row, up_to
from lumenmart.plans.loader import MARTS, Warehouse, materialise
from lumenmart.plans.registry import latest_profiles, mart
from lumenmart.plans.star import StoredStar


def test_two_loads_and_a_repeat(spark, star, tmp_path):
    w = Warehouse(spark, str(tmp_path / "wh"))
    src = star.sample
    early = src.analytics_events().where(F.col("created_at") < F.lit("2024-01-16").cast("timestamp_ntz"))
    first = w.run(early, src.usuarios(), src.curriculo_disciplinas(), "2024-01-16 00:00:00")
    assert first.added == early.count()

    second = w.run(src.deliveries(), latest_profiles(star), src.curriculo_disciplinas(), "2024-02-01 00:00:00")
    total = star.raw_events.count()
    assert first.added + second.added == total  # late arrivals included
    assert w.watermarks.get("events_sample").startswith("2024-01-30T")

    third = w.run(src.deliveries(), latest_profiles(star), src.curriculo_disciplinas(), "2024-02-02 00:00:00")
    assert third.added == 0
    for table in ("analytics_events", "fct_events"):
        assert w.table(table).count() == total
    assert w.table("fct_sessions").count() == star.fct_sessions.count()
    assert w.table("fct_ratings").count() == star.fct_ratings.count()
    assert w.table("fct_daily_user_activity").agg(F.sum("events_count")).first()[0] == total

    users = w.table("dim_users")
    assert users.where("is_current").count() == star.raw_users.count()
    assert users.count() > star.raw_users.count()
    runs = w.table("pipeline_runs")
    assert runs.where("status = 'SUCCESS'").count() == runs.count() == 15
    assert runs.where("stage = 'extract'").agg(F.sum("rows_loaded")).first()[0] == total
    for name in MARTS:
        assert w.mart(name).count() > 0
    # Built month by month or at once, and with one or two versions per user: the same rows.
    for name in set(MARTS) - {"mrt_data_engineering"}:
        assert sorted(map(str, w.mart(name).collect())) == sorted(map(str, mart(star, name).collect())), name
    for table in ("dim_date", "dim_screens", "dim_professors", "dim_academic_periods"):
        assert sorted(map(tuple, w.table(table).collect())) == sorted(map(tuple, getattr(star, table).collect()))
    assert sorted(w.table("fct_sessions").select("session_id", "session_duration_seconds").collect()) == sorted(
        star.fct_sessions.select("session_id", "session_duration_seconds").collect()
    )
    assert w.table("quality_results").where("failures > 0").count() == 2  # raw platform names, warnings only


def test_cut_short_run_is_completed_by_the_next(spark, star, tmp_path, monkeypatch):
    w = Warehouse(spark, str(tmp_path / "wh"))
    src = star.sample
    inputs = (src.analytics_events(), src.usuarios(), src.curriculo_disciplinas(), "2024-02-01 00:00:00")
    write = w.write_rollups

    def lost(rows):
        raise RuntimeError("machine lost")

    monkeypatch.setattr(w, "write_rollups", lost)
    with pytest.raises(RuntimeError, match="machine lost"):
        w.run(*inputs)
    got = {r["stage"]: r["status"] for r in w.table("pipeline_runs").collect()}
    assert got == {"extract": "SUCCESS", "reference": "SUCCESS", "transform": "FAILED"}
    # Landing and facts are written, the rollups are not, and the watermark has not moved.
    assert w.table("fct_events").count() == star.raw_events.count()
    assert w.watermarks.get("events_sample").startswith("1970")

    monkeypatch.setattr(w, "write_rollups", write)
    again = w.run(*inputs)
    assert again.added == 0
    assert w.table("fct_events").count() == star.raw_events.count()
    assert w.table("fct_sessions").count() == star.fct_sessions.count()
    assert sorted(map(str, w.mart("mrt_engagement").collect())) == sorted(map(str, mart(star, "mrt_engagement").collect()))
    assert w.watermarks.get("events_sample").startswith("2024-01-30")


def test_first_load_without_events(spark, star, tmp_path):
    w = Warehouse(spark, str(tmp_path / "wh"))
    nothing = star.sample.analytics_events().where("false")
    loaded = w.extract_events(nothing)
    assert (loaded.added, loaded.newest) == (0, None)
    assert w.table("analytics_events").count() == 0
    assert w.extract_events(star.sample.analytics_events()).added == star.raw_events.count()


def test_late_arrivals_of_any_age_are_loaded(spark, star, tmp_path):
    w = Warehouse(spark, str(tmp_path / "wh"))
    raw = star.sample.analytics_events()
    old = F.col("timestamp") < F.lit("2024-01-05").cast("timestamp_ntz")
    stamped = raw.withColumn("created_at", F.when(old, F.lit("2024-06-01")).otherwise(F.lit("2024-02-01")).cast("timestamp_ntz"))
    first = w.extract_events(stamped.where(~old))
    w.watermarks.update("arrivals_sample", first.newest_arrival.isoformat() + "+00:00")
    assert w.extract_events(stamped).added == raw.where(old).count() > 0


def test_watermark_never_goes_back(spark, tmp_path):
    marks = sinks.Watermarks(spark, str(tmp_path / "marks"))
    marks.update("a", "2024-01-05T00:00:00+00:00")
    marks.update("a", "2024-01-03T00:00:00+00:00")
    assert marks.get("a").startswith("2024-01-05")
    marks.reset("a")
    assert marks.get("a").startswith("1970")


def test_filters_on_a_stored_star(spark, star, tmp_path):
    stored = materialise(star, str(tmp_path / "stored"))
    for filters in ({"platform": "mobile"}, {"university_id": 1}, {"date_from": "2024-01-08", "date_to": "2024-01-21"}):
        for name in ("fct_sessions", "fct_daily_user_activity"):
            lazy, kept = getattr(star.filtered(**filters), name), getattr(stored.filtered(**filters), name)
            assert sorted(map(str, lazy.select(sorted(lazy.columns)).collect())) == sorted(map(str, kept.select(sorted(lazy.columns)).collect()))
    both = stored.filtered(platform="mobile").filtered(date_from="2024-01-20").fct_events
    assert both.where("NOT startswith(platform, 'mobile') OR event_ts < timestamp_ntz'2024-01-20'").count() == 0
    assert 0 < both.count() < stored.filtered(platform="mobile").fct_events.count()


def test_days_prune_months_of_a_loaded_warehouse(spark, star, tmp_path):
    path = str(tmp_path / "wh")
    fact = star.fct_events
    moved = fact.withColumn("event_ts", F.expr("event_ts + INTERVAL 60 DAYS")).withColumn("event_id", F.concat("event_id", F.lit("x")))
    sinks.write_months(fact.unionByName(moved), f"{path}/fct_events", "event_ts", ["event_id"])
    pruned = StoredStar(spark, path).of_months("2024-01-08", "2024-01-21").fct_events
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "event_month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert pruned.count() == fact.count()


def test_limit_falls_within_equal_times_and_no_task_gets_all_rows(spark, tmp_path):
    """Rows of one arrival and time, of none, and repeated ids; the limited rows are the first of all, and lie in many tasks."""
    w = Warehouse(spark, str(tmp_path / "wh"))
    at = "CASE WHEN id % 7 = 0 THEN NULL WHEN id % 7 < 4 THEN timestamp_ntz'2024-01-02 03:04:05.678901' ELSE timestampadd(SECOND, id % 50, timestamp_ntz'2024-01-03') END"
    events = spark.range(3000).selectExpr("cast(id % 2500 as string) AS id", f"{at} AS created_at", "timestamp_ntz'2024-01-01' AS timestamp", "id AS n")
    first = {}
    for r in sorted(events.collect(), key=lambda r: (r.created_at is not None, r.created_at, r.n)):
        first.setdefault(r.id, r)
    wanted = sorted(first.values(), key=lambda r: (r.created_at is not None, r.created_at, r.id))
    taken = []
    while loaded := w.extract_events(events, limit=1100).added:
        taken.append(loaded)
        stored = {tuple(r) for r in w.table("analytics_events").select("id", "created_at", "n").collect()}
        assert stored == {(r.id, r.created_at, r.n) for r in wanted[: sum(taken)]}
    assert taken == [1100, 1100, 300]
    assert not [f for f in (tmp_path / "wh").iterdir() if "candidates" in f.name]


def test_limit_is_found_by_ranges(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.range(4000).selectExpr("cast(null as timestamp_ntz) AS t", "cast(id as string) AS id")
    try:
        last = nth_row(rows, ["t", "id"], 3000, str(tmp_path / "order"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    ids = sorted(str(i) for i in range(4000))
    assert (last.t, last.id) == (None, ids[2999])
    assert spark.read.parquet(str(tmp_path / "order")).groupBy("_range").count().agg(F.max("count")).first()[0] < 2000
    assert sorted(r.id for r in up_to(rows, last).collect()) == ids[:3000]
    assert nth_row(rows, ["t", "id"], 4001, str(tmp_path / "order")) is None
