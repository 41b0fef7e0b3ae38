import hashlib
import json
from datetime import datetime

from pyspark.sql import functions as F

from lumenmart.operators import sinks, staging
from lumenmart.sources import catalog, contract, readers

RECORDS = [
    {"event_id": "e1", "event_name": "discipline_rated", "session_id": "s1", "user_id": 5, "platform": "web",
     "app_version": "1.2.0", "event_ts": "2026-01-10T12:00:00Z", "payload_json": '{"dificuldade": 4}'},
    {"event_id": "e2", "event_name": "screen_viewed", "session_id": "s1", "user_id": None, "platform": None,
     "app_version": None, "event_ts": "2026-01-10T12:00:00+02:00", "payload_json": "{oops"},
    {"event_id": "e3", "event_name": "never_heard_of", "session_id": "s2", "user_id": 6, "event_ts": "2026-01-09T00:00:00Z"},
]


def test_event_file_to_landing_rows(spark, tmp_path):
    path = tmp_path / "events.json"
    path.write_text(json.dumps(RECORDS))
    raw = readers.read_event_file(spark, str(path), multi_line=True)
    landing = readers.normalise_events(raw, F.lit("2026-01-11 00:00:00").cast("timestamp_ntz"))
    assert landing.columns == contract.ANALYTICS_EVENTS.fieldNames()
    got = {r["id"]: r for r in landing.collect()}
    assert (got["e1"]["category"], got["e1"]["priority"]) == ("Ratings", "Critical")
    assert got["e1"]["timestamp"] == datetime(2026, 1, 10, 12)
    assert got["e2"]["timestamp"] == datetime(2026, 1, 10, 10)
    assert (got["e2"]["user_id"], got["e2"]["platform"], got["e2"]["app_version"], got["e2"]["payload"]) == (0, "web", "1.0.0", "{}")
    assert (got["e3"]["category"], got["e3"]["priority"], got["e3"]["payload"]) == ("General", "Normal", "{}")


def test_lines_file(spark, tmp_path):
    path = tmp_path / "events.jsonl"
    path.write_text("\n".join(json.dumps(r) for r in RECORDS))
    assert readers.read_event_file(spark, str(path)).count() == 3


def events(spark):
    data = [("a", "2026-01-01 00:00:00"), ("b", "2026-01-01 00:00:00"), ("c", "2026-01-02 00:00:00"), ("d", "2026-01-03 00:00:00")]
    return spark.createDataFrame(data, "id string, t string").selectExpr("id", "cast(t as timestamp_ntz) AS timestamp")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_incremental_read(spark):
    e = events(spark)
    assert ids(readers.incremental(e, contract.EPOCH)) == ["a", "b", "c", "d"]
    # Strictly after, so the watermark row itself is not read again.
    assert ids(readers.incremental(e, "2026-01-02T00:00:00+00:00")) == ["d"]
    assert ids(readers.incremental(e, "2026-01-02T00:00:00+00:00", lookback_days=1)) == ["c", "d"]
    assert ids(readers.incremental(e, "2026-01-02T00:00:00+00:00", full_refresh=True)) == ["a", "b", "c", "d"]
    assert ids(readers.incremental(e, contract.EPOCH, limit=2)) == ["a", "b"]


def test_operational_users_leave_personal_columns_out(spark):
    users = spark.createDataFrame(
        [(1, "Ana", "a@x", "2026-01-05 10:00:00", "ativo"), (2, "Bia", "b@x", None, None)],
        "id bigint, nome string, email string, created_at string, status string",
    ).withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))
    enrol = spark.createDataFrame([(1, 9, 77)], "usuario_id bigint, faculdade_id int, curso_id int")
    out = readers.users_from_operational(users, enrol)
    assert out.columns == contract.USERS.fieldNames()
    assert [tuple(map(str, r)) for r in out.orderBy("id_usuario").collect()] == [
        ("1", "9", "77", "Aluno", "2026-01-05", "ativo"),
        ("2", "1", "None", "Aluno", "2026-01-01", "ativo"),
    ]
    # A source without a status column gets the default.
    assert readers.users_from_operational(users.drop("status"), enrol).where("status = 'ativo'").count() == 2


def test_operational_disciplines(spark):
    rows = [(7, " ", None, None), (8, "MAT1", "Calculo", 90)]
    d = spark.createDataFrame(rows, "id bigint, codigo string, nome string, carga_horaria int")
    assert [tuple(r) for r in readers.disciplines_from_operational(d).orderBy("id_disciplina").collect()] == [
        (7, "DISC7", "Disciplina 7", 4, 60),
        (8, "MAT1", "Calculo", 4, 90),
    ]


def test_pseudonym(spark):
    df = spark.createDataFrame([(5,), (None,)], "user_id bigint")
    got = {r["user_key"] for r in readers.pseudonymise(df, "salt").collect()}
    assert got == {hashlib.sha256(b"salt5").hexdigest(), None}


def test_declared_sources(spark, tmp_path):
    path = str(tmp_path / "u")
    spark.range(3).write.parquet(path)
    assert readers.source(spark, "usuarios", {"usuarios": path}).count() == 3
    assert set(readers.SOURCE_TABLES) == {"analytics_events", "usuarios", "curriculo_disciplinas", "faculdades", "cursos"}


def test_month_predicate_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "e")
    e = spark.range(90).selectExpr("id", "timestampadd(DAY, cast(id as int), timestamp_ntz'2026-01-01 12:00:00') AS event_ts")
    sinks.write_months(e, path, "event_ts", ["id"])
    scan = readers.time_range(sinks.read_table(spark, path), "2026-02-01 00:00:00", "2026-02-15 00:00:00")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "event_month" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(event_ts" in plan.split("PushedFilters: [")[1]
    assert scan.count() == 14
    files = {f.split("event_month=")[1][:7] for f in scan.inputFiles()}
    assert "2026-02" in files


def test_catalogue_is_complete():
    names = [e[0] for e in catalog.EVENTS]
    assert len(names) == len(set(names)) == 39
    assert {e[1] for e in catalog.EVENTS} == set(contract.CATEGORIES)
    assert {e[2] for e in catalog.EVENTS} == set(contract.PRIORITIES)
    assert len(catalog.METRICS) == 56 + 3


def test_every_metric_has_a_query_with_that_column(star):
    from lumenmart.plans.registry import QUERIES

    seen = {}
    for query, column in catalog.METRICS.values():
        if query not in seen:
            seen[query] = QUERIES[query](star).columns
        assert column in seen[query], (query, column)


def test_staging_columns(star):
    assert staging.stg_events(star.raw_events).columns[-1] == "event_date_sk"
    assert [f.name for f in star.raw_events.schema] == contract.ANALYTICS_EVENTS.fieldNames()
    assert [f.name for f in star.raw_users.schema] == contract.USERS.fieldNames()
    assert [f.name for f in star.raw_disciplines.schema] == contract.DISCIPLINES.fieldNames()
    assert [f.name for f in star.pipeline_runs.schema] == contract.PIPELINE_RUNS.fieldNames()
