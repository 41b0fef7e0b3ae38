import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lumenmart.operators import key_index, sinks
from lumenmart.sources.contract import EPOCH


def batch(spark, *data):
    df = spark.createDataFrame(data, "id string, t string, v int")
    return df.select("id", F.to_timestamp_ntz("t").alias("ts"), "v")


def content(spark, path):
    return sorted((r["id"], str(r["ts"]), r["v"], r["event_month"]) for r in sinks.read_table(spark, path).collect())


def test_month_routing(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [("a", "2026-01-15 10:00:00", 1), ("b", "2026-02-15 10:00:00", 2), ("c", "2026-07-15 14:30:00", 3), ("d", None, 4)]
    sinks.write_months(batch(spark, *rows), path, "ts", ["id"])
    folders = sorted(f for f in os.listdir(path) if f.startswith("event_month"))
    assert folders == ["event_month=2026-01", "event_month=2026-02", "event_month=2026-07", "event_month=__HIVE_DEFAULT_PARTITION__"]
    table = sinks.read_table(spark, path)
    assert sinks.months_of(table) == ["2026-01", "2026-02", "2026-07", sinks.NULL_MONTH]
    assert sinks.only_months(table, ["2026-07"]).count() == 1
    assert sinks.only_months(table, [sinks.NULL_MONTH]).count() == 1
    assert sinks.only_months(table, []).count() == 0


def test_append_twice_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    b = batch(spark, ("a", "2026-01-15 10:00:00", 1), ("a", "2026-01-15 10:00:00", 1), ("b", "2026-02-01 00:00:00", 2))
    first = sinks.append_events(spark, path, b, "id", "ts")
    assert (first.extracted, first.added, first.newest) == (3, 2, datetime(2026, 2, 1))
    second = sinks.append_events(spark, path, b, "id", "ts")
    assert (second.extracted, second.added) == (3, 0)
    third = sinks.append_events(spark, path, batch(spark, ("b", "2026-02-01 00:00:00", 9), ("c", "2026-02-02 00:00:00", 3)), "id", "ts")
    assert third.added == 1
    assert [r[0] for r in content(spark, path)] == ["a", "b", "c"]
    assert content(spark, path)[1][2] == 2  # the stored row wins
    nothing = sinks.append_events(spark, path, b.where("false"), "id", "ts")
    assert (nothing.extracted, nothing.added, nothing.newest, nothing.months) == (0, 0, None, [])
    assert first.months == ["2026-01", "2026-02"] and sorted(os.listdir(tmp_path)) == ["t"]


def test_delete_insert_moves_rows_between_months(spark, tmp_path):
    path = str(tmp_path / "t")
    old = batch(spark, ("a", "2026-01-15 10:00:00", 1), ("b", "2026-02-15 10:00:00", 2), ("c", "2026-03-15 10:00:00", 3))
    sinks.delete_insert_table(spark, path, old, "id", "ts")
    new = batch(spark, ("b", "2026-03-01 00:00:00", 20), ("d", "2026-04-01 00:00:00", 4))
    sinks.delete_insert_table(spark, path, new, "id", "ts")
    assert content(spark, path) == [
        ("a", "2026-01-15 10:00:00", 1, "2026-01"),
        ("b", "2026-03-01 00:00:00", 20, "2026-03"),
        ("c", "2026-03-15 10:00:00", 3, "2026-03"),
        ("d", "2026-04-01 00:00:00", 4, "2026-04"),
    ]
    # The same batch again changes nothing.
    sinks.delete_insert_table(spark, path, new, "id", "ts")
    assert len(content(spark, path)) == 4


def test_upsert_overwrites_only_named_columns(spark):
    columns = "id bigint, name string, role string"
    old = spark.createDataFrame([(1, "a", "Aluno"), (2, "b", "Aluno")], columns)
    new = spark.createDataFrame([(2, "changed", "Admin"), (3, "c", "Aluno")], columns)
    got = sorted(tuple(r) for r in sinks.upsert(old, new, "id", ["role"]).collect())
    assert got == [(1, "a", "Aluno"), (2, "b", "Admin"), (3, "c", "Aluno")]


def test_insert_if_absent_keeps_first_copy(spark):
    old = spark.createDataFrame([(1, 10)], "id bigint, v int")
    new = spark.createDataFrame([(1, 99), (2, 30), (2, 20)], "id bigint, v int")
    assert [tuple(r) for r in sinks.insert_if_absent(old, new, "id", ["v"]).collect()] == [(2, 20)]


def test_replace_table_reading_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_table(spark, spark.range(5), path)
    sinks.replace_table(spark, sinks.read_table(spark, path).where("id > 1"), path)
    assert sinks.read_table(spark, path).count() == 3
    assert sorted(os.listdir(tmp_path)) == ["t"]


def test_swap_cut_short(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not sinks.table_exists(spark, path)
    sinks.replace_table(spark, spark.range(5), path)
    os.rename(path, path + "__old")  # as if lost between the two renames
    assert sinks.table_exists(spark, path)
    assert sinks.read_table(spark, path).count() == 5


def test_watermarks(spark, tmp_path):
    w = sinks.Watermarks(spark, str(tmp_path / "w"))
    assert w.get("events") == EPOCH
    w.update("events", "2026-01-10T12:00:00+00:00")
    w.update("other", "2026-05-10T12:00:00+00:00")
    assert w.get("events") == "2026-01-10T12:00:00+00:00"
    w.update("events", "2026-02-10T12:00:00+00:00")
    assert w.get("events") == "2026-02-10T12:00:00+00:00"
    w.reset("events")
    assert w.get("events") == EPOCH
    assert w.get("other") == "2026-05-10T12:00:00+00:00"


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "runs")
    start, end = datetime(2026, 1, 1, 12), datetime(2026, 1, 1, 12, 0, 2, 450000)
    extract = sinks.Run("load", "sample", "extract", start, end, 488, 480)
    failed = sinks.Run("load", "sample", "gate", start, end, status="FAILED", error="x")
    sinks.log_runs(spark, path, [extract, failed])
    sinks.log_runs(spark, path, [])
    got = {r["stage"]: r for r in sinks.read_table(spark, path).collect()}
    assert float(got["extract"]["duration_seconds"]) == 2.45
    assert (got["extract"]["rows_loaded"], got["gate"]["status"], got["gate"]["error_message"]) == (480, "FAILED", "x")
    assert got["extract"]["run_sk"] != got["gate"]["run_sk"]


def test_export(spark, tmp_path):
    df = spark.range(25).selectExpr("date_add(date'2026-01-01', cast(id as int)) AS d", "id / 2 AS x")
    rows = sinks.export_rows(df, "d", str(tmp_path / "out")).collect()
    assert len(rows) == 10
    assert rows[0]["row_json"] == '{"d":"2026-01-25","x":12.0}'
    assert spark.read.json(str(tmp_path / "out")).count() == 10


@pytest.mark.parametrize("copies", [1, 400])
def test_first_per_key_with_many_copies(spark, copies):
    df = spark.range(copies).selectExpr("'k' AS id", "id AS v").unionByName(spark.createDataFrame([("z", 5)], "id string, v bigint"))
    assert sorted(tuple(r) for r in sinks.first_per_key(df, "id", ["v"]).collect()) == [("k", 0), ("z", 5)]


def year_of_rows(spark, n, first=0):
    """Rows of twelve months with ids that nothing orders."""
    ids = spark.range(first, first + n)
    return ids.select(
        F.md5(F.col("id").cast("string")).alias("id"),
        F.expr("timestamp_ntz'2026-01-10 00:00:00' + make_interval(0, cast(id % 12 as int))").alias("ts"),
        F.col("id").cast("int").alias("v"),
    )


def test_a_small_load_opens_few_files_of_the_index(spark, tmp_path, monkeypatch):
    """Twelve months are stored; a load of new rows and one retry reads the files that may hold the retry, none of the table."""
    monkeypatch.setattr(key_index, "BUCKET_KEYS", 500)
    monkeypatch.setattr(key_index.KeyIndex.__init__, "__defaults__", (500,))
    path = str(tmp_path / "t")
    sinks.append_events(spark, path, year_of_rows(spark, 20_000), "id", "ts")
    index = key_index.KeyIndex(spark, path, "id")
    files_of_all = len(index._read(index.spans.current()).inputFiles())
    assert files_of_all >= 8 and len(sinks.months_of(sinks.read_table(spark, path))) == 12
    small = year_of_rows(spark, 20, first=19_999)
    assert 1 <= len(index.holding(small).inputFiles()) <= 2 and index.holding(small).count() == 1
    assert not any("event_month" in f for f in index.holding(small).inputFiles())
    assert sinks.append_events(spark, path, small, "id", "ts").added == 19
    assert sinks.read_table(spark, path).select("id").distinct().count() == sinks.read_table(spark, path).count() == 20_019


def test_key_index_finds_all_and_lets_few_through(spark, tmp_path):
    index = key_index.KeyIndex(spark, str(tmp_path), "k", bucket_keys=1000)
    index.add(spark.range(30_000).withColumnRenamed("id", "k"))
    assert index.holding(spark.range(0, 60_000, 7).withColumnRenamed("id", "k")).count() == len(range(0, 30_000, 7))
    through = sum(bool(index.buckets(spark.createDataFrame([(k,)], "k bigint"))) for k in range(40_000, 40_005))
    assert through == 0
    nulls = spark.createDataFrame([(None,), (None,)], "k bigint")
    index.add(nulls)
    assert index.holding(nulls).count() == 0 and index.buckets(nulls) == []


def test_spans_of_many_loads_are_few(spark, tmp_path):
    index = key_index.KeyIndex(spark, str(tmp_path), "k")
    index.spans.fanout = 3
    for i in range(10):
        index.add(spark.range(i * 10, i * 10 + 10).withColumnRenamed("id", "k"))
    assert index.spans.current() == [(0, 8), (9, 9)]
    assert index.holding(spark.range(-5, 200).withColumnRenamed("id", "k")).count() == 100


def test_append_cut_short_is_completed_by_the_next(spark, tmp_path, monkeypatch):
    """Rows are stored but the index lacks them: they count as stored all the same, once."""
    path = str(tmp_path / "t")
    sinks.append_events(spark, path, batch(spark, ("a", "2026-01-15 10:00:00", 1)), "id", "ts")
    more = batch(spark, ("b", "2026-02-15 10:00:00", 2), ("c", "2026-03-15 10:00:00", 3))
    with monkeypatch.context() as m:
        m.setattr(key_index.KeyIndex, "add", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            sinks.append_events(spark, path, more, "id", "ts")
    assert len(content(spark, path)) == 3
    # Half of what was added is gone as well: the write itself was cut short.
    sinks.drop_table(spark, f"{path}/event_month=2026-03")
    again = sinks.append_events(spark, path, more.unionByName(batch(spark, ("d", "2026-03-16 10:00:00", 4))), "id", "ts")
    assert again.added == 1 and [r[0] for r in content(spark, path)] == ["a", "b", "c", "d"]
    assert sorted(os.listdir(tmp_path)) == ["t"]


def test_delete_insert_cut_short_between_overwrite_and_drop(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sinks.delete_insert_table(spark, path, batch(spark, ("a", "2026-01-15 10:00:00", 1), ("b", "2026-02-15 10:00:00", 2)), "id", "ts")
    moved = batch(spark, ("b", "2026-03-01 00:00:00", 20))
    drop = sinks.drop_table

    def lost(spark, path):
        if "event_month" in path:
            raise OSError("lost")
        drop(spark, path)

    with monkeypatch.context() as m:
        m.setattr(sinks, "drop_table", lost)
        with pytest.raises(OSError):
            sinks.delete_insert_table(spark, path, moved, "id", "ts")
    assert [r[0] for r in content(spark, path)] == ["a", "b", "b"]  # both months hold the key for now
    sinks.delete_insert_table(spark, path, batch(spark, ("c", "2026-05-01 00:00:00", 3)), "id", "ts")
    assert [(r[0], r[3]) for r in content(spark, path)] == [("a", "2026-01"), ("b", "2026-03"), ("c", "2026-05")]
    assert sorted(os.listdir(tmp_path)) == ["t"]


def test_delete_insert_reads_its_batch_once(spark, tmp_path):
    """A source that changes between readings would otherwise give months, keys and rows that don't fit each other."""
    path, seen = str(tmp_path / "t"), spark.sparkContext.accumulator(0)
    sinks.delete_insert_table(spark, path, batch(spark, ("a", "2026-01-15 10:00:00", 1)), "id", "ts")

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    new = batch(spark, ("a", "2026-02-15 10:00:00", 2)).coalesce(1)
    sinks.delete_insert_table(spark, path, new.mapInArrow(count, new.schema), "id", "ts")
    assert seen.value == 1 and content(spark, path) == [("a", "2026-02-15 10:00:00", 2, "2026-02")]
