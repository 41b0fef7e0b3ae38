"""Streams against batch results, with a late row at the end that closes every window."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lumenmart.operators import sinks
from lumenmart.operators.slots import inactivity_sessions
from lumenmart.operators.spans import Spans
from lumenmart.sources import contract
from lumenmart.streaming import jobs


@pytest.fixture(scope="module")
def landing(star, tmp_path_factory):
    """Landing rows in three files by arrival, the last one far in the future."""
    path = str(tmp_path_factory.mktemp("landing"))
    raw = star.raw_events.coalesce(1)
    late = F.dayofmonth("timestamp") > 15
    raw.where(~late).write.mode("append").parquet(path)
    raw.where(late).write.mode("append").parquet(path)
    end = raw.limit(1).withColumns(
        {"id": F.lit("end"), "user_id": F.lit(-5).cast("bigint"), "timestamp": F.lit("2024-12-01").cast("timestamp_ntz")}
    )
    end.write.mode("append").parquet(path)
    return path


def stream(spark, landing):
    return jobs.read_stream(spark, landing, contract.ANALYTICS_EVENTS)


def test_session_windows_equal_batch(spark, star, landing):
    got = jobs.sessions_of_slots(jobs.partials(stream(spark, landing), "t-sessions", jobs.slot_sums))
    batch = inactivity_sessions(spark.read.parquet(landing), "user_id", "timestamp", 1800)
    expected = batch.select("user_id", "events_count", "session_start", "session_end")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_daily_activity_equals_batch(spark, star, landing):
    got = jobs.daily_activity(jobs.partials(stream(spark, landing), "t-daily", jobs.daily_sessions)).where("user_id <> -5")
    expected = star.fct_daily_user_activity.join(star.dim_users, "user_sk").select(
        "date_sk", "user_id", "session_count", "events_count", "ratings_submitted_count", "downloads_count", "uploads_count",
        "has_completed_core_action",
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_a_replayed_batch_counts_once(spark, star, tmp_path):
    """A batch that is run again overwrites what it left."""
    raw = star.raw_events.limit(50)
    for _ in range(2):
        jobs.daily_sessions(raw).write.mode("overwrite").parquet(str(tmp_path / "batch=0"))
    jobs.daily_sessions(raw).write.mode("overwrite").parquet(str(tmp_path / "batch=1"))
    total = jobs.daily_activity(spark.read.parquet(str(tmp_path))).agg(F.sum("events_count")).first()[0]
    assert total == 2 * raw.count()


def test_two_hundred_batches_leave_few_folders(spark, tmp_path):
    """What many batches leave, with merges cut short and batches repeated, adds up to all of it."""
    spans, cuts = Spans(spark, str(tmp_path), fanout=6), []

    def write(numbers, folder, done=True):
        os.makedirs(folder, exist_ok=True)
        pq.write_table(pa.table({"number": numbers}), f"{folder}/part-0.parquet")
        if done:
            open(f"{folder}/_SUCCESS", "w").close()

    def merge(group, span, folder):
        numbers = [n for s in group for n in pq.read_table(f"{spans.path(s)}/part-0.parquet")["number"].to_pylist()]
        cut = span in ((0, 5), (36, 71)) and span not in cuts
        write(numbers[: len(numbers) // 2] if cut else numbers, folder, done=not cut)
        if cut:
            cuts.append(span)
            raise OSError("lost")

    for number in range(200):
        for again in range(3 if number % 9 == 5 else 1):  # batches are repeated, also when they were merged
            try:
                spans.put(number - 20 if again == 2 and number > 20 else number, lambda s, folder: write([s[0]], folder))
                spans.merge(merge)
            except OSError:
                pass
    assert len(cuts) == 2 and len(spans.current()) <= 3 * 5
    assert sorted(r.number for r in spans.read().collect()) == list(range(200))
    spans.sweep()
    assert len([f for f in os.listdir(tmp_path) if f.startswith("span=")]) == len(spans.current())


def test_merged_stream_equals_batch(spark, star, landing, tmp_path):
    """Three batches, merged two by two, give the sessions of all rows."""
    one_by_one = jobs.read_stream(spark, landing, contract.ANALYTICS_EVENTS, max_files=1)
    jobs.run_partials(one_by_one, str(tmp_path / "data"), str(tmp_path / "checkpoint"), jobs.daily_sessions, fanout=2)
    spans = Spans(spark, str(tmp_path / "data"), fanout=2)
    assert spans.current() == [(0, 1), (2, 2)]
    got = jobs.daily_activity(spans.read())
    expected = jobs.daily_activity(jobs.daily_sessions(spark.read.parquet(landing)))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_append_stream_runs_twice(spark, star, landing, tmp_path):
    path, checkpoint = str(tmp_path / "events"), str(tmp_path / "checkpoint")
    log = str(tmp_path / "runs")
    jobs.run_append(stream(spark, landing), path, checkpoint, log)
    n = star.raw_events.count() + 1
    assert sinks.read_table(spark, path).count() == n
    runs = sinks.read_table(spark, log)
    assert runs.agg(F.sum("rows_extracted"), F.sum("rows_loaded")).first() == (n, n)
    assert {r.status for r in runs.collect()} == {"SUCCESS"}
    # Same checkpoint: nothing new. New checkpoint: everything is read again, nothing is stored twice.
    jobs.run_append(stream(spark, landing), path, checkpoint)
    jobs.run_append(stream(spark, landing), path, str(tmp_path / "other"))
    assert sinks.read_table(spark, path).count() == n


def test_single_file_stream(spark, star):
    schema = star.sample.table("events").schema
    q = jobs.read_stream(spark, f"{star.sample.sf_dir}/events.parquet", schema)
    assert q.isStreaming
