"""Closed sessions of a stream in several runs against plain loops over its rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lumenmart.streaming.sessions import SessionStream

GAP, DELAY = 1800, 7200
SCHEMA = "user_id bigint, timestamp timestamp_ntz"
START = datetime(2024, 1, 1)


def made_up():
    """Batches that overlap in time, some rows far behind, and rows just a gap apart."""
    rng = random.Random(4)
    batches = []
    for k in range(4):
        rows = [(rng.randint(1, 6), START + timedelta(seconds=10_800 * k + rng.randint(-9000, 10_800))) for _ in range(60)]
        rows += [(7, START + timedelta(seconds=10_800 * k)), (7, START + timedelta(seconds=10_800 * k + GAP))]
        rows += [(8, START + timedelta(seconds=10_800 * k)), (8, START + timedelta(seconds=10_800 * k + GAP, microseconds=1))]
        batches.append(rows)
    batches[1] += [(None, START), (1, None)]
    return batches


def expected(batches):
    in_time, late, newest = [], [], None
    for rows in batches:
        rows = [r for r in rows if None not in r]
        mark = newest - timedelta(seconds=DELAY) if newest else datetime.min
        late += [r for r in rows if r[1] < mark]
        in_time += [r for r in rows if r[1] >= mark]
        newest = max([r[1] for r in rows] + ([newest] if newest else []))
    sessions = []
    for user in {u for u, _ in in_time}:
        times = sorted(t for u, t in in_time if u == user)
        start = 0
        for i in range(1, len(times) + 1):
            if i == len(times) or times[i] - times[i - 1] > timedelta(seconds=GAP):
                sessions.append((user, i - start, times[start], times[i - 1]))
                start = i
    mark = newest - timedelta(seconds=DELAY)
    return sorted(s for s in sessions if s[3] + timedelta(seconds=GAP) <= mark), sorted(late), sessions


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("sessions"))
    landing = f"{root}/landing"
    stream = SessionStream(spark, f"{root}/out", DELAY, GAP)
    queries = []
    for rows in made_up():
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(landing)
        queries.append(stream.run(spark.readStream.schema(SCHEMA).parquet(landing)))
    return stream, queries, landing


def test_closed_sessions_and_late_rows(finished):
    stream, _, _ = finished
    closed, late, sessions = expected(made_up())
    assert sorted(tuple(r) for r in stream.closed().collect()) == closed
    assert sorted(tuple(r) for r in stream.late().collect()) == late
    assert len(late) > 5 and 0 < len(closed) < len(sessions)
    assert any(s[1] == 2 and s[0] == 7 for s in closed) and all(s[1] == 1 for s in closed if s[0] == 8)


def test_state_holds_open_sessions_only_and_nothing_is_dropped(finished):
    _, queries, _ = finished
    closed, _, sessions = expected(made_up())
    last = queries[-1].recentProgress[-1]["stateOperators"][0]
    assert last["numRowsTotal"] == len(sessions) - len(closed)
    assert all(op["numRowsDroppedByWatermark"] == 0 for q in queries for p in q.recentProgress for op in p["stateOperators"])
    assert "rocksdb" in " ".join(last["customMetrics"]).lower()


def test_another_run_adds_nothing_and_a_replayed_batch_leaves_the_same(spark, finished):
    stream, _, landing = finished
    before = stream.closed().count(), stream.late().count()
    stream.run(spark.readStream.schema(SCHEMA).parquet(landing))
    for number in (0, 3):
        stream._split(spark.createDataFrame(made_up()[number], SCHEMA), number)
    assert (stream.closed().count(), stream.late().count()) == before
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")
    assert stream.newest.read().agg(F.max("number")).first()[0] == 3


def test_sessions_of_one_batch_bypass_the_state(finished):
    """State gets what another batch may have a part in; a batch that catches up is closed at once."""
    stream, queries, _ = finished
    closed, _, _ = expected(made_up())
    through_state = stream.spark.read.parquet(f"{stream.root}/closed").count()
    at_once = stream.spark.read.parquet(f"{stream.root}/in_time").where("not open").count()
    assert at_once > 0 and through_state + at_once == len(closed)


def test_catching_up_needs_little_state(spark, tmp_path):
    """Users a day apart in the batch: all are closed, and only the last day's are ever in state."""
    rows = [(u, START + timedelta(days=d, minutes=u)) for d in range(10) for u in range(30)]
    landing = str(tmp_path / "landing")
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(landing)
    stream = SessionStream(spark, str(tmp_path / "out"), DELAY, GAP)
    q = stream.run(spark.readStream.schema(SCHEMA).parquet(landing))
    assert stream.closed().count() == 9 * 30
    assert max(p["stateOperators"][0]["numRowsUpdated"] for p in q.recentProgress) <= 30
