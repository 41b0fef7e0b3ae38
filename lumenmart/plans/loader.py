"""The warehouse load: extract, snapshot, dimensions, facts, marts, gate, audit.

Steps run in a fixed order and each writes a table before the next reads it,
so lost executors cost a step at most, and a failed run is simply run again:
every step is idempotent, and the watermark moves only after the data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenmart.functions import key_to_date
from lumenmart.operators import dimensions as dims
from lumenmart.operators import facts, history, sinks, staging
from lumenmart.operators.ranking import nth_row, up_to
from lumenmart.plans import marts, quality
from lumenmart.plans.star import PersonStar, Star, StoredStar
from lumenmart.sources import readers

MARTS: dict[str, Callable[[Star], DataFrame]] = {
    "mrt_acquisition": lambda s: marts.mrt_acquisition(s.fct_daily_user_activity, s.dim_users),
    "mrt_activation": lambda s: marts.mrt_activation(s.fct_events, s.dim_users),
    "mrt_retention": lambda s: marts.mrt_retention(s.fct_daily_user_activity, s.dim_users),
    "mrt_engagement": lambda s: marts.mrt_engagement(s.fct_daily_user_activity, s.fct_sessions, s.dim_users),
    "mrt_content": lambda s: marts.mrt_content(s.fct_ratings, s.event_rows),
    "mrt_product": lambda s: marts.mrt_product(s.fct_daily_user_activity, s.fct_ratings, s.fct_sessions),
    "mrt_quality": lambda s: marts.mrt_quality(s.event_rows),
    "mrt_data_engineering": lambda s: marts.mrt_data_engineering(s.pipeline_runs),
    "mrt_monetization_readiness": lambda s: marts.mrt_monetization_readiness(
        s.fct_sessions, s.event_rows, s.fct_daily_user_activity
    ),
}

# Marts whose rows depend on one event day only -> its column.
DAILY_MARTS = {"mrt_content": "metric_date", "mrt_quality": "error_date"}

# Checks that the reported client platforms cannot meet; the platform group is checked instead.
WARN_ONLY = ("accepted_values.fct_events.platform", "accepted_values.stg_events.platform")


def together(jobs: list[Callable[[], None]], width: int = 4) -> None:
    """Run independent writes at the same time, so small ones fill idle cores."""
    with ThreadPoolExecutor(width) as pool:
        for done in [pool.submit(job) for job in jobs]:
            done.result()


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class Warehouse:
    """Incremental loads into one folder.

    Events are read by arrival (`created_at`): whatever arrived since the last
    load is taken, however old it is. `lookback_days` reads by event time
    instead, for sources without arrival times; events later than that are lost.
    """

    def __init__(
        self, spark: SparkSession, root: str, dag_id: str = "load_events", lane: str = "sample", lookback_days: int | None = None
    ):
        self.spark, self.root, self.dag_id, self.lane = spark, root.rstrip("/"), dag_id, lane
        self.lookback_days = lookback_days
        self._unlogged: list[sinks.Run] = []
        self.watermarks = sinks.Watermarks(spark, self.path("extract_watermarks"))
        self.star = StoredStar(spark, self.root)

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def table(self, name: str) -> DataFrame:
        return sinks.read_table(self.spark, self.path(name))

    def mart(self, name: str) -> DataFrame:
        return self.table(name).drop(sinks.MONTH, "_day")

    @contextmanager
    def audited(self, stage: str) -> Iterator[dict]:
        """Run a step and note it for the run log, also when it fails."""
        start, counts = _now(), {"extracted": 0, "loaded": 0}
        status, error = "SUCCESS", None
        try:
            yield counts
        except Exception as e:
            status, error = "FAILED", str(e)
            raise
        finally:
            self._unlogged.append(
                sinks.Run(self.dag_id, self.lane, stage, start, _now(), counts["extracted"], counts["loaded"], status, error)
            )

    def write_log(self) -> None:
        sinks.log_runs(self.spark, self.path("pipeline_runs"), self._unlogged)
        self._unlogged = []

    def extract_events(self, events: DataFrame, full_refresh: bool = False, limit: int | None = None) -> sinks.Loaded:
        source = f"events_{self.lane}"
        if full_refresh:
            self.watermarks.reset(source)
            self.watermarks.reset(f"arrivals_{self.lane}")
        if self.lookback_days is None:
            batch, oldest_first = events, "created_at"
            if not full_refresh:
                since = F.lit(self.watermarks.get(f"arrivals_{self.lane}"))
                batch = events.where(F.col("created_at").isNull() | (F.col("created_at") >= readers.utc(since)))
        else:
            batch, oldest_first = readers.incremental(events, self.watermarks.get(source), full_refresh, None, self.lookback_days), "timestamp"
        path = self.path("analytics_events")
        if limit is None:
            return sinks.append_events(self.spark, path, batch, "id", "timestamp", "created_at")
        oldest = self._oldest_new(batch, list(dict.fromkeys([oldest_first, "timestamp", "id"])), limit)
        loaded = sinks.append_events(self.spark, path, oldest, "id", "timestamp", "created_at")
        self._drop_candidates()
        return loaded

    def _oldest_new(self, batch: DataFrame, order: list[str], limit: int) -> DataFrame:
        """The first `limit` rows by `order`, one per id, of those not stored yet.

        The source is read once, into a folder. Where the limit falls is looked
        up by ranges, so no task gets all rows.
        """
        path, folder = self.path("analytics_events"), self.path("analytics_events__candidates")
        self._drop_candidates()
        batch.write.parquet(folder)
        rows = sinks.read_table(self.spark, folder).select(*batch.columns)
        # Rows already stored must not use up the limit, or it would never get past them.
        if sinks.table_exists(self.spark, path):
            known = sinks.KeyIndex(self.spark, path, "id").holding(rows)
            rows = rows.join(known, "id", "left_anti").select(*rows.columns)
        if limit < 1:
            return rows.limit(limit)
        firsts = rows.groupBy("id").agg(F.min(F.struct(*order)).alias("first")).select("first.*")
        last = nth_row(firsts, order, limit, f"{folder}_order")
        kept = rows if last is None else up_to(rows, last)
        return sinks.first_per_key(kept, "id", [*order, *[c for c in rows.columns if c not in order]])

    def _drop_candidates(self) -> None:
        for name in ("analytics_events__candidates", "analytics_events__candidates_order"):
            sinks.drop_table(self.spark, self.path(name))

    def pending(self, months: list[str]) -> DataFrame:
        """Landing rows that the fact does not have yet, kept in a table until the
        run is complete: a run that was cut short leaves its rows here, and the
        next one takes them through all steps again."""
        path = self.path("pending_events")
        landed = sinks.only_months(self.table("analytics_events"), months)
        if sinks.table_exists(self.spark, self.path("fct_events")):
            done = sinks.only_months(self.table("fct_events"), months).select(F.col("event_id").alias("id"))
            landed = landed.join(done, "id", "left_anti").select(*landed.columns)
        rows = landed.drop(sinks.MONTH)
        if sinks.table_exists(self.spark, path):
            left_over = self.table("pending_events")
            rows = rows.join(left_over.select("id"), "id", "left_anti").select(*rows.columns).unionByName(left_over)
        sinks.replace_table(self.spark, rows, path)
        return self.table("pending_events")

    def extract_reference(self, users: DataFrame, disciplines: DataFrame) -> None:
        path = self.path("usuarios")
        if sinks.table_exists(self.spark, path):
            users = sinks.upsert(self.table("usuarios"), users, "id_usuario", ["perfil", "status"])
        sinks.replace_table(self.spark, users, path)
        path = self.path("curriculo_disciplinas")
        if sinks.table_exists(self.spark, path):
            old = self.table("curriculo_disciplinas")
            new = sinks.insert_if_absent(old, disciplines, "id_disciplina", ["codigo_disciplina"])
            disciplines = old.unionByName(new)
        sinks.replace_table(self.spark, disciplines, path)

    def snapshot(self, as_of: str) -> None:
        users = staging.stg_users(self.table("usuarios"))
        path = self.path("dim_users_snapshot")
        if sinks.table_exists(self.spark, path):
            versions = history.merge_snapshot(self.table("dim_users_snapshot"), users, as_of)
        else:
            versions = history.first_snapshot(users)
        sinks.replace_table(self.spark, versions, path)

    def write_dimensions(self, new_rows: DataFrame) -> None:
        """User and reference dimensions from their tables; what comes from events
        grows by what the new rows add, so history is not read again."""
        events = staging.stg_events(new_rows)
        spans, screens, aliases = events.select("event_ts"), events.select("screen_name", "category"), dims.professor_aliases(events)
        if sinks.table_exists(self.spark, self.path("dim_date")):
            known = self.table("dim_date").select(F.col("full_date").cast("timestamp_ntz").alias("event_ts"))
            spans = spans.unionByName(known)
            screens = screens.unionByName(self.table("dim_screens").select("screen_name", F.col("feature_key").alias("category")))
            aliases = aliases.unionByName(self.table("professor_aliases")).distinct()
        calendar = dims.dim_date_for(spans)
        tables = {
            "dim_users": dims.dim_users(self.table("dim_users_snapshot")),
            "dim_courses": dims.dim_courses(staging.stg_disciplines(self.table("curriculo_disciplinas"))),
            "dim_universities": dims.dim_universities(staging.stg_users(self.table("usuarios"))),
            "dim_screens": dims.dim_screens(screens),
            "dim_date": calendar,
            "dim_academic_periods": dims.dim_academic_periods(calendar),
            "professor_aliases": aliases,
        }
        together([lambda n=n, d=d: sinks.replace_table(self.spark, d, self.path(n)) for n, d in tables.items()])
        professors = dims.professors_of(self.table("professor_aliases"))
        sinks.replace_table(self.spark, professors, self.path("dim_professors"))

    def write_events_fact(self, new_rows: DataFrame) -> None:
        """Only the rows of this run; they replace facts with the same event id."""
        fact = facts.fct_events(staging.stg_events(new_rows), self.star.dim_users)
        sinks.delete_insert_table(self.spark, self.path("fct_events"), fact, "event_id", "event_ts", keys_may_move=False)

    def write_rollups(self, new_rows: DataFrame) -> list[str]:
        """Rebuild what the new rows touch: days and ratings by month, sessions by
        id. Returns the touched months."""
        months = sinks.months_of(new_rows)
        touched = sinks.only_months(self.table("fct_events"), months)
        users = self.star.dim_users

        def months_from(df: DataFrame, table: str, sort_by: list[str]) -> None:
            stamped = df.withColumn("_day", key_to_date("date_sk").cast("timestamp_ntz"))
            sinks.write_months(stamped, self.path(table), "_day", sort_by, mode="overwrite")

        together(
            [
                lambda: months_from(
                    facts.fct_daily_user_activity(touched, users), "fct_daily_user_activity", ["date_sk", "user_sk"]
                ),
                lambda: months_from(facts.fct_ratings(touched), "fct_ratings", ["date_sk", "course_sk"]),
                lambda: self._write_sessions(new_rows),
            ]
        )
        return months

    def _write_sessions(self, new_rows: DataFrame) -> None:
        """Rebuild the sessions that got new events, from the months they reach into."""
        ids = new_rows.select("session_id").distinct()
        reach = new_rows.select(F.to_date("timestamp").alias("first"), F.to_date("timestamp").alias("last"))
        path = self.path("fct_sessions")
        if sinks.table_exists(self.spark, path):
            stored = self.table("fct_sessions").join(ids, "session_id", "left_semi")
            start = key_to_date("session_start_date_sk")
            days = F.expr("cast(session_duration_seconds div 86400 as int) + 1")
            reach = reach.unionByName(stored.select(start.alias("first"), F.date_add(start, days).alias("last")))
        span = reach.agg(F.date_format(F.min("first"), "yyyy-MM"), F.date_format(F.max("last"), "yyyy-MM")).first()
        events = sinks.between_months(self.table("fct_events"), *span).join(ids, "session_id", "left_semi")
        rows = facts.fct_sessions(events).withColumn("_day", key_to_date("session_start_date_sk").cast("timestamp_ntz"))
        sinks.delete_insert_table(self.spark, path, rows, "session_id", "_day", ["session_start_date_sk", "user_sk"])

    def write_marts(self, months: list[str]) -> None:
        """Marts with one row per event day are rebuilt for the touched months, the
        others as a whole, since cohorts and running totals look back."""
        recent = StoredStar(self.spark, self.root, months=months)

        def by_month(name: str, day: str) -> None:
            rows = MARTS[name](recent)
            stamped = rows.withColumn("_day", F.col(day).cast("timestamp_ntz"))
            sinks.write_months(stamped, self.path(name), "_day", [day], mode="overwrite")

        jobs = [lambda n=n, d=d: by_month(n, d) for n, d in DAILY_MARTS.items()] if months else []
        people = PersonStar(self.star)
        whole = [n for n in MARTS if n not in DAILY_MARTS]
        together(jobs + [lambda n=n: sinks.replace_table(self.spark, MARTS[n](people), self.path(n)) for n in whole])

    def check(self, as_of: str) -> list[tuple[str, int]]:
        results = quality.dq_suite(self.star, as_of)
        sinks.replace_table(self.spark, results, self.path("quality_results"))
        return quality.gate(self.table("quality_results"), WARN_ONLY)

    def run(
        self,
        events: DataFrame,
        users: DataFrame,
        disciplines: DataFrame,
        as_of: str,
        full_refresh: bool = False,
        limit: int | None = None,
    ) -> sinks.Loaded:
        try:
            with self.audited("extract") as counts:
                loaded = self.extract_events(events, full_refresh, limit)
                counts["extracted"], counts["loaded"] = loaded.extracted, loaded.added
            with self.audited("reference"):
                self.extract_reference(users, disciplines)
            with self.audited("transform"):
                self.snapshot(as_of)
                new = self.pending(loaded.months)
                self.write_dimensions(new)
                months = []
                if new.limit(1).count():
                    self.write_events_fact(new)
                    months = self.write_rollups(sinks.with_month(new, "timestamp"))
            self.write_log()
            with self.audited("marts"):
                self.write_marts(months)
            with self.audited("quality"):
                self.check(as_of)
        finally:
            self.write_log()
        sinks.drop_table(self.spark, self.path("pending_events"))
        for source, newest in ((f"events_{self.lane}", loaded.newest), (f"arrivals_{self.lane}", loaded.newest_arrival)):
            if newest is not None:
                self.watermarks.update(source, newest.isoformat() + "+00:00")
        return loaded


def materialise(star: Star, root: str) -> StoredStar:
    """Write a star's tables once, for jobs that read them many times: staging
    first, then what is made from it, then the rollups of the event fact."""
    spark = star.spark
    root = root.rstrip("/")

    def write(tables: dict[str, DataFrame]) -> None:
        together([lambda n=n, d=d: d.write.parquet(f"{root}/{n}") for n, d in tables.items()], 6)

    write(
        {
            "stg_events": star.stg_events,
            "stg_users": star.stg_users,
            "dim_users": star.dim_users,
            "dim_courses": star.dim_courses,
            "dim_universities": star.dim_universities,
            "pipeline_runs": star.pipeline_runs,
        }
    )
    events, users = spark.read.parquet(f"{root}/stg_events"), spark.read.parquet(f"{root}/dim_users")
    calendar = dims.dim_date_for(events)
    write(
        {
            "fct_events": facts.fct_events(events, users),
            "dim_date": calendar,
            "dim_academic_periods": dims.dim_academic_periods(calendar),
            "dim_screens": dims.dim_screens(events),
            "dim_professors": dims.dim_professors(events),
        }
    )
    fact = spark.read.parquet(f"{root}/fct_events")
    write(
        {
            "fct_daily_user_activity": facts.fct_daily_user_activity(fact, users),
            "fct_ratings": facts.fct_ratings(fact),
            "fct_sessions": facts.fct_sessions(fact),
        }
    )
    return StoredStar(spark, root, fixed=True)
