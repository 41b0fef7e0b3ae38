"""The star schema as lazily built DataFrames."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenmart.functions import surrogate_key
from lumenmart.operators import dimensions as dims
from lumenmart.operators import facts, history, staging
from lumenmart.operators.sinks import MONTH, between_months, only_months, table_exists
from lumenmart.sources.sample import SampleSource

TABLES = (
    "dim_users",
    "dim_courses",
    "dim_professors",
    "dim_universities",
    "dim_academic_periods",
    "dim_date",
    "dim_screens",
    "fct_events",
    "fct_daily_user_activity",
    "fct_ratings",
    "fct_sessions",
)

# Staging view -> landing table it projects.
STAGED = {"stg_events": "analytics_events", "stg_users": "usuarios", "stg_disciplines": "curriculo_disciplinas"}


class Star:
    """Staging, dimensions and facts over three landing tables and the run log.

    `landing` names the readers of analytics_events, usuarios,
    curriculo_disciplinas and pipeline_runs; only what a query uses is opened.
    """

    def __init__(self, spark: SparkSession, landing: dict[str, Callable[[], DataFrame]]):
        self.spark = spark
        self._landing = landing

    @staticmethod
    def of_sample(spark: SparkSession, sf_dir: str) -> Star:
        src = SampleSource(spark, sf_dir)
        names = ("analytics_events", "usuarios", "curriculo_disciplinas", "pipeline_runs")
        star = Star(spark, {name: getattr(src, name) for name in names})
        star.sample = src
        return star

    @cached_property
    def raw_events(self) -> DataFrame:
        return self._landing["analytics_events"]()

    @cached_property
    def raw_users(self) -> DataFrame:
        return self._landing["usuarios"]()

    @cached_property
    def raw_disciplines(self) -> DataFrame:
        return self._landing["curriculo_disciplinas"]()

    def filtered(self, **filters: object) -> Star:
        """Dashboard filters, applied to the facts before any aggregation; filters of several calls all hold."""
        return FilteredStar(self, **filters)

    def of_months(self, first: str, last: str) -> Star:
        """The same star, whose facts need not hold other months than those of the two days (yyyy-mm-dd)."""
        return self

    # staging
    @cached_property
    def stg_events(self) -> DataFrame:
        return staging.stg_events(self.raw_events)

    @cached_property
    def stg_users(self) -> DataFrame:
        return staging.stg_users(self.raw_users)

    @cached_property
    def stg_disciplines(self) -> DataFrame:
        return staging.stg_disciplines(self.raw_disciplines)

    @cached_property
    def pipeline_runs(self) -> DataFrame:
        return self._landing["pipeline_runs"]()

    # dimensions
    @cached_property
    def dim_users(self) -> DataFrame:
        return dims.dim_users(history.first_snapshot(self.stg_users))

    @cached_property
    def dim_courses(self) -> DataFrame:
        return dims.dim_courses(self.stg_disciplines)

    @cached_property
    def dim_universities(self) -> DataFrame:
        return dims.dim_universities(self.stg_users)

    @cached_property
    def dim_screens(self) -> DataFrame:
        return dims.dim_screens(self.stg_events)

    @cached_property
    def dim_professors(self) -> DataFrame:
        return dims.dim_professors(self.stg_events)

    @cached_property
    def dim_date(self) -> DataFrame:
        return dims.dim_date_for(self.stg_events)

    @cached_property
    def dim_academic_periods(self) -> DataFrame:
        return dims.dim_academic_periods(self.dim_date)

    # facts
    @cached_property
    def fct_events(self) -> DataFrame:
        return facts.fct_events(self.stg_events, self.dim_users)

    @cached_property
    def event_rows(self) -> DataFrame:
        """`fct_events` for queries that need no user columns."""
        return facts.event_rows(self.stg_events)

    @cached_property
    def fct_daily_user_activity(self) -> DataFrame:
        return facts.fct_daily_user_activity(self.fct_events, self.dim_users)

    @cached_property
    def fct_ratings(self) -> DataFrame:
        return facts.fct_ratings(self.fct_events)

    @cached_property
    def fct_sessions(self) -> DataFrame:
        return facts.fct_sessions(self.fct_events)


class FilteredStar(Star):
    """A star whose facts hold what the filters leave, with rollups made from these facts.

    Dates are inclusive days. Works on a lazy star, a stored one and a filtered one.
    """

    def __init__(
        self,
        star: Star,
        date_from: str | None = None,
        date_to: str | None = None,
        platform: str | None = None,
        app_version: str | None = None,
        university_id: int | None = None,
        course_id: int | None = None,
        period: str | None = None,
        run_status: str | None = None,
    ):
        super().__init__(star.spark, {})
        if date_from and date_to:
            star = star.of_months(date_from, date_to)
        self._star, self._university_id, self._run_status = star, university_id, run_status
        # The user's columns are in the full fact only.
        self._filters_users = university_id is not None or course_id is not None or period is not None
        keep = F.lit(True)
        if date_from:
            keep = keep & (F.col("event_ts") >= F.lit(date_from).cast("timestamp_ntz"))
        if date_to:
            keep = keep & (F.col("event_ts") < F.date_add(F.lit(date_to).cast("date"), 1).cast("timestamp_ntz"))
        if platform:
            exact = F.col("platform") == platform
            keep = keep & (F.col("platform").startswith("mobile") if platform == "mobile" else exact)
        if app_version:
            keep = keep & (F.col("app_version") == app_version)
        if course_id is not None:
            keep = keep & (F.col("course_sk") == surrogate_key(F.lit(course_id)))
        if period:
            keep = keep & (F.col("period_sk") == surrogate_key(F.lit(period)))
        self._keep = keep

    @cached_property
    def stg_events(self) -> DataFrame:
        return self._star.stg_events

    @cached_property
    def stg_users(self) -> DataFrame:
        users = self._star.stg_users
        return users if self._university_id is None else users.where(F.col("university_id") == self._university_id)

    @cached_property
    def stg_disciplines(self) -> DataFrame:
        return self._star.stg_disciplines

    @cached_property
    def dim_users(self) -> DataFrame:
        users = self._star.dim_users
        return users if self._university_id is None else users.where(F.col("university_sk") == surrogate_key(F.lit(self._university_id)))

    @cached_property
    def pipeline_runs(self) -> DataFrame:
        runs = self._star.pipeline_runs
        return runs if self._run_status is None else runs.where(F.col("status") == self._run_status)

    @cached_property
    def fct_events(self) -> DataFrame:
        fact = self._star.fct_events.where(self._keep)
        # With a user filter the other users' events have no user row left.
        return fact if self._university_id is None else fact.join(self.dim_users.select("user_sk"), "user_sk", "leftsemi")

    @cached_property
    def event_rows(self) -> DataFrame:
        return self.fct_events if self._filters_users else self._star.event_rows.where(self._keep)


class StoredStar(Star):
    """The same tables, read from where the loader wrote them."""

    def __init__(self, spark: SparkSession, root: str, fixed: bool = False, months: list[str] | None = None):
        super().__init__(spark, {})
        self._root = root.rstrip("/")
        # Facts of these months only: a list, or the first and the last.
        self._months = months
        self._span: tuple[str, str] | None = None
        # Tables that never change again are opened once.
        self._opened: dict[str, DataFrame] | None = {} if fixed else None

    def of_months(self, first: str, last: str) -> StoredStar:
        out = StoredStar(self.spark, self._root, months=self._months)
        out._span = (first[:7], last[:7])
        return out

    def __getattribute__(self, name: str):
        if name == "event_rows":
            name = "fct_events"
        if name in TABLES or name in ("pipeline_runs", *STAGED):
            if self._opened is None:
                return self._stored(name)
            if name not in self._opened:
                self._opened[name] = self._stored(name)
            return self._opened[name]
        return super().__getattribute__(name)

    def _stored(self, name: str) -> DataFrame:
        path = f"{self._root}/{name}"
        if name.startswith("stg_") and not table_exists(self.spark, path):
            # A loaded warehouse keeps landing tables; staging is a view on them.
            return getattr(staging, name)(self.spark.read.parquet(f"{self._root}/{STAGED[name]}"))
        table = self.spark.read.parquet(path)
        if self._months is not None and name.startswith("fct_"):
            table = only_months(table, self._months)
        if self._span is not None and name.startswith("fct_") and MONTH in table.columns:
            table = between_months(table, *self._span)
        return table.drop("event_month", "_day")


class PersonStar(Star):
    """Inputs of the marts where users have several versions: all versions of a
    user count as one, under the key of the current version.

    Only closed versions are looked up, so the mapping has one row per past
    change, and facts of unchanged users keep their key.
    """

    def __init__(self, star: Star):
        super().__init__(star.spark, {})
        self._star = star

    def _by_person(self, fact: DataFrame) -> DataFrame:
        versions = self._star.dim_users
        current = versions.where("is_current").select("user_id", F.col("user_sk").alias("_person"))
        closed = versions.where("NOT is_current").select("user_id", "user_sk").join(current, "user_id")
        mapped = fact.join(closed.select("user_sk", "_person"), "user_sk", "left")
        return mapped.withColumn("user_sk", F.coalesce("_person", "user_sk")).drop("_person")

    @cached_property
    def dim_users(self) -> DataFrame:
        return self._star.dim_users.where("is_current")

    @cached_property
    def fct_events(self) -> DataFrame:
        return self._by_person(self._star.fct_events)

    @cached_property
    def event_rows(self) -> DataFrame:
        return self._star.event_rows

    @cached_property
    def fct_daily_user_activity(self) -> DataFrame:
        days = self._by_person(self._star.fct_daily_user_activity).groupBy("date_sk", "user_sk")
        return days.agg(
            F.max("university_sk").alias("university_sk"),
            F.sum("events_count").alias("events_count"),
            F.max("has_completed_core_action").alias("has_completed_core_action"),
        )

    @cached_property
    def fct_ratings(self) -> DataFrame:
        return self._by_person(self._star.fct_ratings)

    @cached_property
    def fct_sessions(self) -> DataFrame:
        return self._by_person(self._star.fct_sessions)

    @cached_property
    def pipeline_runs(self) -> DataFrame:
        return self._star.pipeline_runs
