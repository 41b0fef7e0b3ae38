"""Every query by name, over the sample tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenmart.functions import month_key, ratio, surrogate_key_of
from lumenmart.operators import dimensions, history, sinks
from lumenmart.operators.bitmaps import extend_blocks
from lumenmart.operators.facts import hits
from lumenmart.operators.ranking import exact_percentiles, trailing_actives
from lumenmart.operators.slots import inactivity_sessions
from lumenmart.operators.staging import stg_users
from lumenmart.plans import marts, metrics, quality, summaries, workloads
from lumenmart.plans.loader import MARTS, Warehouse, materialise
from lumenmart.plans.star import TABLES, Star
from lumenmart.plans.views import publish_views
from lumenmart.session import configure, shared_dir
from lumenmart.sources import readers
from lumenmart.streaming import jobs
from lumenmart.streaming.sessions import SessionStream

# Parameters of the registered queries (the oracle uses the same ones).
AS_OF = "2024-02-01 00:00:00"
WATERMARK = "2024-01-15T12:00:00+00:00"
LOOKUP_DAY, LOOKUP_USER = 20240115, 42
LOOKUP_REGISTERED = "2023-12-27 00:00:00.000000"
LATE_SECONDS = 86400
SALT = "campus"
ARRIVALS, CLOSING_DELAY = ("2024-01-08", "2024-01-16", "2024-01-24"), 86400


def mart(s: Star, name: str) -> DataFrame:
    return MARTS[name](s)


def _facts_by_day(s: Star) -> dict[str, tuple[DataFrame, str]]:
    return {
        "fct_events": (s.event_rows, "event_date_sk"),
        "fct_daily_user_activity": (s.fct_daily_user_activity, "date_sk"),
        "fct_ratings": (s.fct_ratings, "date_sk"),
        "fct_sessions": (s.fct_sessions, "session_start_date_sk"),
    }


# --- history ---------------------------------------------------------------------


def user_history(s: Star) -> DataFrame:
    return history.history_from_changes(s.sample.user_changes(), "user_id", "changed_at", "seq", ["role", "status"])


def latest_profiles(s: Star) -> DataFrame:
    """Users as the next extract reports them: role and status of their last change."""
    last = s.sample.user_changes().groupBy("user_id").agg(
        F.max_by(F.struct("role", "status"), F.struct("changed_at", "seq")).alias("p")
    )
    users = s.raw_users.join(last.withColumnRenamed("user_id", "id_usuario"), "id_usuario", "left")
    return users.select(
        "id_usuario",
        "id_universidade",
        "id_curso",
        F.coalesce("p.role", "perfil").alias("perfil"),
        "data_cadastro",
        F.coalesce("p.status", "status").alias("status"),
    )


def scd2_merge(s: Star) -> DataFrame:
    merged = history.merge_snapshot(history.first_snapshot(s.stg_users), stg_users(latest_profiles(s)), AS_OF)
    return dimensions.dim_users(merged)


def scd2_asof(s: Star) -> DataFrame:
    events = s.stg_events.select("raw_event_id", "user_id", "event_ts")
    found = history.version_at(events, user_history(s), "user_id", "event_ts", ["scd_id", "role", "status"])
    return found.select("raw_event_id", "user_id", "event_ts", "scd_id", "role", "status")


# --- loads -------------------------------------------------------------------------


def loaded_before(s: Star) -> DataFrame:
    """Landing table as of noon of the watermark day, by arrival."""
    return s.raw_events.where(F.col("created_at") < F.lit(WATERMARK[:19]).cast("timestamp_ntz"))


def next_batch(s: Star) -> DataFrame:
    """Deliveries from one day before the watermark on: overlapping, with retries."""
    return s.sample.deliveries().where(F.col("created_at") >= F.lit("2024-01-14").cast("timestamp_ntz"))


def incremental_append(s: Star) -> DataFrame:
    old = loaded_before(s)
    new = sinks.insert_if_absent(old, next_batch(s), "id", ["timestamp", "created_at"])
    return old.unionByName(new).select("id", "event_name", "user_id", "timestamp", "created_at")


def corrections(s: Star) -> DataFrame:
    """Events that arrived late, sent again with their arrival as event time."""
    late = F.timestamp_diff("SECOND", "event_ts", "created_at") > LATE_SECONDS
    slim = s.stg_events.where(late)
    return slim.select(F.col("raw_event_id").alias("event_id"), F.col("created_at").alias("event_ts"), "event_name")


def event_times(s: Star) -> DataFrame:
    return s.stg_events.select(F.col("raw_event_id").alias("event_id"), "event_ts", "event_name")


def stored_append(s: Star) -> DataFrame:
    path = f"{shared_dir(s.spark, 'append')}/analytics_events"
    sinks.append_events(s.spark, path, loaded_before(s), "id", "timestamp")
    sinks.append_events(s.spark, path, next_batch(s), "id", "timestamp")
    months = sinks.read_table(s.spark, path).groupBy("event_month", F.to_date("timestamp").alias("event_date"))
    return months.agg(F.count("*").alias("events"), F.countDistinct("id").alias("ids"))


def stored_delete_insert(s: Star) -> DataFrame:
    path = f"{shared_dir(s.spark, 'delete-insert')}/fct_events"
    sinks.write_months(event_times(s), path, "event_ts", ["event_id"])
    sinks.delete_insert_table(s.spark, path, corrections(s), "event_id", "event_ts")
    return sinks.read_table(s.spark, path).select("event_id", "event_ts", "event_name", "event_month")


def users_upsert(s: Star) -> DataFrame:
    """Users registered early are already loaded; the next extract brings all."""
    old = s.raw_users.where(F.col("data_cadastro") < F.lit("2024-01-05").cast("date"))
    return sinks.upsert(old, latest_profiles(s), "id_usuario", ["perfil", "status"])


def disciplines_insert(s: Star) -> DataFrame:
    """Disciplines of four credits are loaded; the extract renames everything."""
    old = s.raw_disciplines.where(F.col("creditos") == 4)
    batch = s.raw_disciplines.withColumn("nome_disciplina", F.upper("nome_disciplina"))
    return old.unionByName(sinks.insert_if_absent(old, batch, "id_disciplina", ["codigo_disciplina"]))


# --- operators on other entities -------------------------------------------------------


def _orders(s: Star) -> DataFrame:
    return s.sample.table("orders").withColumn("at", F.col("o_orderdate").cast("timestamp_ntz"))


def orders_trailing_customers(s: Star) -> DataFrame:
    days = _orders(s).select("o_custkey", F.to_date("at").alias("order_day")).distinct()
    return trailing_actives(days, "o_custkey", "order_day", {"customers_7d": 7, "customers_30d": 30}).withColumnRenamed(
        "active", "customers_1d"
    )


def orders_history(s: Star) -> DataFrame:
    versions = history.history_from_changes(
        _orders(s), "o_custkey", "at", "o_orderkey", ["o_orderpriority", "o_orderstatus"], slot_seconds=365 * 86400
    )
    return versions.drop("scd_id")


def orders_idle_periods(s: Star) -> DataFrame:
    """Buying periods of customers: an order within 90 days continues the period."""
    return inactivity_sessions(
        _orders(s), "o_custkey", "at", 90 * 86400, {"cents": F.round(F.col("o_totalprice") * 100).cast("bigint")}
    )


def orders_price_percentiles(s: Star) -> DataFrame:
    return exact_percentiles(
        s.sample.table("orders"), ["o_orderpriority"], "o_totalprice", {"p50": 0.5, "p90": 0.9, "p99": 0.99}, 1000
    )


def orders_first_purchase_retention(s: Star) -> DataFrame:
    """Customers by quarter of their first order, and how many order again within a year."""
    days = _orders(s).groupBy("o_custkey", F.to_date("at").alias("d")).agg(F.count("*").alias("n"))
    firsts = days.groupBy("o_custkey").agg(F.min("d").alias("first_day"))
    back = (F.col("d") > F.col("first_day")) & (F.col("d") <= F.date_add("first_day", 365))
    per_customer = days.join(firsts, "o_custkey").groupBy("o_custkey", "first_day").agg(hits(back).alias("again"))
    cohorts = per_customer.groupBy(F.to_date(F.date_trunc("quarter", "first_day")).alias("cohort_quarter")).agg(
        F.count("*").alias("customers"), hits(F.col("again") > 0).alias("returned")
    )
    return cohorts.withColumn("return_rate", ratio("returned", "customers"))


# --- streams -----------------------------------------------------------------------------


def _event_stream(s: Star) -> DataFrame:
    src = s.sample
    schema = src.table("events").schema
    return src.analytics_events(jobs.read_stream(s.spark, f"{src.sf_dir}/events.parquet", schema))


def json_source(s: Star) -> DataFrame:
    """Event files as JSON lines, read and brought into the landing form."""
    path = shared_dir(s.spark, "event-files")
    s.sample.event_records().write.json(path)
    return readers.normalise_events(readers.read_event_file(s.spark, path), F.lit(AS_OF).cast("timestamp_ntz"))


def watermark_state(s: Star) -> DataFrame:
    """The stored watermarks after two loads and an attempt to move one back."""
    w = Warehouse(s.spark, shared_dir(s.spark, "marks"))
    for events in (loaded_before(s), s.raw_events):
        loaded = w.extract_events(events)
        w.watermarks.update("events_sample", loaded.newest.isoformat() + "+00:00")
        w.watermarks.update("arrivals_sample", loaded.newest_arrival.isoformat() + "+00:00")
    w.watermarks.update("events_sample", WATERMARK)
    log = w.table("extract_watermarks").groupBy("source").agg(F.max_by("value", "seq").alias("value"))
    return log.select("source", readers.utc("value").alias("value"))


def _twice(s: Star) -> DataFrame:
    """Deliveries as a stream: events that arrived late come a second time."""
    late = F.timestamp_diff("DAY", "timestamp", "created_at") >= 2
    return _event_stream(s).unionByName(_event_stream(s).where(late))


def stream_deduplicated(s: Star) -> DataFrame:
    """Retries of any age are caught by the ids already stored, not by state."""
    root = shared_dir(s.spark, "stream-dedupe")
    kept = _twice(s).select("id", "event_name", "user_id", "timestamp")
    jobs.run_append(kept, f"{root}/events", f"{root}/checkpoint")
    return sinks.read_table(s.spark, f"{root}/events").drop(sinks.MONTH)


def stream_daily_activity(s: Star) -> DataFrame:
    return jobs.daily_activity(jobs.partials(_event_stream(s), "stream-daily", jobs.daily_sessions))


def stream_session_windows(s: Star) -> DataFrame:
    return jobs.sessions_of_slots(jobs.partials(_event_stream(s), "stream-sessions", jobs.slot_sums))


def stream_trailing_actives(s: Star) -> DataFrame:
    """Exact trailing actives from the user-days of the batches."""
    days = jobs.partials(_event_stream(s), "stream-user-days", jobs.user_days).distinct()
    return trailing_actives(days, "user_id", "activity_date", {"wau": 7, "mau": 30}).withColumnRenamed("active", "dau")


def stream_sliding_actives(s: Star) -> DataFrame:
    """Exact users of the last seven days, per day."""
    days = jobs.partials(_event_stream(s), "stream-actives", jobs.user_days).distinct()
    return trailing_actives(days, "user_id", "activity_date", {"active_users": 7}).select("activity_date", "active_users")


def _closing_sessions(s: Star) -> SessionStream:
    """A stream that runs whenever a part of the events has arrived."""
    root = shared_dir(s.spark, "closing-sessions")
    stream = SessionStream(s.spark, f"{root}/out", CLOSING_DELAY)
    events = s.raw_events.select("user_id", "timestamp", "created_at")
    schema = events.drop("created_at").schema
    arrived, at = F.col("created_at"), [F.lit(d).cast("timestamp_ntz") for d in ARRIVALS]
    part = F.when(arrived >= at[-1], len(at))
    for k in reversed(range(len(at))):
        part = F.when(arrived < at[k], k).otherwise(part)
    # the source is read once, not for each part
    parted = events.select(*schema.names, part.alias("part"))
    parted.write.partitionBy("part").parquet(f"{root}/parts")
    stored = s.spark.read.schema(parted.schema).parquet(f"{root}/parts")
    for k in range(len(at) + 1):
        stored.where(F.col("part") == k).drop("part").write.mode("append").parquet(f"{root}/landing")
        stream.run(jobs.read_stream(s.spark, f"{root}/landing", schema))
    return stream


def stream_closed_sessions(s: Star) -> DataFrame:
    """Sessions that a stream has written once the watermark passed them."""
    return _closing_sessions(s).closed()


def stream_late_rows(s: Star) -> DataFrame:
    """Events below the watermark of the parts that arrived before theirs."""
    return _closing_sessions(s).late().groupBy("user_id").agg(F.count("*").alias("late_events"), F.max("event_ts").alias("last_ts"))


def stream_upsert(s: Star) -> DataFrame:
    """Corrected events arrive as a stream and replace the stored ones."""
    root = shared_dir(s.spark, "stream-upsert")
    sinks.write_months(event_times(s), f"{root}/fct_events", "event_ts", ["event_id"])
    late = F.timestamp_diff("SECOND", "timestamp", "created_at") > LATE_SECONDS
    arriving = _event_stream(s).where(late)

    def shape(batch: DataFrame) -> DataFrame:
        return batch.select(F.col("id").alias("event_id"), F.col("created_at").alias("event_ts"), "event_name")

    jobs.run_delete_insert(arriving, f"{root}/fct_events", f"{root}/checkpoint", "event_id", "event_ts", shape)
    return sinks.read_table(s.spark, f"{root}/fct_events").select("event_id", "event_ts", "event_name", "event_month")


def stream_append(s: Star) -> DataFrame:
    root = shared_dir(s.spark, "stream-append")
    jobs.run_append(_twice(s), f"{root}/analytics_events", f"{root}/checkpoint")
    return sinks.read_table(s.spark, f"{root}/analytics_events").select("id", "event_name", "user_id", "timestamp")


def stream_audit(s: Star) -> DataFrame:
    """What the audit rows of a stream's batches add up to."""
    root = shared_dir(s.spark, "stream-audit")
    jobs.run_append(_twice(s), f"{root}/analytics_events", f"{root}/checkpoint", f"{root}/pipeline_runs")
    runs = sinks.read_table(s.spark, f"{root}/pipeline_runs")
    return runs.groupBy("dag_id", "lane", "status").agg(F.sum("rows_extracted").alias("rows_extracted"), F.sum("rows_loaded").alias("rows_loaded"))


def active_blocks(s: Star) -> DataFrame:
    """Active days as stored bits, after two loads that overlap in time."""
    path = shared_dir(s.spark, "active-days")
    days = summaries.active_days(s.fct_daily_user_activity)
    middle = F.lit(WATERMARK[:10]).cast("date")
    for part in (days.where(F.col("activity_date") < middle), days.where(F.col("activity_date") >= F.date_sub(middle, 3))):
        extend_blocks(s.spark, path, part, "user_sk", "activity_date")
    return sinks.read_table(s.spark, path)


def sketched_actives(s: Star) -> DataFrame:
    """Trailing actives, of all and of one platform, and whether estimates from stored sketches keep to their bound."""
    path = shared_dir(s.spark, "activity-sketches")
    events = s.fct_events.select("user_sk", "event_date_sk", "platform")
    summaries.activity_sketches(events, s.dim_users).write.parquet(path)
    stored = sinks.read_table(s.spark, path)
    return summaries.checked_actives(events, stored).unionByName(summaries.checked_actives(events, stored, "mobile_ios"))


def sketched_durations(s: Star) -> DataFrame:
    path = shared_dir(s.spark, "duration-sketches")
    summaries.duration_sketches(s.fct_sessions).write.parquet(path)
    return summaries.checked_durations(s.fct_sessions, sinks.read_table(s.spark, path))


def append_other_month(s: Star) -> DataFrame:
    """An id that comes again with a time of another month is stored once."""
    path = shared_dir(s.spark, "append-months")
    events = s.raw_events.select("id", "event_name", "timestamp")
    sinks.append_events(s.spark, path, events, "id", "timestamp")
    moved = events.withColumn("timestamp", F.expr("timestamp + INTERVAL 60 DAYS"))
    sinks.append_events(s.spark, path, moved, "id", "timestamp")
    return sinks.read_table(s.spark, path).select("id", "event_name", "timestamp")


def limited_loads(s: Star) -> DataFrame:
    """Loads of a limited number of rows, repeated until nothing is left, equal one full load."""
    w = Warehouse(s.spark, shared_dir(s.spark, "limited"))
    size = s.raw_events.count()
    events = s.sample.deliveries()
    while True:
        loaded = w.extract_events(events, limit=size // 3 + 1)
        for source, newest in (("events_sample", loaded.newest), ("arrivals_sample", loaded.newest_arrival)):
            if newest is not None:
                w.watermarks.update(source, newest.isoformat() + "+00:00")
        if not loaded.added:
            return w.table("analytics_events").select("id", "event_name", "timestamp")


def _on_lookup_day(s: Star) -> Star:
    """The star whose facts need hold the month of the lookup only."""
    day = f"{LOOKUP_DAY // 10000}-{LOOKUP_DAY // 100 % 100:02d}-{LOOKUP_DAY % 100:02d}"
    return s.of_months(day, day)


# --- the registry ---------------------------------------------------------------------------


def sql_over_views(s: Star) -> DataFrame:
    """SQL as a dashboard sends it, over published views."""
    publish_views(s, "fct_daily_user_activity", "dim_users", "dim_date")
    return s.spark.sql(
        """
        SELECT d.full_date, d.is_weekend, u.role, COUNT(*) AS users, SUM(a.events_count) AS events
        FROM fct_daily_user_activity a
        JOIN dim_date d ON a.date_sk = d.date_sk
        JOIN dim_users u ON a.user_sk = u.user_sk
        WHERE u.is_current = true
        GROUP BY d.full_date, d.is_weekend, u.role
        ORDER BY d.full_date DESC
        """
    )


def _month_routing(s: Star) -> DataFrame:
    months = s.raw_events.groupBy(month_key("timestamp").alias("event_month"))
    return months.agg(F.count("*").alias("events"), F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"))


QUERIES: dict[str, Callable[[Star], DataFrame]] = {
    # sources and staging
    "stg_events": lambda s: s.stg_events,
    "stg_users": lambda s: s.stg_users,
    "stg_disciplines": lambda s: s.stg_disciplines,
    "incremental_read": lambda s: readers.incremental(s.raw_events, WATERMARK).select("id", "event_name", "timestamp"),
    "incremental_read_limited": lambda s: readers.incremental(s.raw_events, WATERMARK, limit=500).select("id", "timestamp"),
    "full_refresh_read": lambda s: readers.incremental(s.raw_events, WATERMARK, full_refresh=True).select("id", "timestamp"),
    "normalised_events": lambda s: readers.normalise_events(
        s.sample.event_records(), F.lit(AS_OF).cast("timestamp_ntz")
    ),
    "extracted_users": lambda s: readers.users_from_operational(
        s.sample.operational_users(), s.sample.operational_enrolments()
    ),
    "extracted_disciplines": lambda s: readers.disciplines_from_operational(s.sample.operational_disciplines()),
    "pseudonymised_events": lambda s: readers.pseudonymise(s.stg_events.select("raw_event_id", "user_id"), SALT),
    "month_routing": _month_routing,
    # dimensions
    "dim_date": lambda s: s.dim_date,
    "dim_academic_periods": lambda s: s.dim_academic_periods,
    "dim_users": lambda s: s.dim_users,
    "dim_universities": lambda s: s.dim_universities,
    "dim_courses": lambda s: s.dim_courses,
    "dim_screens": lambda s: s.dim_screens,
    "dim_professors": lambda s: s.dim_professors,
    "professor_aliases": lambda s: dimensions.professor_aliases(s.stg_events),
    "dim_professors_fuzzy": lambda s: dimensions.resolve_professors(s.dim_professors),
    # facts
    "fct_events": lambda s: s.fct_events,
    "fct_daily_user_activity": lambda s: s.fct_daily_user_activity,
    "fct_ratings": lambda s: s.fct_ratings,
    "fct_sessions": lambda s: s.fct_sessions,
    "sessionize_30min": lambda s: inactivity_sessions(
        s.stg_events, "user_id", "event_ts", 1800, {"errors_count": (F.col("category") == "Errors").cast("int")}
    ),
    # history
    "scd2_history": user_history,
    "scd2_current": lambda s: history.current_versions(user_history(s)).select("user_id", "role", "status", "valid_from"),
    "scd2_asof": scd2_asof,
    "scd2_merge": scd2_merge,
    # marts
    **MARTS,
    "mrt_monetization_fixed_institution": lambda s: marts.mrt_monetization_readiness(
        s.fct_sessions, s.event_rows, s.fct_daily_user_activity, surrogate_key_of("1")
    ),
    # dashboard cards and filters
    **{name: (lambda s, name=name: workloads.card(mart(s, workloads.CARDS[name][0]), name)) for name in workloads.CARDS},
    "mrt_quality_mobile": lambda s: mart(s.filtered(platform="mobile"), "mrt_quality"),
    "mrt_engagement_period": lambda s: mart(
        s.filtered(date_from="2024-01-08", date_to="2024-01-21", app_version="1.1.0"), "mrt_engagement"
    ),
    "mrt_content_university": lambda s: mart(s.filtered(university_id=1), "mrt_content"),
    "mrt_content_course_term": lambda s: mart(s.filtered(course_id=7, period="2024.1"), "mrt_content"),
    "mrt_data_engineering_success": lambda s: mart(s.filtered(run_status="SUCCESS"), "mrt_data_engineering"),
    # standalone queries
    "north_star_weekly": lambda s: metrics.north_star_weekly(s.fct_daily_user_activity),
    "retention_first_activity": lambda s: metrics.retention_first_activity(s.fct_daily_user_activity),
    "workload_a": lambda s: workloads.activity_lookup(
        _on_lookup_day(s).fct_daily_user_activity,
        LOOKUP_DAY,
        surrogate_key_of(_lookup_version()),
    ),
    "workload_b": lambda s: workloads.course_scores(_on_lookup_day(s).fct_ratings, s.dim_courses, LOOKUP_DAY),
    "workload_b_all_days": lambda s: workloads.course_scores(s.fct_ratings, s.dim_courses),
    "workload_c": lambda s: workloads.user_durations(_on_lookup_day(s).fct_sessions, s.dim_users, LOOKUP_DAY),
    "workload_c_all_days": lambda s: workloads.user_durations(s.fct_sessions, s.dim_users),
    "month_scan": lambda s: workloads.month_scan(s.of_months("2024-01-01", "2024-01-31").event_rows, "2024-01-01", "2024-02-01"),
    "stickiness_scalar": lambda s: metrics.stickiness_scalar(s.fct_daily_user_activity),
    "latest_run": lambda s: workloads.latest_run(s.pipeline_runs),
    "sql_over_views": sql_over_views,
    # catalogue metrics
    "user_growth": lambda s: metrics.user_growth(s.dim_users),
    "registration_rate": lambda s: metrics.registration_rate(s.event_rows),
    "university_growth": lambda s: metrics.university_growth(s.fct_daily_user_activity),
    "course_growth": lambda s: metrics.course_growth(s.fct_events),
    "activation_by_definition": lambda s: metrics.activation_by_definition(s.fct_events, s.dim_users),
    "time_to_activation": lambda s: metrics.time_to_activation(s.fct_events, s.dim_users),
    "first_action_share": lambda s: metrics.first_action_share(s.fct_events, s.dim_users),
    "first_session_completion": lambda s: metrics.first_session_completion(s.fct_events, s.dim_users),
    "retention_rates": lambda s: marts.mrt_retention(s.fct_daily_user_activity, s.dim_users, all_rates=True),
    "cohort_week_matrix": lambda s: metrics.cohort_week_matrix(s.fct_daily_user_activity, s.dim_users),
    "cohort_week_pivot": lambda s: metrics.cohort_week_pivot(s.fct_daily_user_activity, s.dim_users),
    "rolling_retention": lambda s: metrics.rolling_retention(s.fct_daily_user_activity, s.dim_users),
    "wau_mau": lambda s: metrics.wau_mau(s.fct_daily_user_activity),
    "session_percentiles": lambda s: metrics.session_percentiles(s.fct_sessions),
    "feature_adoption": lambda s: metrics.feature_adoption(s.fct_events, s.event_rows),
    "bounce_by_definition": lambda s: metrics.bounce_by_definition(s.event_rows),
    "power_users": lambda s: metrics.power_users(s.fct_sessions),
    "user_deciles": lambda s: metrics.user_deciles(s.fct_sessions),
    "dormant_users": lambda s: metrics.dormant_users(s.fct_daily_user_activity),
    "empty_search_by_definition": lambda s: metrics.empty_search_by_definition(s.event_rows),
    "funnel_conversion": lambda s: metrics.funnel_conversion(s.fct_events),
    "flow_abandonment": lambda s: metrics.flow_abandonment(s.event_rows),
    "feature_ranking": lambda s: metrics.feature_ranking(s.fct_events),
    "navigation_flow": lambda s: metrics.navigation_flow(s.event_rows, s.dim_screens),
    "frontend_error_sessions": lambda s: metrics.frontend_error_sessions(s.event_rows),
    "failure_shares": lambda s: metrics.failure_shares(s.event_rows),
    "latency_percentiles": lambda s: metrics.latency_percentiles(s.event_rows),
    "etl_duration_by_stage": lambda s: metrics.etl_duration_by_stage(s.pipeline_runs),
    "event_volume": lambda s: metrics.event_volume(s.event_rows),
    "data_freshness": lambda s: metrics.data_freshness(s.event_rows, AS_OF),
    "duplicate_events": lambda s: metrics.duplicate_events(s.sample.deliveries()),
    "late_events": lambda s: metrics.late_events(s.stg_events, LATE_SECONDS),
    "warehouse_growth": lambda s: metrics.warehouse_growth(_facts_by_day(s)),
    "high_value_usage": lambda s: metrics.high_value_usage(s.fct_events, s.event_rows),
    "institution_topn": lambda s: metrics.institution_topn(s.fct_daily_user_activity),
    "engagement_corr": lambda s: metrics.engagement_corr(s.fct_events),
    "admin_actions": lambda s: metrics.admin_actions(s.event_rows),
    "reengagement_rate": lambda s: metrics.reengagement_rate(s.event_rows),
    # quality
    "dq_suite": lambda s: quality.dq_suite(materialise(s, shared_dir(s.spark, "dq")), AS_OF),
    "dq_future_events": lambda s: quality.future_events(s.event_rows, "2024-01-20 00:00:00"),
    "dq_repeated_ids": lambda s: quality.repeated_keys(s.sample.deliveries(), "id"),
    "dq_orphan_customers": lambda s: quality.orphan_keys(
        s.sample.table("orders"), "o_custkey", s.sample.table("events"), "user_id"
    ),
    "dq_metric_bounds": lambda s: quality.metric_bounds(mart(s, "mrt_engagement"), mart(s, "mrt_content")),
    "quarantined_events": lambda s: quality.split_quarantine(quality.check_contract(s.raw_events))[1].select("id", "event_name"),
    "json_source": json_source,
    "watermark_state": watermark_state,
    "event_contract": lambda s: quality.contract_summary(quality.check_contract(s.raw_events)),
    "schema_drift": lambda s: quality.schema_drift(s.raw_events.withColumn("extra", F.lit(1)).drop("created_at")),
    "payload_types": lambda s: quality.unknown_payload_types(s.raw_events),
    "health_probe": lambda s: quality.health_probe(s, TABLES),
    "threshold_breaches": lambda s: quality.breaches(mart(s, "mrt_quality"), s.pipeline_runs, s.event_rows, AS_OF),
    # loads
    "incremental_append": incremental_append,
    "upsert_users": users_upsert,
    "insert_disciplines": disciplines_insert,
    "delete_insert": lambda s: sinks.delete_insert(event_times(s), corrections(s), "event_id"),
    "stored_append": stored_append,
    "stored_delete_insert": stored_delete_insert,
    "mart_export": lambda s: sinks.export_rows(
        mart(s, "mrt_quality").select("error_date", "api_errors", "total_events"), "error_date"
    ),
    # streams
    "stream_deduplicated": stream_deduplicated,
    "stream_append": stream_append,
    "stream_daily_activity": stream_daily_activity,
    "stream_session_windows": stream_session_windows,
    "stream_trailing_actives": stream_trailing_actives,
    "stream_sliding_actives": stream_sliding_actives,
    "stream_upsert": stream_upsert,
    "stream_audit": stream_audit,
    "stream_closed_sessions": stream_closed_sessions,
    "stream_late_rows": stream_late_rows,
    "append_other_month": append_other_month,
    # metrics from stored summaries
    "bitmap_retention_rates": lambda s: summaries.retention_rates(active_blocks(s), s.dim_users),
    "bitmap_rolling_retention": lambda s: summaries.rolling_retention(active_blocks(s), s.dim_users),
    "bitmap_dormant_users": lambda s: summaries.dormant_users(active_blocks(s)),
    "bitmap_cohort_week_matrix": lambda s: summaries.cohort_week_matrix(active_blocks(s), s.dim_users),
    "sketched_actives": sketched_actives,
    "sketched_durations": sketched_durations,
    "limited_loads": limited_loads,
    # the generic operators on other entities
    "orders_trailing_customers": orders_trailing_customers,
    "orders_history": orders_history,
    "orders_idle_periods": orders_idle_periods,
    "orders_price_percentiles": orders_price_percentiles,
    "orders_first_purchase_retention": orders_first_purchase_retention,
}


def _lookup_version() -> str:
    return hashlib.md5(f"{LOOKUP_USER}|{LOOKUP_REGISTERED}".encode()).hexdigest()


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Callable[[Star], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: build(Star.of_sample(configure(spark), sf_dir))

    return {name: bind(build) for name, build in QUERIES.items()}
