"""Catalogue metrics that no mart computes, or that a mart computes by a
narrower rule than the metric's definition."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenmart.functions import json_field, json_int, key_to_date, ratio, seconds_between
from lumenmart.operators.facts import flag, hits, is_known
from lumenmart.operators.ranking import exact_ntile, exact_percentiles, trailing_actives
from lumenmart.operators.slots import next_pairs
from lumenmart.plans.marts import growth, retention_flags, sessions_per_user, user_days, users_by_university
from lumenmart.sources.contract import ACTIVATION_EVENTS, HIGH_VALUE_EVENTS, RATING_EVENTS


def event_days(events: DataFrame) -> DataFrame:
    return events.withColumn("event_date", key_to_date("event_date_sk"))


# --- acquisition -----------------------------------------------------------


def user_growth(dim_users: DataFrame) -> DataFrame:
    """Growth of new users and of all users, per registration date."""
    days = dim_users.groupBy(F.col("registration_date").alias("metric_date")).agg(F.count("*").alias("new_users"))
    w = Window.orderBy("metric_date")
    days = days.withColumn("total_users", F.sum("new_users").over(w))
    return days.select(
        "*",
        growth(F.col("new_users"), F.lag("new_users").over(w)).alias("new_users_growth_rate"),
        growth(F.col("total_users"), F.lag("total_users").over(w)).alias("total_users_growth_rate"),
    )


def registration_rate(events: DataFrame) -> DataFrame:
    """Per start day: sessions whose first event is an Auth event (the user is
    not signed in yet) and the share of them that contain a registration."""
    per_session = events.groupBy("session_id").agg(
        F.min_by("category", F.struct("event_ts", "event_id")).alias("first_category"),
        F.min("event_date_sk").alias("day"),
        flag(F.col("event_name") == "user_registered").alias("registered"),
    )
    opened = per_session.where(F.col("first_category") == "Auth")
    days = opened.groupBy(key_to_date("day").alias("metric_date")).agg(
        F.count("*").alias("unauthenticated_sessions"), F.sum("registered").alias("registrations")
    )
    return days.withColumn("registration_rate", ratio("registrations", "unauthenticated_sessions"))


def first_seen_growth(first_days: DataFrame, day: str, out: str) -> DataFrame:
    """Members first seen per week, with the change against the previous such week."""
    weeks = first_days.groupBy(F.to_date(F.date_trunc("week", day)).alias("week_start")).agg(F.count("*").alias(out))
    w = Window.orderBy("week_start")
    return weeks.select(
        "*", F.sum(out).over(w).alias("total"), growth(F.col(out), F.lag(out).over(w)).alias("growth_rate")
    )


def university_growth(daily: DataFrame) -> DataFrame:
    firsts = user_days(daily).where(is_known("university_sk")).groupBy("university_sk").agg(F.min("activity_date").alias("d"))
    return first_seen_growth(firsts, "d", "new_universities")


def course_growth(events: DataFrame) -> DataFrame:
    days = event_days(events).where(F.col("course_sk").isNotNull())
    firsts = days.groupBy("course_sk").agg(F.min("event_date").alias("d"))
    return first_seen_growth(firsts, "d", "new_courses")


# --- activation ------------------------------------------------------------


def first_activation(events: DataFrame, dim_users: DataFrame) -> DataFrame:
    """One row per user version: the first activating event since registration.

    Only the first activating event of each user-day reaches the join. As the
    registration is a date, dropping earlier days drops exactly the earlier events.
    """
    when = F.struct("event_ts", "event_id")
    per_day = (
        event_days(events)
        .where(F.col("event_name").isin(*ACTIVATION_EVENTS) & is_known("user_sk"))
        .groupBy("user_sk", "event_date")
        .agg(F.min(when).alias("first"), F.min_by("event_name", when).alias("name"))
    )
    users = dim_users.select("user_sk", "registration_date")
    since = F.col("event_date") >= F.col("registration_date")
    return (
        users.join(per_day, "user_sk", "left")
        .groupBy("user_sk", "registration_date")
        .agg(
            F.min(F.when(since, F.col("first.event_ts"))).alias("activated_at"),
            F.min_by("name", F.when(since, F.col("first"))).alias("activated_by"),
        )
    )


def activation_by_definition(events: DataFrame, dim_users: DataFrame) -> DataFrame:
    firsts = first_activation(events, dim_users)
    deadline = F.date_add("registration_date", 7).cast("timestamp_ntz")
    days = firsts.groupBy("registration_date").agg(
        F.count("*").alias("new_users"), hits(F.col("activated_at") <= deadline).alias("activated_users")
    )
    return days.withColumn("activation_rate", ratio("activated_users", "new_users"))


def time_to_activation(events: DataFrame, dim_users: DataFrame) -> DataFrame:
    """One row: activated users and the median hours from registration to activation."""
    firsts = first_activation(events, dim_users).where(F.col("activated_at").isNotNull())
    wait = seconds_between(F.col("registration_date").cast("timestamp_ntz"), F.col("activated_at"))
    median = exact_percentiles(firsts.select(wait.alias("s")), [], "s", {"p50": 0.5}, 3600)
    return median.select(F.col("n").alias("activated_users"), F.round(F.col("p50") / 3600, 4).alias("median_hours"))


def first_action_share(events: DataFrame, dim_users: DataFrame) -> DataFrame:
    by = F.col("activated_by")
    row = first_activation(events, dim_users).agg(
        F.count("activated_by").alias("activated_users"),
        hits(by.isin(*RATING_EVENTS)).alias("first_ratings"),
        hits(by == "material_uploaded").alias("first_uploads"),
    )
    return row.select(
        "*",
        ratio("first_ratings", "activated_users").alias("first_rating_share"),
        ratio("first_uploads", "activated_users").alias("first_upload_share"),
    )


def first_session_completion(events: DataFrame, dim_users: DataFrame) -> DataFrame:
    """Share of users whose first session contains a completing action."""
    per_session = (
        events.where(is_known("user_sk"))
        .groupBy("user_sk", "session_id")
        .agg(F.min("event_ts").alias("start"), flag(F.col("event_name").isin(*ACTIVATION_EVENTS)).alias("done"))
    )
    firsts = per_session.groupBy("user_sk").agg(F.min_by("done", F.struct("start", "session_id")).alias("done"))
    users = dim_users.select("user_sk", "registration_date").join(firsts, "user_sk", "left")
    days = users.groupBy("registration_date").agg(
        F.count("*").alias("new_users"), hits(F.col("done") == 1).alias("first_session_completed")
    )
    return days.withColumn("completion_rate", ratio("first_session_completed", "new_users"))


# --- retention -------------------------------------------------------------


def cohort_week_matrix(daily: DataFrame, dim_users: DataFrame) -> DataFrame:
    """Long form: registration week, weeks since registration, active users."""
    users = dim_users.select("user_sk", "registration_date").withColumn(
        "cohort_week", F.to_date(F.date_trunc("week", "registration_date"))
    )
    sizes = users.groupBy("cohort_week").agg(F.count("*").alias("cohort_size"))
    age = F.datediff("activity_date", "registration_date")
    active = (
        user_days(daily)
        .join(users, "user_sk")
        .where(age >= 0)
        .select("cohort_week", "user_sk", F.floor(age / 7).cast("int").alias("week_number"))
        .distinct()
        .groupBy("cohort_week", "week_number")
        .agg(F.count("*").alias("active_users"))
    )
    return active.join(sizes, "cohort_week").select(
        "cohort_week",
        "week_number",
        "cohort_size",
        "active_users",
        ratio("active_users", "cohort_size").alias("retention_rate"),
    )


def cohort_week_pivot(daily: DataFrame, dim_users: DataFrame) -> DataFrame:
    """Wide form of the matrix: one column per week, up to the last one that has activity (one number, read first)."""
    matrix = cohort_week_matrix(daily, dim_users)
    last = matrix.agg(F.max("week_number")).first()[0]
    weeks = range(0 if last is None else last + 1)
    active = [F.coalesce(F.max(F.when(F.col("week_number") == n, F.col("active_users"))), F.lit(0)).alias(f"week_{n}") for n in weeks]
    return matrix.groupBy("cohort_week", "cohort_size").agg(*(active or [F.lit(0).alias("week_0")]))


def rolling_retention(daily: DataFrame, dim_users: DataFrame, offsets: tuple[int, ...] = (1, 7, 14, 30)) -> DataFrame:
    """Users active n or more days after registration."""
    last = user_days(daily).groupBy("user_sk").agg(F.max("activity_date").alias("last_day"))
    users = dim_users.select("user_sk", F.col("registration_date").alias("cohort_date")).join(last, "user_sk", "left")
    days = users.groupBy("cohort_date").agg(
        F.count("*").alias("cohort_size"),
        *[hits(F.col("last_day") >= F.date_add("cohort_date", n)).alias(f"d{n}_rolling_users") for n in offsets],
    )
    return days.select("*", *[ratio(f"d{n}_rolling_users", "cohort_size").alias(f"d{n}_rolling_rate") for n in offsets])


def retention_first_activity(daily: DataFrame) -> DataFrame:
    """Cohorts by first active day instead of registration, in percent."""
    days = user_days(daily)
    firsts = days.groupBy("user_sk").agg(F.min("activity_date").alias("registration_date"))
    cohorts = (
        retention_flags(daily, firsts, (7, 30))
        .groupBy("cohort_date")
        .agg(F.count("*").alias("cohort_size"), F.sum("d7").alias("retained_d7"), F.sum("d30").alias("retained_d30"))
    )
    return cohorts.select(
        "*",
        ratio(F.col("retained_d7") * 100, "cohort_size", 2).alias("d7_retention_pct"),
        ratio(F.col("retained_d30") * 100, "cohort_size", 2).alias("d30_retention_pct"),
    )


# --- engagement ------------------------------------------------------------


def north_star_weekly(daily: DataFrame) -> DataFrame:
    """Per ISO week: active users and those with a core action, in percent."""
    day = F.col("activity_date")
    per_user = (
        user_days(daily)
        .groupBy(F.extract(F.lit("YEAROFWEEK"), day).cast("int").alias("iso_year"), F.weekofyear(day).alias("week"), "user_sk")
        .agg(F.max("has_completed_core_action").alias("core"))
    )
    weeks = per_user.groupBy("iso_year", "week").agg(F.count("*").alias("total_wau"), F.sum("core").cast("bigint").alias("core_action_wau"))
    return weeks.withColumn("core_completion_rate_pct", ratio(F.col("core_action_wau") * 100, "total_wau", 2))


def wau_mau(daily: DataFrame) -> DataFrame:
    actives = trailing_actives(user_days(daily), "user_sk", "activity_date", {"wau": 7, "mau": 30})
    return actives.select("activity_date", "wau", "mau", ratio("wau", "mau").alias("wau_mau"))


def stickiness_scalar(daily: DataFrame) -> DataFrame:
    """One row: users of the latest day over all users ever active."""
    days = user_days(daily)
    latest = days.agg(F.max("activity_date")).scalar()
    per_user = days.groupBy("user_sk").agg(flag(F.col("activity_date") == latest).alias("today"))
    row = per_user.agg(F.sum("today").alias("dau"), F.count("*").alias("active_users"))
    return row.withColumn("stickiness", ratio("dau", "active_users"))


def session_percentiles(sessions: DataFrame) -> DataFrame:
    s = sessions.withColumn("activity_date", key_to_date("session_start_date_sk"))
    out = exact_percentiles(
        s, ["activity_date"], "session_duration_seconds", {"p50_seconds": 0.5, "p90_seconds": 0.9}, 600
    )
    return out.withColumnRenamed("n", "sessions")


def recent_feature_users(events: DataFrame, event_rows: DataFrame, window_days: int) -> DataFrame:
    """Per user and feature of the window that ends on the last day with events:
    whether a paywall candidate was used."""
    last = event_rows.agg(F.max("event_date_sk").alias("last_sk")).select(key_to_date("last_sk")).scalar()
    recent = event_days(events).where(is_known("user_sk") & (F.col("event_date") > F.date_sub(last, window_days)))
    return recent.groupBy("user_sk", F.col("category").alias("feature_key")).agg(
        flag(F.col("event_name").isin(*HIGH_VALUE_EVENTS)).alias("valuable")
    )


def feature_adoption(events: DataFrame, event_rows: DataFrame, window_days: int = 30) -> DataFrame:
    used = recent_feature_users(events, event_rows, window_days)
    mau = used.select("user_sk").distinct().agg(F.count("*")).scalar()
    features = used.groupBy("feature_key").agg(F.count("*").alias("feature_users")).withColumn("mau", mau)
    return features.withColumn("adoption_rate", ratio("feature_users", "mau"))


def high_value_usage(events: DataFrame, event_rows: DataFrame, window_days: int = 30) -> DataFrame:
    """One row: users of a paywall candidate among the window's users."""
    per_user = recent_feature_users(events, event_rows, window_days).groupBy("user_sk").agg(F.max("valuable").alias("valuable"))
    row = per_user.agg(hits(F.col("valuable") > 0).alias("high_value_users"), F.count("*").alias("mau"))
    return row.withColumn("usage_rate", ratio("high_value_users", "mau"))


def bounce_by_definition(events: DataFrame) -> DataFrame:
    """Sessions with exactly one event, per start day."""
    per_session = events.groupBy("session_id").agg(F.min("event_date_sk").alias("day"), F.count("*").alias("n"))
    days = per_session.groupBy(key_to_date("day").alias("activity_date")).agg(
        F.count("*").alias("total_sessions"), hits(F.col("n") == 1).alias("single_event_sessions")
    )
    return days.withColumn("bounce_rate", ratio("single_event_sessions", "total_sessions"))


def power_users(sessions: DataFrame) -> DataFrame:
    """Users in the first of ten tiles by sessions; ties in key order."""
    ranked = exact_ntile(sessions_per_user(sessions), "session_cnt", "user_sk", 10, "decile")
    return ranked.where(F.col("decile") == 1).select("user_sk", "session_cnt", "decile")


def user_deciles(sessions: DataFrame) -> DataFrame:
    """Per decile: users, sessions and share of all sessions."""
    ranked = exact_ntile(sessions_per_user(sessions), "session_cnt", "user_sk", 10, "decile")
    tiles = ranked.groupBy("decile").agg(F.count("*").alias("users"), F.sum("session_cnt").alias("sessions"))
    total = F.sum("sessions").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return tiles.select("*", ratio("sessions", total).alias("session_share"))


def dormant_users(daily: DataFrame, windows: tuple[int, ...] = (7, 30)) -> DataFrame:
    """Users active before, but not within, the trailing window of the last day."""
    last = user_days(daily).groupBy("user_sk").agg(F.max("activity_date").alias("last_day"))
    as_of = last.agg(F.max("last_day")).scalar()
    counted = last.groupBy(as_of.alias("as_of")).agg(
        *[hits(F.col("last_day") <= F.date_sub(as_of, n)).alias(f"w{n}") for n in windows]
    )
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("window_days"), F.col(f"w{n}").alias("dormant_users")) for n in windows]))
    return counted.select("as_of", rows.alias("r")).select("as_of", "r.*")


def engagement_corr(events: DataFrame) -> DataFrame:
    """One row: correlation of sessions and distinct features over users."""
    known = events.where(is_known("user_sk"))
    sessions = known.select("user_sk", "session_id").distinct().groupBy("user_sk").agg(F.count("*").alias("sessions"))
    features = known.select("user_sk", "category").distinct().groupBy("user_sk").agg(F.count("*").alias("features"))
    row = sessions.join(features, "user_sk").agg(
        F.count("*").alias("users"), F.round(F.corr("sessions", "features"), 6).alias("sessions_features_corr")
    )
    return row


# --- content and product ---------------------------------------------------


def empty_search_by_definition(events: DataFrame) -> DataFrame:
    """Searches that returned nothing, from the payload, per day."""
    searches = event_days(events).where(F.col("event_name") == "search_performed")
    days = searches.groupBy(F.col("event_date").alias("metric_date")).agg(
        F.count("*").alias("searches"), hits(json_int("payload_json", "result_count") == 0).alias("empty_searches")
    )
    return days.withColumn("empty_search_rate", ratio("empty_searches", "searches"))


FUNNEL = ("search_performed", "search_result_opened", "material_downloaded")


def funnel_conversion(events: DataFrame, steps: tuple[str, ...] = FUNNEL) -> DataFrame:
    """Users that reach each step in order; a step counts only after the one before.

    Per user and step only the earliest qualifying moment matters, so each step
    is one join of that step's events with one row per user.
    """
    moments = events.where(is_known("user_sk")).select("user_sk", "event_name", F.struct("event_ts", "event_id").alias("at"))
    reached = moments.where(F.col("event_name") == steps[0]).groupBy("user_sk").agg(F.min("at").alias("reached"))
    stages = [reached]
    for step in steps[1:]:
        later = moments.where(F.col("event_name") == step).join(stages[-1], "user_sk").where(F.col("at") > F.col("reached"))
        stages.append(later.groupBy("user_sk").agg(F.min("at").alias("reached")))
    counts = None
    for i, (step, stage) in enumerate(zip(steps, stages), start=1):
        row = stage.agg(F.count("*").alias("users")).select(F.lit(i).alias("step"), F.lit(step).alias("event_name"), "users")
        counts = row if counts is None else counts.unionByName(row)
    w = Window.orderBy("step")
    return counts.select(
        "*",
        ratio("users", F.lag("users").over(w)).alias("step_rate"),
        ratio("users", F.first("users").over(w)).alias("overall_rate"),
    )


FLOWS = {
    "planning": ("planning_session_started", "planning_session_completed"),
    "search": ("search_performed", "search_result_opened"),
    "upload": ("screen_viewed", "material_uploaded"),
}


def flow_abandonment(events: DataFrame, flows: dict[str, tuple[str, str]] = FLOWS) -> DataFrame:
    """Per flow: sessions that started it, and those that never completed it."""
    name = F.col("event_name")
    wanted = sorted({e for pair in flows.values() for e in pair})
    marks = [flag(name == e).alias(e) for e in wanted]
    per_session = events.where(name.isin(*wanted)).groupBy("session_id").agg(*marks)
    sums = per_session.agg(
        *[F.coalesce(F.sum(a), F.lit(0)).alias(f"{f}_started") for f, (a, _) in flows.items()],
        *[F.coalesce(F.sum(F.col(a) * F.col(b)), F.lit(0)).alias(f"{f}_completed") for f, (a, b) in flows.items()],
    )
    rows = [
        F.struct(F.lit(f).alias("flow"), F.col(f"{f}_started").alias("started"), F.col(f"{f}_completed").alias("completed"))
        for f in flows
    ]
    flat = sums.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    flat = flat.withColumn("abandoned", F.col("started") - F.col("completed"))
    return flat.withColumn("abandonment_rate", ratio("abandoned", "started"))


def feature_ranking(events: DataFrame) -> DataFrame:
    """Features (event categories) by users and by events, most and least used."""
    used = events.groupBy(F.col("category").alias("feature_key"), "user_sk").agg(F.count("*").alias("n"))
    features = used.groupBy("feature_key").agg(
        hits(is_known("user_sk")).alias("unique_users"), F.sum("n").alias("total_events")
    )
    return features.select(
        "*",
        F.dense_rank().over(Window.orderBy(F.desc("unique_users"))).alias("rank_by_users"),
        F.dense_rank().over(Window.orderBy(F.desc("total_events"))).alias("rank_by_events"),
        F.dense_rank().over(Window.orderBy("total_events")).alias("rank_least_used"),
    )


def navigation_flow(events: DataFrame, screens: DataFrame) -> DataFrame:
    """Screen-to-screen transitions within sessions, ranked by count."""
    seen = events.where(F.col("screen_sk").isNotNull()).select("session_id", "event_ts", "event_id", "screen_sk")
    pairs = next_pairs(seen, "session_id", ["event_ts", "event_id"], "screen_sk", "event_ts")
    counts = pairs.groupBy("screen_sk", "next_screen_sk").agg(F.count("*").alias("transition_count"))
    names = screens.select("screen_sk", "screen_name")
    named = (
        counts.join(names.withColumnRenamed("screen_name", "prev_screen"), "screen_sk")
        .join(names.select(F.col("screen_sk").alias("next_screen_sk"), F.col("screen_name").alias("next_screen")), "next_screen_sk")
        .select("prev_screen", "next_screen", "transition_count")
    )
    # The window orders the different counts, not the pairs.
    ranks = named.select("transition_count").distinct().withColumn("rank", F.row_number().over(Window.orderBy(F.desc("transition_count"))))
    return named.join(ranks, "transition_count").select("prev_screen", "next_screen", "transition_count", "rank")


# --- quality ---------------------------------------------------------------


def frontend_error_sessions(events: DataFrame) -> DataFrame:
    per_session = events.groupBy("session_id").agg(
        F.min("event_date_sk").alias("day"), flag(F.col("event_name") == "frontend_error_occurred").alias("failed")
    )
    days = per_session.groupBy(key_to_date("day").alias("error_date")).agg(
        F.count("*").alias("total_sessions"), F.sum("failed").cast("bigint").alias("sessions_with_error")
    )
    return days.withColumn("frontend_error_rate", ratio("sessions_with_error", "total_sessions"))


def failure_shares(events: DataFrame) -> DataFrame:
    name = F.col("event_name")
    days = event_days(events).groupBy(F.col("event_date").alias("error_date")).agg(
        hits(name == "upload_failed").alias("failed_uploads"),
        hits(name.isin("upload_failed", "material_uploaded")).alias("total_uploads"),
        hits(name == "login_failed").alias("failed_logins"),
        hits(name.isin("login_failed", "login_succeeded")).alias("total_logins"),
    )
    return days.select(
        "*",
        ratio("failed_uploads", "total_uploads").alias("upload_failure_rate"),
        ratio("failed_logins", "total_logins").alias("login_failure_rate"),
    )


def latency_percentiles(events: DataFrame) -> DataFrame:
    """Measured response times per day, from the payload."""
    timed = event_days(events).select(
        F.col("event_date").alias("error_date"), json_field("payload_json", "latency_ms").try_cast("bigint").alias("ms")
    )
    return exact_percentiles(timed, ["error_date"], "ms", {"p50_ms": 0.5, "p90_ms": 0.9}, 100).withColumnRenamed("n", "requests")


def admin_actions(events: DataFrame) -> DataFrame:
    actions = event_days(events).where(F.col("event_name") == "admin_action_performed")
    kind = F.coalesce(json_field("payload_json", "action_type"), F.lit("unknown"))
    return actions.groupBy(F.col("event_date").alias("action_date"), kind.alias("action_type")).agg(F.count("*").alias("actions"))


def reengagement_rate(events: DataFrame) -> DataFrame:
    name = F.col("event_name")
    days = event_days(events).groupBy(F.col("event_date").alias("metric_date")).agg(
        hits(name == "notification_sent").alias("sent"), hits(name == "notification_opened").alias("opened")
    )
    return days.withColumn("reengagement_rate", ratio("opened", "sent"))


# --- data engineering ------------------------------------------------------


def etl_duration_by_stage(runs: DataFrame) -> DataFrame:
    stages = runs.groupBy("stage").agg(
        F.count("*").alias("runs"),
        F.sum(F.col("duration_seconds") * 100).cast("bigint").alias("centis"),
        F.max("duration_seconds").cast("double").alias("max_duration_seconds"),
    )
    avg = ratio("centis", F.col("runs") * 100, 2).alias("avg_duration_seconds")
    return stages.select("stage", "runs", avg, "max_duration_seconds")


def event_volume(events: DataFrame) -> DataFrame:
    return events.groupBy(key_to_date("event_date_sk").alias("event_date")).agg(F.count("*").alias("event_count"))


def data_freshness(events: DataFrame, as_of: str, limit_hours: int = 24) -> DataFrame:
    row = events.agg(F.max("event_ts").alias("latest_event_ts"))
    age = seconds_between(F.col("latest_event_ts"), F.lit(as_of).cast("timestamp_ntz"))
    return row.select("latest_event_ts", age.alias("age_seconds"), (age < limit_hours * 3600).alias("is_fresh"))


def duplicate_events(deliveries: DataFrame) -> DataFrame:
    """One row: deliveries beyond the first of each event id."""
    per_id = deliveries.groupBy("id").agg(F.count("*").alias("n"))
    return per_id.agg(
        F.sum("n").alias("total_events"),
        F.count("*").alias("distinct_events"),
        F.sum(F.col("n") - 1).alias("duplicate_events"),
    )


def late_events(stg_events: DataFrame, threshold_seconds: int = 86400) -> DataFrame:
    """Per event day: events that arrived more than the threshold after they happened."""
    delay = F.timestamp_diff("SECOND", "event_ts", "created_at")
    days = stg_events.groupBy(key_to_date("event_date_sk").alias("event_date")).agg(
        F.count("*").alias("total_events"),
        hits(delay > threshold_seconds).alias("late_events"),
        F.max(delay).alias("max_delay_seconds"),
    )
    return days.withColumn("late_rate", ratio("late_events", "total_events"))


def warehouse_growth(facts: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows per fact table and week, and the change against the week before."""
    out = None
    for name, (fact, date_sk) in facts.items():
        week = F.to_date(F.date_trunc("week", key_to_date(date_sk)))
        rows = fact.groupBy(week.alias("week_start")).agg(F.count("*").alias("row_count"))
        rows = rows.select(F.lit(name).alias("table_name"), "*")
        out = rows if out is None else out.unionByName(rows)
    w = Window.partitionBy("table_name").orderBy("week_start")
    return out.withColumn("growth_rate", growth(F.col("row_count"), F.lag("row_count").over(w)))


# --- monetisation ----------------------------------------------------------


def institution_topn(daily: DataFrame, n: int = 5) -> DataFrame:
    """Report of the n institutions with most active users, with shares."""
    homes = users_by_university(daily)
    # One row per institution from here on.
    order = Window.orderBy(F.desc("users"), "university_sk")
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = homes.select(
        "university_sk",
        "users",
        F.row_number().over(order).alias("rank"),
        ratio("users", F.sum("users").over(whole)).alias("share"),
        ratio(
            F.sum("users").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
            F.sum("users").over(whole),
        ).alias("cumulative_share"),
    )
    return ranked.where(F.col("rank") <= n)
