"""The nine metric marts.

Inputs are facts and dimensions; a fact's unknown-user row never counts as a
user. `fct_daily_user_activity` has one row per user and day and the version
key of `dim_users` is unique, so users are counted without DISTINCT wherever
the grain already guarantees it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenmart.functions import UNKNOWN_SK, key_to_date, ratio
from lumenmart.operators.facts import flag, hits, is_known
from lumenmart.operators.ranking import top_tile_sum, trailing_actives
from lumenmart.sources.contract import HIGH_VALUE_EVENTS


def user_days(daily: DataFrame) -> DataFrame:
    """(user_sk, activity_date, ...) of known users."""
    return daily.where(is_known("user_sk")).withColumn("activity_date", key_to_date("date_sk"))


def growth(current: Column, previous: Column, scale: int = 4) -> Column:
    return ratio(current - previous, previous, scale)


def mrt_acquisition(daily: DataFrame, dim_users: DataFrame) -> DataFrame:
    signups = dim_users.groupBy(F.col("registration_date").alias("metric_date")).agg(F.count("*").alias("new"))
    registered = dim_users.select("user_sk", "registration_date")
    activity = (
        user_days(daily)
        .join(registered, "user_sk")
        .groupBy(F.col("activity_date").alias("metric_date"))
        .agg(F.count("*").alias("active"), hits(F.col("registration_date") < F.col("activity_date")).alias("returning"))
    )
    days = signups.join(activity, "metric_date", "full").na.fill(0, ["new", "active", "returning"])
    # One row per calendar day.
    in_order = Window.orderBy("metric_date")
    return days.select(
        "metric_date",
        F.col("new").alias("new_users"),
        F.col("returning").alias("returning_users"),
        F.col("active").alias("total_active_users"),
        F.sum("new").over(in_order).alias("total_users_cumulative"),
        growth(F.col("new"), F.lag("new").over(in_order)).alias("user_growth_rate"),
    )


def mrt_activation(events: DataFrame, dim_users: DataFrame, window_days: int = 7) -> DataFrame:
    """Any first event within the window activates, and a rating or an upload
    counts whenever it came: the mart's own rules, wider than the metric's."""

    def first(name: str) -> Column:
        return F.min(F.when(F.col("event_name") == name, F.col("event_ts")))

    firsts = (
        events.where(is_known("user_sk"))
        .groupBy("user_sk")
        .agg(
            F.min("event_ts").alias("any_ts"),
            first("discipline_rated").alias("rating_ts"),
            first("material_uploaded").alias("upload_ts"),
        )
    )
    users = dim_users.select("user_sk", "registration_date").join(firsts, "user_sk", "left")
    deadline = F.date_add("registration_date", window_days).cast("timestamp_ntz")
    cohorts = users.groupBy("registration_date").agg(
        F.count("*").alias("total_cohort_new_users"),
        hits(F.col("any_ts") <= deadline).alias("activated_users_7d"),
        F.count("rating_ts").alias("users_first_action_rating"),
        F.count("upload_ts").alias("users_first_action_upload"),
    )
    return cohorts.withColumn("activation_rate_7d", ratio("activated_users_7d", "total_cohort_new_users"))


def retention_flags(daily: DataFrame, dim_users: DataFrame, offsets: tuple[int, ...]) -> DataFrame:
    """One row per user: cohort date and, per offset, 1 if active on that day.

    The join and the per-user aggregate share one partitioning on the user.
    """
    days = user_days(daily).select("user_sk", "activity_date")
    users = dim_users.select("user_sk", F.col("registration_date").alias("cohort_date"))
    joined = users.join(days, "user_sk", "left")
    age = F.datediff("activity_date", "cohort_date")
    return joined.groupBy("user_sk", "cohort_date").agg(*[flag(age == n).alias(f"d{n}") for n in offsets])


def mrt_retention(daily: DataFrame, dim_users: DataFrame, all_rates: bool = False) -> DataFrame:
    offsets = (1, 7, 14, 30)
    rated = offsets if all_rates else (1, 7, 30)
    cohorts = (
        retention_flags(daily, dim_users, offsets)
        .groupBy("cohort_date")
        .agg(F.count("*").alias("cohort_size"), *[F.sum(f"d{n}").alias(f"d{n}_active_users") for n in offsets])
    )
    return cohorts.select("*", *[ratio(f"d{n}_active_users", "cohort_size").alias(f"d{n}_retention_rate") for n in rated])


def session_stats(sessions: DataFrame) -> DataFrame:
    """Per start day: sessions, duration sum, sessions with at most one screen."""
    return sessions.groupBy(key_to_date("session_start_date_sk").alias("activity_date")).agg(
        F.count("*").alias("sessions"),
        F.sum("session_duration_seconds").alias("seconds"),
        hits(F.col("screens_viewed_count") <= 1).alias("single_screen"),
    )


def sessions_per_user(sessions: DataFrame) -> DataFrame:
    return (
        sessions.where(is_known("user_sk"))
        .groupBy("user_sk")
        .agg(F.count("*").alias("session_cnt"), F.sum("session_duration_seconds").alias("seconds"))
    )


def mrt_engagement(daily: DataFrame, sessions: DataFrame, dim_users: DataFrame) -> DataFrame:
    actives = trailing_actives(user_days(daily), "user_sk", "activity_date", {"wau": 7, "mau": 30})
    joined = actives.join(session_stats(sessions), "activity_date", "left")
    # The first of ten equal tiles of the users ranked by sessions.
    power = sessions_per_user(sessions).agg(F.ceil(F.count("*") / 10).cast("bigint")).scalar()
    users = dim_users.where("is_current").agg(F.count("*")).scalar()
    all_days = joined.select("*", F.col("active").alias("dau"), users.alias("users"), power.alias("power"))
    return all_days.select(
        "activity_date",
        "dau",
        "wau",
        "mau",
        ratio("dau", "mau").alias("stickiness_dau_mau"),
        F.coalesce(ratio("seconds", "sessions", 2), F.lit(0.0)).alias("avg_session_duration_seconds"),
        ratio("sessions", "dau", 2).alias("sessions_per_user"),
        ratio(F.coalesce("single_screen", F.lit(0)), "sessions").alias("bounce_rate"),
        ratio("dau", "users").alias("feature_adoption_rate"),
        (F.col("users") - F.col("mau")).alias("dormant_users_count"),
        F.col("power").alias("power_users_count"),
    )


def mrt_content(ratings: DataFrame, events: DataFrame) -> DataFrame:
    rated = ratings.groupBy(key_to_date("date_sk").alias("metric_date")).agg(
        F.count("*").alias("total_ratings"),
        F.sum("dificuldade").alias("dificuldade"),
        F.sum("esforco").alias("esforco"),
        F.countDistinct("professor_sk").alias("professors_ranked"),
        F.countDistinct("course_sk").alias("courses_ranked"),
    )
    name = F.col("event_name")
    used = events.groupBy(key_to_date("event_date_sk").alias("metric_date")).agg(
        hits(name == "material_downloaded").alias("downloads"),
        hits(name == "material_uploaded").alias("uploads"),
        hits(name == "search_performed").alias("searches"),
        hits(name == "search_result_opened").alias("opened"),
        hits(name == "search_abandoned").alias("abandoned"),
    )
    days = rated.join(used, "metric_date", "full").na.fill(0)
    return days.select(
        "metric_date",
        "total_ratings",
        F.coalesce(ratio("dificuldade", "total_ratings", 2), F.lit(0.0)).alias("avg_dificuldade"),
        F.coalesce(ratio("esforco", "total_ratings", 2), F.lit(0.0)).alias("avg_esforco"),
        "professors_ranked",
        "courses_ranked",
        "downloads",
        "uploads",
        "searches",
        ratio("opened", "searches").alias("search_success_rate"),
        ratio("abandoned", "searches").alias("empty_search_rate"),
    )


# The three features that the product mart compares.
FEATURES = ("Disciplinas & Professores", "Avaliações", "Sessões de Estudo")


def mrt_product(daily: DataFrame, ratings: DataFrame, sessions: DataFrame) -> DataFrame:
    def usage(feature: str, fact: DataFrame, total: Column) -> DataFrame:
        per_user = fact.groupBy("user_sk").agg(total.cast("bigint").alias("n"))
        return per_user.agg(hits(is_known("user_sk")).alias("unique_users_count"), F.sum("n").alias("total_events_count")).select(
            F.lit(feature).alias("feature_key"), "*"
        )

    rows = (
        usage(FEATURES[0], daily, F.sum("events_count"))
        .unionByName(usage(FEATURES[1], ratings, F.count("*")))
        .unionByName(usage(FEATURES[2], sessions, F.count("*")))
    )
    return rows.select(
        "*",
        F.dense_rank().over(Window.orderBy(F.desc("total_events_count"))).alias("rank_most_used"),
        F.dense_rank().over(Window.orderBy("total_events_count")).alias("rank_least_used"),
    )


def mrt_quality(events: DataFrame) -> DataFrame:
    name = F.col("event_name")
    days = events.groupBy(key_to_date("event_date_sk").alias("error_date")).agg(
        hits(name == "api_error_occurred").alias("api_errors"),
        hits(name == "frontend_error_occurred").alias("frontend_errors"),
        hits(name == "upload_failed").alias("upload_failures"),
        hits(name == "login_failed").alias("login_failures"),
        hits(name == "validation_error_occurred").alias("validation_errors"),
        F.count("event_sk").alias("total_events"),
    )
    return days.select(
        "*",
        ratio("api_errors", "total_events").alias("api_error_rate"),
        ratio("frontend_errors", "total_events").alias("frontend_error_rate"),
        # Fixed values of this mart; measured percentiles: metrics.latency_percentiles.
        F.lit(250.0).alias("response_time_p50_ms"),
        F.lit(650.0).alias("response_time_p90_ms"),
    )


def mrt_data_engineering(runs: DataFrame) -> DataFrame:
    days = runs.groupBy(F.to_date("start_time").alias("run_date")).agg(
        F.count("run_id").alias("total_runs"),
        hits(F.col("status") == "SUCCESS").alias("successful_runs"),
        F.sum(F.col("duration_seconds") * 100).cast("bigint").alias("centis"),
        F.count("duration_seconds").alias("timed"),
        F.sum("rows_extracted").alias("total_rows_extracted"),
        F.sum("rows_loaded").alias("total_rows_loaded"),
    )
    return days.select(
        "run_date",
        "total_runs",
        "successful_runs",
        ratio("successful_runs", "total_runs").alias("pipeline_success_rate"),
        ratio("centis", F.col("timed") * 100, 2).alias("avg_pipeline_runtime_seconds"),
        "total_rows_extracted",
        "total_rows_loaded",
    )


def users_by_university(daily: DataFrame) -> DataFrame:
    users = daily.where(is_known("user_sk")).groupBy("university_sk", "user_sk").agg(F.lit(1).alias("one"))
    return users.groupBy("university_sk").agg(F.count("*").alias("users"))


def mrt_monetization_readiness(
    sessions: DataFrame, events: DataFrame, daily: DataFrame, university_sk: int | None = None
) -> DataFrame:
    """One row. `university_sk` picks the institution whose share is reported,
    by default the one with the most active users."""
    per_user = sessions_per_user(sessions)
    totals = per_user.agg(
        F.count("*").alias("total_engaged_users"),
        F.sum("session_cnt").alias("total_sessions"),
        F.sum("seconds").alias("total_seconds"),
    )
    top = top_tile_sum(per_user, "session_cnt", 10, "n").scalar()
    valuable = events.agg(hits(F.col("event_name").isin(*HIGH_VALUE_EVENTS))).scalar()
    homes = users_by_university(daily)
    if university_sk is None:
        chosen = F.max(F.when(F.col("university_sk") != UNKNOWN_SK, F.col("users")))
    else:
        chosen = F.sum(F.when(F.col("university_sk") == university_sk, F.col("users")).otherwise(0))
    share = homes.agg(F.coalesce(ratio(chosen, F.sum("users")), F.lit(0.0))).scalar()
    return totals.select(
        "total_engaged_users",
        top.alias("top_decile_sessions"),
        "total_sessions",
        "total_seconds",
        valuable.alias("high_value_feature_usage_count"),
        share.alias("institutional_concentration_rate"),
    ).select(
        "total_engaged_users",
        "top_decile_sessions",
        "total_sessions",
        ratio("top_decile_sessions", "total_sessions").alias("power_user_concentration_rate"),
        "high_value_feature_usage_count",
        "institutional_concentration_rate",
        ratio("total_sessions", "total_seconds", 6).alias("willingness_to_engage_proxy"),
    )
