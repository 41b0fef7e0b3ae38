"""Point, rollup and range queries over the facts, and the dashboard cards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenmart.sources.readers import time_range


def activity_lookup(daily: DataFrame, date_sk: int, user_sk: int) -> DataFrame:
    """Workload A: one user on one day."""
    row = (F.col("date_sk") == date_sk) & (F.col("user_sk") == user_sk)
    return daily.where(row).select("date_sk", "user_sk", "session_count", "events_count")


def course_scores(ratings: DataFrame, dim_courses: DataFrame, date_sk: int | None = None) -> DataFrame:
    """Workload B: mean scores per course, of one day or of all days.

    Scores are added up per course before the join with the course names.
    """
    r = ratings if date_sk is None else ratings.where(F.col("date_sk") == date_sk)
    sums = r.groupBy("course_sk").agg(
        F.count("*").alias("n"), F.sum("dificuldade").alias("d"), F.sum("esforco").alias("e")
    )
    named = sums.join(dim_courses.select("course_sk", "codigo_disciplina", "nome_disciplina"), "course_sk")
    per_name = named.groupBy("codigo_disciplina", "nome_disciplina").agg(
        F.sum("n").alias("n"), F.sum("d").alias("d"), F.sum("e").alias("e")
    )
    return per_name.select(
        "codigo_disciplina",
        "nome_disciplina",
        F.round(F.col("d") / F.col("n"), 6).alias("avg_dificuldade"),
        F.round(F.col("e") / F.col("n"), 6).alias("avg_esforco"),
    )


def user_durations(sessions: DataFrame, dim_users: DataFrame, date_sk: int | None = None) -> DataFrame:
    """Workload C: total session seconds per user, of one day or of all days."""
    s = sessions if date_sk is None else sessions.where(F.col("session_start_date_sk") == date_sk)
    sums = s.groupBy("user_sk").agg(F.sum("session_duration_seconds").alias("t"))
    return (
        sums.join(dim_users.select("user_sk", "user_id"), "user_sk")
        .groupBy("user_id")
        .agg(F.sum("t").alias("total_duration"))
    )


def month_scan(events: DataFrame, start: str, end: str) -> DataFrame:
    """Events of a half-open time range, per day and category."""
    scan = time_range(events, start, end)
    return scan.groupBy("event_date_sk", "category").agg(F.count("*").alias("events"))


def latest_run(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc("start_time")).limit(1).select("run_id", "stage", "status", "rows_extracted", "rows_loaded")


# card -> (mart, columns, order column, descending)
CARDS = {
    "card_north_star": ("mrt_engagement", ["activity_date", "dau", "wau", "mau", "stickiness_dau_mau"], "activity_date", True),
    "card_acquisition": (
        "mrt_acquisition",
        ["metric_date", "new_users", "returning_users", "total_active_users", "total_users_cumulative", "user_growth_rate"],
        "metric_date",
        True,
    ),
    "card_activation": (
        "mrt_activation",
        [
            "registration_date",
            "total_cohort_new_users",
            "activated_users_7d",
            "activation_rate_7d",
            "users_first_action_rating",
            "users_first_action_upload",
        ],
        "registration_date",
        True,
    ),
    "card_feature_usage": (
        "mrt_product",
        ["feature_key", "unique_users_count", "total_events_count", "rank_most_used", "rank_least_used"],
        "rank_most_used",
        False,
    ),
    "card_session_trends": (
        "mrt_engagement",
        [
            "activity_date",
            "avg_session_duration_seconds",
            "sessions_per_user",
            "bounce_rate",
            "feature_adoption_rate",
            "dormant_users_count",
            "power_users_count",
        ],
        "activity_date",
        True,
    ),
    "card_cohort_retention": (
        "mrt_retention",
        [
            "cohort_date",
            "cohort_size",
            "d1_active_users",
            "d7_active_users",
            "d14_active_users",
            "d30_active_users",
            "d1_retention_rate",
            "d7_retention_rate",
            "d30_retention_rate",
        ],
        "cohort_date",
        True,
    ),
    "card_evaluations": (
        "mrt_content",
        ["metric_date", "total_ratings", "avg_dificuldade", "avg_esforco", "professors_ranked", "courses_ranked"],
        "metric_date",
        True,
    ),
    "card_content_search": (
        "mrt_content",
        ["metric_date", "downloads", "uploads", "searches", "search_success_rate", "empty_search_rate"],
        "metric_date",
        True,
    ),
    "card_errors": (
        "mrt_quality",
        [
            "error_date",
            "api_errors",
            "frontend_errors",
            "upload_failures",
            "login_failures",
            "validation_errors",
            "total_events",
            "api_error_rate",
            "frontend_error_rate",
        ],
        "error_date",
        True,
    ),
    "card_response_times": (
        "mrt_quality",
        ["error_date", "response_time_p50_ms", "response_time_p90_ms"],
        "error_date",
        True,
    ),
    "card_load_health": (
        "mrt_data_engineering",
        [
            "run_date",
            "total_runs",
            "successful_runs",
            "pipeline_success_rate",
            "avg_pipeline_runtime_seconds",
            "total_rows_extracted",
            "total_rows_loaded",
        ],
        "run_date",
        True,
    ),
    "card_volume_growth": (
        "mrt_data_engineering",
        ["run_date", "total_rows_extracted AS event_volume", "total_rows_loaded AS warehouse_growth"],
        "run_date",
        True,
    ),
    "card_monetization": (
        "mrt_monetization_readiness",
        [
            "total_engaged_users",
            "top_decile_sessions",
            "total_sessions",
            "power_user_concentration_rate",
            "high_value_feature_usage_count",
            "institutional_concentration_rate",
            "willingness_to_engage_proxy",
        ],
        None,
        True,
    ),
}


def card(mart: DataFrame, name: str) -> DataFrame:
    _, columns, order, descending = CARDS[name]
    if order is not None:
        mart = mart.orderBy(F.desc(order) if descending else F.asc(order))
    return mart.selectExpr(*columns)
