"""Event and metric catalogues: fixed values of the contract, kept as data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Event, category, priority, payload fields (? = may be null).
EVENTS = (
    ("user_registered", "Auth", "Critical", "university_id:integer course_id:integer? registration_source:string referral_code:string?"),
    ("registration_failed", "Auth", "High", "failure_reason:string"),
    ("login_succeeded", "Auth", "Critical", "method:string"),
    ("login_failed", "Auth", "Critical", "method:string failure_reason:string"),
    ("user_logged_out", "Auth", "Medium", ""),
    ("password_reset_requested", "Auth", "Medium", ""),
    ("password_reset_completed", "Auth", "Medium", ""),
    ("session_expired", "Auth", "Low", ""),
    ("screen_viewed", "Navigation", "High", "screen_name:string feature_key:string referrer_screen:string?"),
    ("tab_changed", "Navigation", "Low", ""),
    ("deep_link_opened", "Navigation", "Medium", ""),
    ("search_performed", "Search", "High", "query_length:integer result_count:integer search_scope:string"),
    ("search_result_opened", "Search", "High", "search_scope:string result_position:integer"),
    ("search_abandoned", "Search", "Medium", ""),
    ("discipline_rated", "Ratings", "Critical", "discipline_id:integer docente:string? academic_period:string oferta_id:integer? dificuldade:integer esforco:integer passou:boolean has_comment:boolean"),
    ("professor_rated", "Ratings", "Critical", "docente:string discipline_id:integer academic_period:string didatica_score:integer"),
    ("rating_edited", "Ratings", "Medium", ""),
    ("rating_deleted", "Ratings", "Low", ""),
    ("material_downloaded", "Downloads", "High", "material_type:string course_id:integer docente:string? academic_period:string?"),
    ("download_failed", "Downloads", "Medium", ""),
    ("material_uploaded", "Uploads", "High", "material_type:string course_id:integer file_size_kb:integer academic_period:string?"),
    ("upload_failed", "Uploads", "High", "material_type:string failure_reason:string"),
    ("planning_session_started", "Planning", "High", "academic_period:string"),
    ("planning_session_completed", "Planning", "High", "courses_planned:integer academic_period:string had_conflicts_resolved:boolean"),
    ("course_added_to_plan", "Planning", "Medium", ""),
    ("course_removed_from_plan", "Planning", "Low", ""),
    ("item_favorited", "Favorites", "Medium", "target_type:string target_id:integer"),
    ("item_unfavorited", "Favorites", "Low", ""),
    ("notification_opened", "Notifications", "Medium", "notification_type:string time_to_open_seconds:integer"),
    ("notification_sent", "Notifications", "Medium", ""),
    ("notification_dismissed", "Notifications", "Low", ""),
    ("api_error_occurred", "Errors", "Critical", "error_code:string endpoint:string http_status:integer"),
    ("frontend_error_occurred", "Errors", "Critical", "error_name:string screen_name:string"),
    ("validation_error_occurred", "Errors", "High", "form_name:string failed_fields_count:integer"),
    ("app_opened", "System", "Critical", "is_cold_start:boolean platform:string"),
    ("app_backgrounded", "System", "Low", ""),
    ("feature_flag_evaluated", "System", "Low", ""),
    ("admin_action_performed", "Admin", "Low", "action_type:string target_type:string"),
    ("content_moderated", "Admin", "Low", ""),
)

# Metric -> (registered query, column) that computes it.
METRICS = {
    "total_users": ("mrt_acquisition", "total_users_cumulative"),
    "new_users": ("mrt_acquisition", "new_users"),
    "returning_users": ("mrt_acquisition", "returning_users"),
    "user_growth": ("user_growth", "total_users_growth_rate"),
    "registration_rate": ("registration_rate", "registration_rate"),
    "university_growth": ("university_growth", "growth_rate"),
    "course_growth": ("course_growth", "growth_rate"),
    "activation_rate": ("activation_by_definition", "activation_rate"),
    "time_to_activation": ("time_to_activation", "median_hours"),
    "first_rating": ("first_action_share", "first_rating_share"),
    "first_upload": ("first_action_share", "first_upload_share"),
    "first_session_completion": ("first_session_completion", "completion_rate"),
    "d1_d7_d14_d30_retention": ("retention_rates", "d14_retention_rate"),
    "wau": ("mrt_engagement", "wau"),
    "mau": ("mrt_engagement", "mau"),
    "cohort_retention_table": ("cohort_week_matrix", "active_users"),
    "rolling_retention": ("rolling_retention", "d7_rolling_rate"),
    "dau": ("mrt_engagement", "dau"),
    "wau_mau": ("wau_mau", "wau_mau"),
    "stickiness": ("mrt_engagement", "stickiness_dau_mau"),
    "session_duration": ("session_percentiles", "p50_seconds"),
    "sessions_per_user": ("mrt_engagement", "sessions_per_user"),
    "feature_adoption": ("feature_adoption", "adoption_rate"),
    "bounce_rate": ("bounce_by_definition", "bounce_rate"),
    "power_users": ("power_users", "user_sk"),
    "dormant_users": ("dormant_users", "dormant_users"),
    "ratings": ("mrt_content", "total_ratings"),
    "downloads": ("mrt_content", "downloads"),
    "uploads": ("mrt_content", "uploads"),
    "searches": ("mrt_content", "searches"),
    "search_success_rate": ("mrt_content", "search_success_rate"),
    "empty_search_rate": ("empty_search_by_definition", "empty_search_rate"),
    "professors_ranked": ("mrt_content", "professors_ranked"),
    "courses_ranked": ("mrt_content", "courses_ranked"),
    "funnel_conversion": ("funnel_conversion", "step_rate"),
    "screen_feature_abandonment": ("flow_abandonment", "abandonment_rate"),
    "most_least_used_features": ("feature_ranking", "rank_by_users"),
    "navigation_flow": ("navigation_flow", "transition_count"),
    "api_error_rate": ("mrt_quality", "api_error_rate"),
    "frontend_error_rate": ("frontend_error_sessions", "frontend_error_rate"),
    "upload_failures": ("failure_shares", "upload_failure_rate"),
    "login_failures": ("failure_shares", "login_failure_rate"),
    "validation_errors": ("mrt_quality", "validation_errors"),
    "response_time_p50_p90": ("latency_percentiles", "p50_ms"),
    "pipeline_runtime": ("mrt_data_engineering", "avg_pipeline_runtime_seconds"),
    "pipeline_success_rate": ("mrt_data_engineering", "pipeline_success_rate"),
    "etl_duration_by_stage": ("etl_duration_by_stage", "avg_duration_seconds"),
    "event_volume": ("event_volume", "event_count"),
    "data_freshness": ("data_freshness", "age_seconds"),
    "duplicate_events": ("duplicate_events", "duplicate_events"),
    "missing_late_events": ("late_events", "late_events"),
    "warehouse_growth": ("warehouse_growth", "growth_rate"),
    "power_user_concentration": ("mrt_monetization_readiness", "power_user_concentration_rate"),
    "high_value_feature_usage": ("high_value_usage", "usage_rate"),
    "institutional_concentration": ("institution_topn", "cumulative_share"),
    "willingness_to_engage_proxy": ("engagement_corr", "sessions_features_corr"),
    "admin_audit_trail": ("admin_actions", "actions"),
    "reengagement_rate": ("reengagement_rate", "reengagement_rate"),
    "login_failure_rate": ("failure_shares", "login_failure_rate"),
}


def values_sql() -> str:
    """The catalogue as a VALUES list that any SQL engine reads."""
    return ", ".join(f"('{n}', '{c}', '{p}', '1')" for n, c, p, _ in EVENTS)


def required_fields(event: str) -> list[str]:
    spec = next(f for n, _, _, f in EVENTS if n == event)
    return [f.split(":")[0] for f in spec.split() if not f.endswith("?")]


def event_catalog(spark: SparkSession) -> DataFrame:
    """One row per catalogued event; fixed size, so always safe to broadcast."""
    return spark.sql(f"SELECT * FROM VALUES {values_sql()} AS t(event_name, category, priority, schema_version)")


def payload_fields(spark: SparkSession) -> DataFrame:
    """One row per (event, payload field)."""
    rows = []
    for name, _, _, spec in EVENTS:
        for field in spec.split():
            key, kind = field.split(":")
            rows.append(f"('{name}', '{key}', '{kind.rstrip('?')}', {str(kind.endswith('?')).lower()})")
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t(event_name, field, field_type, nullable)")
