"""Fact builders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenmart.functions import (
    UNKNOWN_SK,
    clean_name,
    seconds_between,
    surrogate_key,
)
from lumenmart.sources.contract import COLD_START_EVENTS, CORE_ACTIONS, RATING_EVENTS


# Payload fields that dimension keys are made of.
KEY_FIELDS = "course_id string, discipline_id string, academic_period string, ano_periodo string, docente string"

SCORE_FIELDS = "dificuldade string, esforco string, passou string"


def is_known(sk: str) -> Column:
    return F.col(sk) != UNKNOWN_SK


def hits(condition: Column) -> Column:
    """Number of rows that satisfy a condition."""
    return F.count(F.when(condition, 1))


def flag(condition: Column) -> Column:
    """1 when any row satisfies the condition, else 0."""
    return F.max(F.when(condition, 1).otherwise(0))


def fct_events(events: DataFrame, dim_users: DataFrame) -> DataFrame:
    """One row per event with its dimension keys.

    Screen, professor, course and period keys are hashes of values in the event
    itself, and these dimensions are built from the same events, so the hash
    already is what a lookup would return. Only the user version needs a join.
    """
    current = dim_users.where("is_current").select(
        "user_id", F.col("user_sk").alias("_user_sk"), F.col("course_sk").alias("_course_sk")
    )
    course = F.coalesce("_p.course_id", "_p.discipline_id")
    # An event that names no term belongs to the one of its day, which the calendar has.
    term = F.concat_ws(".", F.year("event_ts"), F.when(F.month("event_ts") <= 6, 1).otherwise(2))
    period = F.coalesce("_p.academic_period", "_p.ano_periodo", term)
    # The payload is parsed once for all of its fields.
    parsed = events.withColumn("_p", F.from_json("payload_json", KEY_FIELDS))
    return parsed.join(current, "user_id", "left").select(
        surrogate_key("raw_event_id").alias("event_sk"),
        F.col("raw_event_id").alias("event_id"),
        "event_date_sk",
        F.coalesce("_user_sk", F.lit(UNKNOWN_SK).cast("bigint")).alias("user_sk"),
        surrogate_key("screen_name").alias("screen_sk"),
        F.coalesce(surrogate_key(course), "_course_sk").alias("course_sk"),
        surrogate_key(clean_name("_p.docente")).alias("professor_sk"),
        surrogate_key(period).alias("period_sk"),
        "session_id",
        "platform",
        "app_version",
        "event_name",
        "category",
        "priority",
        "schema_version",
        "event_ts",
        "payload_json",
    )


def event_rows(events: DataFrame) -> DataFrame:
    """The event fact without what needs a user row, for queries that count
    events or sessions and never look at users: no join, no shuffle."""
    return events.select(
        surrogate_key("raw_event_id").alias("event_sk"),
        F.col("raw_event_id").alias("event_id"),
        "event_date_sk",
        surrogate_key("screen_name").alias("screen_sk"),
        "session_id",
        "platform",
        "app_version",
        "event_name",
        "category",
        "priority",
        "schema_version",
        "event_ts",
        "payload_json",
    )


def fct_daily_user_activity(
    events: DataFrame, dim_users: DataFrame, core_actions: tuple[str, ...] = CORE_ACTIONS
) -> DataFrame:
    """One row per user and day.

    Events are first added up per (day, user, session) on the map side; the
    session count is then a plain count of these rows.
    """
    name = F.col("event_name")
    per_session = events.groupBy("event_date_sk", "user_sk", "session_id").agg(
        F.count("*").alias("events_count"),
        hits(name.isin(*RATING_EVENTS)).alias("ratings"),
        hits(name == "material_downloaded").alias("downloads"),
        hits(name == "material_uploaded").alias("uploads"),
        flag(name.isin(*core_actions)).alias("core"),
    )
    daily = per_session.groupBy(F.col("event_date_sk").alias("date_sk"), "user_sk").agg(
        F.count("session_id").alias("session_count"),
        F.sum("events_count").alias("events_count"),
        F.sum("ratings").alias("ratings_submitted_count"),
        F.sum("downloads").alias("downloads_count"),
        F.sum("uploads").alias("uploads_count"),
        F.max("core").alias("has_completed_core_action"),
    )
    homes = dim_users.select("user_sk", "university_sk")
    daily_id = F.concat_ws("-", F.col("date_sk").cast("string"), F.col("user_sk").cast("string"))
    return daily.join(homes, "user_sk", "left").select(
        surrogate_key(daily_id).alias("daily_activity_sk"),
        "date_sk",
        "user_sk",
        F.coalesce("university_sk", F.lit(UNKNOWN_SK).cast("bigint")).alias("university_sk"),
        F.lit(1).alias("is_active_day"),
        "session_count",
        "events_count",
        "ratings_submitted_count",
        "downloads_count",
        "uploads_count",
        "has_completed_core_action",
    )


def fct_ratings(events: DataFrame) -> DataFrame:
    """One row per rating event; absent or unreadable scores get the middle value."""
    unknown = F.lit(UNKNOWN_SK).cast("bigint")
    ratings = events.where(F.col("event_name").isin(*RATING_EVENTS)).withColumn("_p", F.from_json("payload_json", SCORE_FIELDS))
    passed = F.lower("_p.passou")
    passed = F.when(passed == "true", 1).when(passed == "false", 0).otherwise(passed.try_cast("int"))
    return ratings.select(
        F.col("event_sk").alias("rating_sk"),
        F.col("event_id").alias("rating_id"),
        F.col("event_date_sk").alias("date_sk"),
        "user_sk",
        F.coalesce("course_sk", unknown).alias("course_sk"),
        "professor_sk",
        F.coalesce("period_sk", unknown).alias("period_sk"),
        F.coalesce(F.col("_p.dificuldade").try_cast("int"), F.lit(3)).alias("dificuldade"),
        F.coalesce(F.col("_p.esforco").try_cast("int"), F.lit(3)).alias("esforco"),
        F.coalesce(passed, F.lit(1)).alias("passou"),
        F.col("event_ts").alias("rating_ts"),
    )


def fct_sessions(events: DataFrame, cold_starts: tuple[str, ...] = COLD_START_EVENTS) -> DataFrame:
    """One row per client session id, pre-aggregated per (session, screen)."""
    per_screen = events.groupBy("session_id", "screen_sk").agg(
        F.min("event_date_sk").alias("day"),
        F.min("user_sk").alias("user_sk"),
        F.min("event_ts").alias("lo"),
        F.max("event_ts").alias("hi"),
        hits(F.col("category") == "Errors").alias("errors"),
        flag(F.col("event_name").isin(*cold_starts)).alias("cold"),
    )
    sessions = per_screen.groupBy("session_id").agg(
        F.min("day").alias("session_start_date_sk"),
        F.min("user_sk").alias("user_sk"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        F.count("screen_sk").alias("screens_viewed_count"),
        F.sum("errors").alias("errors_count"),
        F.max("cold").alias("is_cold_start"),
    )
    return sessions.select(
        surrogate_key("session_id").alias("session_sk"),
        "session_id",
        "session_start_date_sk",
        "user_sk",
        seconds_between("lo", "hi").alias("session_duration_seconds"),
        "screens_viewed_count",
        "errors_count",
        "is_cold_start",
    )
