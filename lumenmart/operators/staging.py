"""Staging projections: rename, project, add the date key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenmart.functions import date_key


def stg_events(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("raw_event_id"),
        "event_name",
        "category",
        "priority",
        "schema_version",
        "session_id",
        "user_id",
        "platform",
        "app_version",
        "screen_name",
        F.col("timestamp").alias("event_ts"),
        F.col("payload").alias("payload_json"),
        "created_at",
        date_key("timestamp").alias("event_date_sk"),
    )


def stg_users(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id_usuario").alias("user_id"),
        F.col("id_universidade").alias("university_id"),
        F.col("id_curso").alias("course_id"),
        F.col("perfil").alias("role"),
        F.col("data_cadastro").alias("registration_date"),
        "status",
    )


def stg_disciplines(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id_disciplina").alias("discipline_id"),
        "codigo_disciplina",
        "nome_disciplina",
        "creditos",
        "ch_total",
    )
