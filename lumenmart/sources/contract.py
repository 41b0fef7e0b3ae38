"""Schemas and fixed value sets of the event and reference-table contracts."""

from __future__ import annotations

from pyspark.sql import types as T

# Landing table of raw telemetry.
ANALYTICS_EVENTS = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("event_name", T.StringType(), False),
        T.StructField("category", T.StringType(), False),
        T.StructField("priority", T.StringType(), False),
        T.StructField("schema_version", T.StringType(), False),
        T.StructField("session_id", T.StringType(), False),
        T.StructField("user_id", T.LongType(), False),
        T.StructField("platform", T.StringType(), False),
        T.StructField("app_version", T.StringType(), False),
        T.StructField("screen_name", T.StringType(), True),
        T.StructField("timestamp", T.TimestampNTZType(), False),
        T.StructField("payload", T.StringType(), False),
        T.StructField("created_at", T.TimestampNTZType(), True),
    ]
)

# One record of an event file: what clients send, before defaults.
EVENT_FILE = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("event_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("priority", T.StringType()),
        T.StructField("schema_version", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("platform", T.StringType()),
        T.StructField("app_version", T.StringType()),
        T.StructField("screen_name", T.StringType()),
        T.StructField("event_ts", T.StringType()),
        T.StructField("payload_json", T.StringType()),
    ]
)

USERS = T.StructType(
    [
        T.StructField("id_usuario", T.LongType(), False),
        T.StructField("id_universidade", T.LongType(), False),
        T.StructField("id_curso", T.LongType(), True),
        T.StructField("perfil", T.StringType(), False),
        T.StructField("data_cadastro", T.DateType(), False),
        T.StructField("status", T.StringType(), False),
    ]
)

DISCIPLINES = T.StructType(
    [
        T.StructField("id_disciplina", T.LongType(), False),
        T.StructField("codigo_disciplina", T.StringType(), False),
        T.StructField("nome_disciplina", T.StringType(), False),
        T.StructField("creditos", T.IntegerType(), False),
        T.StructField("ch_total", T.IntegerType(), False),
    ]
)

PIPELINE_RUNS = T.StructType(
    [
        T.StructField("run_sk", T.LongType(), False),
        T.StructField("run_id", T.StringType(), False),
        T.StructField("dag_id", T.StringType(), False),
        T.StructField("lane", T.StringType(), False),
        T.StructField("stage", T.StringType(), False),
        T.StructField("start_time", T.TimestampNTZType(), False),
        T.StructField("end_time", T.TimestampNTZType(), False),
        T.StructField("duration_seconds", T.DecimalType(10, 2), False),
        T.StructField("rows_extracted", T.LongType(), False),
        T.StructField("rows_loaded", T.LongType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("error_message", T.StringType(), True),
    ]
)

# Fixed values of the contract.
ENVELOPE_FIELDS = (
    "event_id",
    "event_name",
    "schema_version",
    "user_key",
    "session_id",
    "event_ts",
    "platform",
    "app_version",
    "payload",
)
EVENT_NAME_PATTERN = "^[a-z0-9_]+$"
SEMVER_PATTERN = r"^[0-9]+\.[0-9]+\.[0-9]+$"
UUID_PATTERN = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
CATEGORIES = (
    "Auth",
    "Navigation",
    "Search",
    "Ratings",
    "Downloads",
    "Uploads",
    "Planning",
    "Favorites",
    "Notifications",
    "Errors",
    "System",
    "Admin",
)
PRIORITIES = ("Critical", "High", "Medium", "Low")
CLIENT_PLATFORMS = ("web", "mobile_ios", "mobile_android")
PLATFORM_GROUPS = ("web", "mobile")
ROLES = ("Aluno", "Coordenador", "Admin")
STATUSES = ("ativo", "inativo", "pendente")
RATING_EVENTS = ("discipline_rated", "professor_rated")
CORE_ACTIONS = (
    "discipline_rated",
    "professor_rated",
    "material_uploaded",
    "planning_wizard_completed",
    "planning_session_completed",
)
COLD_START_EVENTS = ("app_launched", "app_opened")
ACTIVATION_EVENTS = (
    "discipline_rated",
    "professor_rated",
    "material_uploaded",
    "planning_session_completed",
)
HIGH_VALUE_EVENTS = ("material_downloaded", "planning_session_completed")
EPOCH = "1970-01-01T00:00:00+00:00"
