"""Sources: event files, operational tables, incremental reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenmart.sources import contract as C
from lumenmart.sources.catalog import event_catalog

# Declared sources: logical name -> table it is read from.
SOURCE_TABLES = {
    "analytics_events": "raw_telemetry.analytics_events",
    "usuarios": "operational_db.usuarios",
    "curriculo_disciplinas": "operational_db.curriculo_disciplinas",
    "faculdades": "operational_db.faculdades",
    "cursos": "operational_db.cursos",
}

# Columns that may leave the operational user table; names, mail, phone,
# password and enrolment number never do.
USER_COLUMNS = ("id", "created_at", "status")


def source(spark: SparkSession, name: str, overrides: dict[str, str] | None = None) -> DataFrame:
    """A declared source, from the catalogue or from an overriding path."""
    if overrides and name in overrides:
        return spark.read.parquet(overrides[name])
    return spark.table(SOURCE_TABLES[name])


def utc(c: Column | str) -> Column:
    """Text with `Z` or an offset to a UTC wall-clock timestamp."""
    c = F.col(c) if isinstance(c, str) else c
    return F.to_timestamp(c).cast("timestamp_ntz")


def read_event_file(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Events from JSON, one per line, or one document per file (`multi_line`),
    which cannot be split between tasks."""
    return spark.read.schema(C.EVENT_FILE).option("multiLine", multi_line).json(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    lower: str,
    upper: str,
    partitions: int,
    **options: str,
) -> DataFrame:
    """Operational table over JDBC, read by range of an indexed column so that
    no single connection carries the whole table. Filters are pushed down."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=column, lowerBound=lower, upperBound=upper, **options)
        .option("numPartitions", partitions)
        .load()
    )


def normalise_events(raw: DataFrame, loaded_at: Column) -> DataFrame:
    """File or operational rows to landing rows: UTC time, null defaults,
    category and priority from the catalogue, malformed payloads to `{}`."""
    catalog = event_catalog(raw.sparkSession).select(
        "event_name", F.col("category").alias("_category"), F.col("priority").alias("_priority")
    )
    payload = F.col("payload_json")
    return raw.join(F.broadcast(catalog), "event_name", "left").select(
        F.col("event_id").alias("id"),
        "event_name",
        F.coalesce("_category", "category", F.lit("General")).alias("category"),
        F.coalesce("_priority", "priority", F.lit("Normal")).alias("priority"),
        F.coalesce("schema_version", F.lit("1")).alias("schema_version"),
        "session_id",
        F.coalesce("user_id", F.lit(0)).cast("bigint").alias("user_id"),
        F.coalesce("platform", F.lit("web")).alias("platform"),
        F.coalesce("app_version", F.lit("1.0.0")).alias("app_version"),
        "screen_name",
        utc("event_ts").alias("timestamp"),
        F.when(F.try_parse_json(payload).isNotNull(), payload).otherwise("{}").alias("payload"),
        loaded_at.alias("created_at"),
    )


def incremental(
    events: DataFrame,
    watermark: str,
    full_refresh: bool = False,
    limit: int | None = None,
    lookback_days: int = 0,
    ts: str = "timestamp",
    key: str = "id",
) -> DataFrame:
    """Rows strictly after the watermark. A limit takes the oldest rows first,
    so that the next watermark never jumps over unread ones. A lookback reads
    some days again, for events that arrive after younger ones were loaded;
    the append drops those already stored."""
    if not full_refresh:
        after = F.timestamp_add("DAY", F.lit(-lookback_days), utc(F.lit(watermark)))
        events = events.where(F.col(ts) > after)
    if limit is not None:
        events = events.orderBy(ts, key).limit(limit)
    return events


def users_from_operational(users: DataFrame, academics: DataFrame, default_date: str = "2026-01-01") -> DataFrame:
    """Operational users joined with their enrolment, allow-listed columns only."""
    keep = [c for c in USER_COLUMNS if c in users.columns]
    slim = users.select(*keep)
    if "status" not in slim.columns:
        slim = slim.withColumn("status", F.lit("ativo"))
    enrol = academics.select(F.col("usuario_id").alias("id"), "faculdade_id", "curso_id")
    return slim.join(enrol, "id", "left").select(
        F.col("id").cast("bigint").alias("id_usuario"),
        F.coalesce("faculdade_id", F.lit(1)).cast("bigint").alias("id_universidade"),
        F.col("curso_id").cast("bigint").alias("id_curso"),
        F.lit("Aluno").alias("perfil"),
        F.coalesce(F.to_date("created_at"), F.lit(default_date).cast("date")).alias("data_cadastro"),
        F.coalesce("status", F.lit("ativo")).alias("status"),
    )


def disciplines_from_operational(disciplines: DataFrame) -> DataFrame:
    """Blank codes and names get id-based ones; the operational table has no
    credits (always 4), hours default to 60."""
    text_id = F.col("id").cast("string")

    def filled(name: str, prefix: str) -> Column:
        return F.coalesce(F.nullif(F.trim(F.col(name)), F.lit("")), F.concat(F.lit(prefix), text_id))

    return disciplines.select(
        F.col("id").cast("bigint").alias("id_disciplina"),
        filled("codigo", "DISC").alias("codigo_disciplina"),
        filled("nome", "Disciplina ").alias("nome_disciplina"),
        F.lit(4).alias("creditos"),
        F.coalesce("carga_horaria", F.lit(60)).cast("int").alias("ch_total"),
    )


def pseudonymise(df: DataFrame, salt: str, id_col: str = "user_id", out: str = "user_key") -> DataFrame:
    """Salted SHA-256 of the user id, the id itself dropped; null stays null."""
    return df.withColumn(out, F.sha2(F.concat(F.lit(salt), F.col(id_col).cast("string")), 256)).drop(id_col)


def time_range(df: DataFrame, start: str, end: str, ts: str = "event_ts") -> DataFrame:
    """Half-open time range. On a month-partitioned table the implied month
    predicate is added too, since only that one prunes directories."""
    out = df.where((F.col(ts) >= F.lit(start).cast("timestamp_ntz")) & (F.col(ts) < F.lit(end).cast("timestamp_ntz")))
    if "event_month" in df.columns:
        out = out.where(F.col("event_month").between(start[:7], end[:7]))
    return out

