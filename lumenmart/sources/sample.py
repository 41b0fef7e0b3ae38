"""Canonical inputs derived from the sample tables (events, customer, part, ...).

Only this module knows the sample layout. Every canonical table grows with the
sample tables: one event row per `events` row, one user per `customer` row, one
discipline per `part` row, one user change per signup event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenmart.functions import surrogate_key
from lumenmart.sources.catalog import event_catalog

# Fixed values of the mapping.
EVENT_NAMES = {
    "view": ("screen_viewed", "search_performed", "screen_viewed", "tab_changed", "notification_opened"),
    "click": ("search_result_opened", "material_downloaded", "search_abandoned", "planning_session_started", "admin_action_performed"),
    "purchase": ("discipline_rated", "professor_rated", "material_uploaded", "planning_session_completed", "item_favorited"),
    "signup": ("user_registered", "login_succeeded", "app_opened", "notification_sent"),
    "error": ("api_error_occurred", "frontend_error_occurred", "upload_failed", "login_failed", "validation_error_occurred"),
}
FIRST_NAMES = ("Ana", "Bruno", "Carla", "Diego", "Elisa", "Fabio", "Gilda", "Heitor", "Irene", "Jorge")
LAST_NAMES = ("Almeida", "Barros", "Cardoso", "Duarte", "Esteves", "Farias", "Gomes", "Hollanda", "Ibarra", "Junqueira")
PLATFORMS = ("web", "mobile_ios", "mobile_android")
APP_VERSIONS = ("1.0.0", "1.1.0", "1.2.0")
ADMIN_ACTIONS = ("content_removed", "user_role_changed", "content_approved")


def _pick(values: tuple[str, ...], index: str) -> str:
    """SQL text: the value at a zero-based index."""
    return f"element_at(array({', '.join(repr(v) for v in values)}), cast({index} as int) + 1)"


# Stating the schemas saves a footer read per query.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
}


class SampleSource:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def events(self) -> DataFrame:
        return self.table("events")

    def analytics_events(self, events: DataFrame | None = None) -> DataFrame:
        """Landing rows of the telemetry log; takes a stream as well."""
        e = self.events() if events is None else events
        names = " ".join(f"WHEN '{kind}' THEN {_pick(v, f'k % {len(v)}')}" for kind, v in EVENT_NAMES.items())
        # One user in five writes the first name with one letter too many, and
        # there are three ways of spacing a name.
        first = f"concat({_pick(FIRST_NAMES, 'k div 10 % 10')}, if(user_id % 5 = 4, 'h', ''))"
        last = _pick(LAST_NAMES, "k % 10")
        teacher = (
            f"CASE user_id % 3 WHEN 0 THEN concat('Prof. ', {first}, ' ', {last}) "
            f"WHEN 1 THEN concat('  Prof.  ', {first}, '   ', {last}, ' ') "
            f"ELSE concat('Prof. ', {first}, '  ', {last}) END"
        )
        payload = f"""concat(
            '{{"k": ', k,
            ', "course_id": ', k,
            ', "academic_period": "', year(ts), if(month(ts) <= 6, '.1', '.2'),
            '", "dificuldade": ', k % 5 + 1,
            if(k % 10 = 9, '', concat(', "esforco": ', k div 5 % 5 + 1)),
            ', "passou": ', if(k % 7 = 0, 'false', 'true'),
            ', "result_count": ', k % 6,
            ', "latency_ms": ', cast(floor(value * 10) as bigint),
            ', "action_type": "', {_pick(ADMIN_ACTIONS, "k % 3")}, '"',
            if(k % 13 = 12, '', concat(', "docente": "', {teacher}, '"')),
            '}}')"""
        catalog = F.broadcast(event_catalog(self.spark))
        day = "year(ts) * 10000 + month(ts) * 100 + day(ts)"
        return (
            e.withColumn("k", F.expr("cast(get_json_object(props, '$.k') as int)"))
            .withColumn("event_name", F.expr(f"CASE event_type {names} END"))
            .join(catalog, "event_name", "left")
            .selectExpr(
                "cast(event_id as string) AS id",
                "event_name",
                "category",
                "priority",
                "schema_version",
                f"concat_ws('-', user_id, {day}, if(hour(ts) < 12, 'a', 'p')) AS session_id",
                "user_id",
                f"{_pick(PLATFORMS, 'k % 3')} AS platform",
                f"{_pick(APP_VERSIONS, 'k % 3')} AS app_version",
                "if(k % 11 <> 10, concat_ws('_', lower(category), k % 7), null) AS screen_name",
                "ts AS timestamp",
                f"{payload} AS payload",
                "timestampadd(SECOND, if(k >= 95, k + 2 * 86400, k), ts) AS created_at",
            )
        )

    def deliveries(self) -> DataFrame:
        """Landing rows as a client with retries sends them: late rows arrive twice."""
        events = self.analytics_events()
        late = events.where(F.timestamp_diff("DAY", "timestamp", "created_at") >= 2)
        return events.unionByName(late)

    def event_records(self) -> DataFrame:
        """Event file records: ISO text time, gaps to be filled, some broken payloads."""
        k = F.get_json_object("payload", "$.k").cast("int")
        stamp = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        none = F.lit(None).cast("string")
        return self.analytics_events().select(
            F.col("id").alias("event_id"),
            "event_name",
            none.alias("category"),
            none.alias("priority"),
            F.when(k % 4 != 3, F.col("schema_version")).alias("schema_version"),
            "session_id",
            F.when(k % 9 != 8, F.col("user_id")).alias("user_id"),
            F.when(k % 5 != 4, F.col("platform")).alias("platform"),
            F.when(k % 6 != 5, F.col("app_version")).alias("app_version"),
            "screen_name",
            # Half of the clients write Z, the others an offset of two hours.
            F.when(k % 2 == 0, F.concat(stamp, F.lit("Z"))).otherwise(F.concat(stamp, F.lit("+02:00"))).alias("event_ts"),
            F.when(k % 10 == 9, F.lit('{"k": ')).otherwise(F.col("payload")).alias("payload_json"),
        )

    def operational_users(self) -> DataFrame:
        """User rows as the application stores them, personal columns included."""
        key = F.col("c_custkey")
        created = F.date_add(F.lit("2023-12-25").cast("date"), (key % 20).cast("int")).cast("timestamp_ntz")
        return self.table("customer").select(
            key.alias("id"),
            F.col("c_name").alias("nome"),
            F.when(key % 30 != 29, created).alias("created_at"),
            F.when(key % 10 != 0, "inativo").alias("status"),
        )

    def operational_enrolments(self) -> DataFrame:
        """Enrolments; one user in five has neither an institution nor a course yet."""
        key = F.col("c_custkey")
        enrolled = key % 5 != 4
        return self.table("customer").select(
            key.alias("usuario_id"),
            F.when(enrolled, F.col("c_nationkey")).alias("faculdade_id"),
            F.when(enrolled, key % 100).alias("curso_id"),
        )

    def operational_disciplines(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.table("part").select(
            key.alias("id"),
            F.when(key % 3 == 0, "").otherwise(F.col("p_brand")).alias("codigo"),
            F.when(key % 4 != 0, F.col("p_name")).alias("nome"),
            F.when(key % 5 != 0, F.col("p_size") * 10).alias("carga_horaria"),
        )

    def usuarios(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.table("customer").select(
            key.alias("id_usuario"),
            F.col("c_nationkey").cast("bigint").alias("id_universidade"),
            F.when(key % 7 != 6, key % 100).alias("id_curso"),
            F.when(F.col("c_mktsegment") == "MACHINERY", "Coordenador")
            .when(F.col("c_mktsegment") == "BUILDING", "Admin")
            .otherwise("Aluno")
            .alias("perfil"),
            F.date_add(F.lit("2023-12-25").cast("date"), (key % 20).cast("int")).alias("data_cadastro"),
            F.when(key % 10 == 0, "inativo").when(key % 10 == 1, "pendente").otherwise("ativo").alias("status"),
        )

    def curriculo_disciplinas(self) -> DataFrame:
        return self.table("part").selectExpr(
            "p_partkey AS id_disciplina",
            "concat('DISC', p_partkey) AS codigo_disciplina",
            "p_name AS nome_disciplina",
            "cast(p_partkey % 4 + 2 as int) AS creditos",
            "cast((p_partkey % 4 + 2) * 15 as int) AS ch_total",
        )

    def user_changes(self) -> DataFrame:
        """Profile as reported by each signup event: (user_id, changed_at, seq, role, status)."""
        k = F.get_json_object("props", "$.k").cast("int")
        return (
            self.events()
            .where(F.col("event_type") == "signup")
            .select(
                "user_id",
                F.col("ts").alias("changed_at"),
                F.col("event_id").alias("seq"),
                F.when(k % 4 == 3, "Coordenador").otherwise("Aluno").alias("role"),
                F.when(k % 10 == 9, "pendente").otherwise("ativo").alias("status"),
            )
        )

    def pipeline_runs(self) -> DataFrame:
        """One load run per day of events, split into its three stages."""
        runs = self.events().groupBy(F.to_date("ts").alias("d")).agg(F.count("*").alias("n"))
        stages = runs.selectExpr(
            "d",
            "n",
            "stack(3, 'extract', 0, n % 90, 'transform', 1, n % 170, 'quality', 2, n % 50) AS (stage, pos, centis)",
        )
        timed = stages.selectExpr(
            "*",
            "concat_ws('-', 'run', year(d) * 10000 + month(d) * 100 + day(d), stage) AS run_id",
            "timestampadd(MINUTE, 60 + pos, cast(d as timestamp_ntz)) AS start_time",
            "day(d) % 7 = 0 AS failed",
        )
        return timed.select(
            surrogate_key("run_id").alias("run_sk"),
            "run_id",
            F.lit("load_events").alias("dag_id"),
            F.lit("sample").alias("lane"),
            "stage",
            "start_time",
            F.expr("timestampadd(MICROSECOND, centis * 10000, start_time)").alias("end_time"),
            F.expr("cast(cast(centis as decimal(10,2)) / 100 as decimal(10,2))").alias("duration_seconds"),
            F.col("n").alias("rows_extracted"),
            F.expr("if(failed, 0L, n)").alias("rows_loaded"),
            F.expr("if(failed, 'FAILED', 'SUCCESS')").alias("status"),
            F.expr("if(failed, 'load stopped', null)").alias("error_message"),
        )
