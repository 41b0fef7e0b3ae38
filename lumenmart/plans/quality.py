"""Data quality. Each check says how many rows fail; none means it passed.

The suite reads every table once per kind of check, not once per check: row
rules share one aggregate per table, and all key and reference checks share
one shuffle of distinct (check, key) pairs, counted on the map side, so a key
that fills a third of a table travels as one row per task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenmart.functions import UNKNOWN_SK
from lumenmart.operators.facts import hits
from lumenmart.plans.star import Star
from lumenmart.sources import contract as C
from lumenmart.sources.catalog import EVENTS, event_catalog, payload_fields, required_fields

NOT_NULL = {
    "stg_events": ("raw_event_id", "category", "priority", "platform"),
    "stg_users": ("user_id",),
    "fct_events": ("event_sk", "event_date_sk", "user_sk", "category", "platform"),
    "fct_daily_user_activity": ("daily_activity_sk", "date_sk", "user_sk", "university_sk"),
    "fct_ratings": ("rating_sk", "date_sk", "user_sk", "course_sk", "period_sk"),
    "fct_sessions": ("session_sk", "session_start_date_sk", "user_sk"),
    "dim_users": ("user_sk", "role", "status"),
    "dim_professors": ("professor_sk",),
    "dim_courses": ("course_sk",),
    "dim_universities": ("university_sk",),
    "dim_academic_periods": ("period_sk",),
    "dim_date": ("date_sk",),
    "dim_screens": ("screen_sk",),
}

UNIQUE = {
    "stg_events": "raw_event_id",
    "stg_users": "user_id",
    "fct_events": "event_sk",
    "fct_daily_user_activity": "daily_activity_sk",
    "fct_ratings": "rating_sk",
    "fct_sessions": "session_sk",
    "dim_users": "user_sk",
    "dim_professors": "professor_sk",
    "dim_courses": "course_sk",
    "dim_universities": "university_sk",
    "dim_academic_periods": "period_sk",
    "dim_date": "date_sk",
    "dim_screens": "screen_sk",
}

ACCEPTED = {
    ("fct_events", "category"): C.CATEGORIES,
    ("fct_events", "platform"): C.PLATFORM_GROUPS,
    ("fct_events", "platform_group"): C.PLATFORM_GROUPS,
    ("stg_events", "priority"): C.PRIORITIES,
    ("stg_events", "platform"): C.PLATFORM_GROUPS,
    ("stg_events", "platform_group"): C.PLATFORM_GROUPS,
    ("dim_users", "role"): C.ROLES,
    ("dim_users", "status"): C.STATUSES,
}

FOREIGN_KEYS = {
    "fct_events": {
        "event_date_sk": "dim_date.date_sk",
        "user_sk": "dim_users.user_sk",
        "screen_sk": "dim_screens.screen_sk",
        "course_sk": "dim_courses.course_sk",
        "professor_sk": "dim_professors.professor_sk",
        "period_sk": "dim_academic_periods.period_sk",
    },
    "fct_daily_user_activity": {
        "date_sk": "dim_date.date_sk",
        "user_sk": "dim_users.user_sk",
        "university_sk": "dim_universities.university_sk",
    },
    "fct_ratings": {
        "date_sk": "dim_date.date_sk",
        "user_sk": "dim_users.user_sk",
        "course_sk": "dim_courses.course_sk",
        "professor_sk": "dim_professors.professor_sk",
        "period_sk": "dim_academic_periods.period_sk",
    },
    "fct_sessions": {
        "session_start_date_sk": "dim_date.date_sk",
        "user_sk": "dim_users.user_sk",
    },
}


def platform_group(c: str) -> Column:
    """web / mobile, from the client's platform name."""
    return F.when(F.col(c).startswith("mobile"), "mobile").otherwise(F.col(c))


# --- single checks: the failing rows -----------------------------------------


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def repeated_keys(df: DataFrame, column: str) -> DataFrame:
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("occurrence_count"))
    return counts.where(F.col("occurrence_count") > 1)


def unaccepted_rows(df: DataFrame, column: str, accepted: tuple[str, ...]) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(*accepted))


def orphan_keys(fact: DataFrame, fk: str, dim: DataFrame, key: str) -> DataFrame:
    """Foreign keys without a dimension row, with the number of rows that use them."""
    used = fact.where(F.col(fk).isNotNull() & (F.col(fk) != UNKNOWN_SK)).groupBy(fk).agg(F.count("*").alias("rows"))
    return used.join(dim.select(F.col(key).alias(fk)), fk, "left_anti")


def future_events(events: DataFrame, as_of: str) -> DataFrame:
    limit = F.timestamp_add("MINUTE", F.lit(5), F.lit(as_of).cast("timestamp_ntz"))
    return events.where(F.col("event_ts") > limit).select("event_id", "event_name", "event_ts")


def invalid_scores(ratings: DataFrame) -> DataFrame:
    bad = ~F.col("dificuldade").between(1, 5) | ~F.col("esforco").between(1, 5)
    return ratings.where(bad).select("rating_id", "dificuldade", "esforco")


def negative_sessions(sessions: DataFrame) -> DataFrame:
    return sessions.where(F.col("session_duration_seconds") < 0).select("session_id", "session_duration_seconds")


def metric_bounds(engagement: DataFrame, content: DataFrame) -> DataFrame:
    """Mart rows outside the possible range: stickiness in [0, 1], mean scores in [1, 5]."""
    sticky = engagement.where(~F.col("stickiness_dau_mau").between(0, 1)).select(
        F.lit("stickiness").alias("metric"), F.col("activity_date").alias("metric_date"), F.col("stickiness_dau_mau").alias("value")
    )
    out = sticky
    for c in ("avg_dificuldade", "avg_esforco"):
        bad = (F.col("total_ratings") > 0) & ~F.col(c).between(1, 5)
        out = out.unionByName(content.where(bad).select(F.lit(c).alias("metric"), "metric_date", F.col(c).alias("value")))
    return out


# --- the suite -----------------------------------------------------------------


def _row_rules(table: str, as_of: str) -> dict[str, str]:
    """check name -> SQL condition that a failing row meets."""
    rules = {f"not_null.{table}.{c}": f"{c} IS NULL" for c in NOT_NULL.get(table, ())}
    for (t, column), values in ACCEPTED.items():
        if t == table:
            value = "if(platform LIKE 'mobile%', 'mobile', platform)" if column == "platform_group" else column
            rules[f"accepted_values.{table}.{column}"] = f"{value} NOT IN ({', '.join(repr(v) for v in values)})"
    if table == "fct_events":
        rules["event_not_in_future"] = f"event_ts > timestamp_ntz'{as_of}' + INTERVAL 5 MINUTES"
    if table == "fct_ratings":
        rules["rating_scores_in_range"] = "dificuldade NOT BETWEEN 1 AND 5 OR esforco NOT BETWEEN 1 AND 5"
    if table == "fct_sessions":
        rules["session_duration_not_negative"] = "session_duration_seconds < 0"
    return rules


def _row_failures(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """(check, failures) of all row rules of a table, in one pass."""
    sums = df.selectExpr(*[f"count_if({cond}) AS c{i}" for i, cond in enumerate(rules.values())])
    cells = ", ".join(f"'{check}', c{i}" for i, check in enumerate(rules))
    return sums.selectExpr(f"stack({len(rules)}, {cells}) AS (check, failures)")


def _pairs(df: DataFrame, columns: dict[int, str], key_type: str) -> DataFrame:
    """(check number, key) rows for several key columns, read in one pass."""
    cells = ", ".join(f"{n}, cast({c} as {key_type})" for n, c in columns.items())
    return df.selectExpr(f"stack({len(columns)}, {cells}) AS (n, key)").where("key IS NOT NULL")


def _named(counts: DataFrame, names: list[str]) -> DataFrame:
    """(check number, failures) to (check, failures), also for checks without any key."""
    rows = ", ".join(f"({i}, '{name}')" for i, name in enumerate(names))
    every = counts.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS t(n, check)")
    return every.join(counts, "n", "left").selectExpr("check", "coalesce(failures, 0L) AS failures")


def _members(keys: DataFrame) -> DataFrame:
    """(check number, key) pairs of (checks, key) rows, dealt out first: a dimension
    may be one file, and its pairs would be counted in one task."""
    return keys.repartition("key").select(F.explode("checks").alias("n"), "key")


def _orphans(used: DataFrame, members: DataFrame) -> DataFrame:
    """(check number, failures): rows of `used` pairs that are no `members`.

    Both go through one aggregate. Spark would push a join below the counting and
    broadcast the members, every user several times, into each task's memory.
    """
    used = used.where(F.col("key") != UNKNOWN_SK).select("n", "key", F.lit(1).alias("uses"))
    both = used.unionByName(members.select("n", "key", F.lit(0).alias("uses"))).groupBy("n", "key")
    counted = both.agg(F.sum("uses").alias("rows"), F.min("uses").alias("least"))
    return counted.where("least > 0").groupBy("n").agg(F.sum("rows").alias("failures"))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def dq_suite(star: Star, as_of: str) -> DataFrame:
    """(check, failures) for every declared check."""
    rule_rows = [_row_failures(getattr(star, table), _row_rules(table, as_of)) for table in NOT_NULL]

    names: list[str] = []
    keys: dict[str, list[DataFrame]] = {"bigint": [], "string": []}
    for table, key in [*UNIQUE.items(), ("fct_events", "event_id")]:
        kind = "string" if key.endswith("event_id") else "bigint"
        keys[kind].append(_pairs(getattr(star, table), {len(names): key}, kind))
        names.append("event_id_not_repeated" if key == "event_id" else f"unique.{table}.{key}")
    repeated = [
        _union(frames).groupBy("n", "key").agg(F.count("*").alias("rows")).groupBy("n").agg(F.expr("count_if(rows > 1) AS failures"))
        for frames in keys.values()
    ]
    unique = _named(_union(repeated), names)

    links = [(table, fk, *target.split(".")) for table, fks in FOREIGN_KEYS.items() for fk, target in fks.items()]
    number = {(table, fk): i for i, (table, fk, _, _) in enumerate(links)}
    used = [
        _pairs(getattr(star, table), {number[table, fk]: fk for fk in fks}, "bigint") for table, fks in FOREIGN_KEYS.items()
    ]
    members = [
        getattr(star, dim).select(
            F.array(*[F.lit(number[t, fk]) for t, fk, d, _ in links if d == dim]).alias("checks"), F.col(key).cast("bigint").alias("key")
        )
        for dim, key in sorted({(d, k) for _, _, d, k in links})
    ]
    relations = _named(_orphans(_union(used), _members(_union(members))), [f"relationships.{table}.{fk}" for table, fk, _, _ in links])
    return _union([*rule_rows, unique, relations])


class QualityError(RuntimeError):
    pass


def gate(results: DataFrame, warn_only: tuple[str, ...] = ()) -> list[tuple[str, int]]:
    """Raise when a blocking check fails; otherwise the failing warnings.

    The result has one row per declared check, so it is safe to collect.
    """
    failed = [(r["check"], r["failures"]) for r in results.where("failures > 0").orderBy("check").collect()]
    blocking = [f for f in failed if f[0] not in warn_only]
    if blocking:
        raise QualityError("; ".join(f"{c}: {n} rows" for c, n in blocking))
    return failed


# --- contracts -------------------------------------------------------------------


def check_contract(raw_events: DataFrame) -> DataFrame:
    """Landing rows with one boolean per contract rule and `is_valid`."""
    catalog = event_catalog(raw_events.sparkSession).select(
        "event_name", F.col("category").alias("_cat"), F.col("priority").alias("_pri")
    )
    payload = F.col("payload")
    needed = F.lit(None).cast("array<string>")
    for name, _, priority, _ in EVENTS:
        fields = required_fields(name)
        if priority in ("Critical", "High") and fields:
            needed = F.when(F.col("event_name") == name, F.array(*[F.lit(f) for f in fields])).otherwise(needed)
    present = F.json_object_keys(payload)
    rules = {
        "ok_event_id": F.col("id").rlike(C.UUID_PATTERN),
        "ok_event_name": F.col("event_name").rlike(C.EVENT_NAME_PATTERN),
        "ok_schema_version": F.coalesce(F.col("schema_version").try_cast("int") >= 1, F.lit(False)),
        "ok_session_id": F.col("session_id").rlike(C.UUID_PATTERN),
        "ok_platform": F.col("platform").isin(*C.CLIENT_PLATFORMS),
        "ok_app_version": F.col("app_version").rlike(C.SEMVER_PATTERN),
        "ok_known_event": F.col("_cat").isNotNull(),
        "ok_category": F.coalesce(F.col("category") == F.col("_cat"), F.lit(False)),
        "ok_priority": F.coalesce(F.col("priority") == F.col("_pri"), F.lit(False)),
        "ok_payload": F.coalesce(needed.isNull() | (F.size(F.array_except(needed, present)) == 0), F.lit(False)),
    }
    checked = raw_events.join(F.broadcast(catalog), "event_name", "left").withColumns(rules).drop("_cat", "_pri")
    valid = F.lit(True)
    for r in rules:
        valid = valid & F.coalesce(F.col(r), F.lit(False))
    return checked.withColumn("is_valid", valid)


CONTRACT_RULES = (
    "ok_event_id",
    "ok_event_name",
    "ok_schema_version",
    "ok_session_id",
    "ok_platform",
    "ok_app_version",
    "ok_known_event",
    "ok_category",
    "ok_priority",
    "ok_payload",
)


def contract_summary(checked: DataFrame) -> DataFrame:
    """Per event name: events, and the events that break each rule."""
    broken = [hits(~F.coalesce(F.col(r), F.lit(False))).alias(r.replace("ok_", "bad_")) for r in CONTRACT_RULES]
    return checked.groupBy("event_name").agg(F.count("*").alias("events"), *broken)


def split_quarantine(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    plain = [c for c in checked.columns if c not in CONTRACT_RULES and c != "is_valid"]
    return checked.where("is_valid").select(*plain), checked.where("NOT is_valid")


def schema_drift(raw_events: DataFrame) -> DataFrame:
    """Names seen in the data but unknown to the contract, with their row counts:
    columns, events, categories and payload fields. Missing columns count 0 rows."""
    spark = raw_events.sparkSession
    expected = set(C.ANALYTICS_EVENTS.fieldNames())
    have = set(raw_events.columns)
    out = []
    for kind, names in (("column_missing", expected - have), ("column_unknown", have - expected)):
        if names:
            rows = ", ".join(f"('{kind}', '{n}', 0L)" for n in sorted(names))
            out.append(spark.sql(f"SELECT * FROM VALUES {rows} AS t(kind, name, events)"))
    catalog = event_catalog(spark)
    used = raw_events.groupBy("event_name", "category").agg(F.count("*").alias("events"))
    for kind, column in (("event_unknown", "event_name"), ("category_unknown", "category")):
        known = F.broadcast(catalog.select(column).distinct())
        rows = used.join(known, column, "left_anti").groupBy(column).agg(F.sum("events").alias("events"))
        out.append(rows.select(F.lit(kind).alias("kind"), F.col(column).alias("name"), "events"))
    keys = raw_events.select("event_name", F.explode(F.json_object_keys("payload")).alias("field"))
    counted = keys.groupBy("event_name", "field").agg(F.count("*").alias("events"))
    known = F.broadcast(payload_fields(spark).select("event_name", "field"))
    fields = counted.join(known, ["event_name", "field"], "left_anti")
    out.append(
        fields.select(F.lit("field_unknown").alias("kind"), F.concat_ws(".", "event_name", "field").alias("name"), "events")
    )
    return _union(out)


# --- monitoring --------------------------------------------------------------------


def health_probe(star: Star, tables: tuple[str, ...]) -> DataFrame:
    """Row count per warehouse table."""
    return _union([getattr(star, t).agg(F.count("*").alias("row_count")).select(F.lit(t).alias("table_name"), "*") for t in tables])


@dataclass(frozen=True)
class Limits:
    error_rate: float = 0.015
    runtime_seconds: float = 900.0
    freshness_hours: int = 24


def breaches(quality: DataFrame, runs: DataFrame, events: DataFrame, as_of: str, limits: Limits = Limits()) -> DataFrame:
    """Threshold breaches: (alert, metric, subject, actual, limit_value)."""

    def rows(df: DataFrame, alert: str, metric: str, subject: Column, actual: Column, limit: float) -> DataFrame:
        return df.where(actual > limit).select(
            F.lit(alert).alias("alert"),
            F.lit(metric).alias("metric"),
            subject.cast("string").alias("subject"),
            actual.cast("double").alias("actual"),
            F.lit(float(limit)).alias("limit_value"),
        )

    age = events.agg(
        F.floor(F.timestamp_diff("SECOND", F.max("event_ts"), F.lit(as_of).cast("timestamp_ntz")) / 3600).alias("hours")
    )
    failed = runs.where(F.col("status") != "SUCCESS").select("run_id", F.lit(1).alias("failed"))
    return _union(
        [
            rows(quality, "SLA_BREACH", "api_error_rate", F.col("error_date"), F.col("api_error_rate"), limits.error_rate),
            rows(quality, "SLA_BREACH", "frontend_error_rate", F.col("error_date"), F.col("frontend_error_rate"), limits.error_rate),
            rows(runs, "SLA_BREACH", "duration_seconds", F.col("run_id"), F.col("duration_seconds"), limits.runtime_seconds),
            rows(age, "SLA_BREACH", "data_freshness_hours", F.lit("fct_events"), F.col("hours"), limits.freshness_hours),
            rows(failed, "PIPELINE_FAILURE", "failed_run", F.col("run_id"), F.col("failed"), 0),
        ]
    )


#: JSON types as Spark names them, by the six declared types.
_JSON_TYPES = {
    "integer": r"^(BIGINT|DECIMAL\([0-9]+,0\))$",
    "number": r"^(BIGINT|DECIMAL.*|DOUBLE|FLOAT)$",
    "boolean": "^BOOLEAN$",
    "string": "^STRING$",
    "array": "^ARRAY",
    "object": "^OBJECT",
}


def unknown_payload_types(raw_events: DataFrame) -> DataFrame:
    """Catalogued fields whose JSON type is not the declared one; JSON nulls are no values.

    A payload is parsed once, into its fields.
    """
    fields = F.broadcast(payload_fields(raw_events.sparkSession))
    parsed = raw_events.select("event_name", F.explode(F.from_json("payload", "map<string,variant>")).alias("field", "v"))
    typed = parsed.join(fields, ["event_name", "field"]).select("event_name", "field", "field_type", F.schema_of_variant("v").alias("found"))
    known = F.lit(False)
    for kind, pattern in _JSON_TYPES.items():
        known = known | ((F.col("field_type") == kind) & F.col("found").rlike(pattern))
    broken = typed.where(~known & (F.col("found") != "VOID"))
    return broken.groupBy("event_name", "field", "field_type").agg(F.count("*").alias("events"))
