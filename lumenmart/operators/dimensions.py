"""Dimension builders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenmart.functions import clean_name, date_key, json_field, surrogate_key

# Institutions with a proper name; all others are numbered.
NAMED_UNIVERSITIES = {1: ("Universidade Federal de Viçosa", "UFV")}
UNIVERSITY_STATE = "MG"


def _calendar(days: DataFrame, term_months: tuple[int, ...] | None) -> DataFrame:
    d = F.col("full_date")
    iso_dow = F.weekday(d) + 1
    in_term = F.lit(True) if term_months is None else F.month(d).isin(*term_months)
    return days.select(
        date_key("full_date").alias("date_sk"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.extract(F.lit("YEAROFWEEK"), d).cast("int").alias("iso_year"),
        F.weekofyear(d).alias("week_of_year"),
        iso_dow.alias("day_of_week"),
        (iso_dow >= 6).alias("is_weekend"),
        in_term.alias("is_academic_term"),
    )


def dim_date(spark: SparkSession, start: str, end: str, term_months: tuple[int, ...] | None = None) -> DataFrame:
    """Daily calendar between two fixed dates, both included."""
    days = F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("full_date")
    return _calendar(spark.range(1).select(days), term_months)


def dim_date_for(events: DataFrame, ts: str = "event_ts", term_months: tuple[int, ...] | None = None) -> DataFrame:
    """Daily calendar over the whole years that the events cover."""
    span = events.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi"))
    first, last = F.trunc(F.to_date("lo"), "year"), F.add_months(F.trunc(F.to_date("hi"), "year"), 12)
    days = F.explode(F.sequence(first, F.date_sub(last, 1))).alias("full_date")
    return _calendar(span.select(days), term_months)


def dim_academic_periods(calendar: DataFrame) -> DataFrame:
    """Two terms per calendar year: January to June, July to December."""
    semester = F.when(F.col("month") <= 6, 1).otherwise(2)
    terms = calendar.select("year", semester.alias("semester")).distinct()
    label = F.concat_ws(".", F.col("year").cast("string"), F.col("semester").cast("string"))
    return terms.select(surrogate_key(label).alias("period_sk"), label.alias("academic_period"), "year", "semester")


def dim_courses(disciplines: DataFrame) -> DataFrame:
    return disciplines.select(surrogate_key("discipline_id").alias("course_sk"), "*")


def dim_universities(users: DataFrame) -> DataFrame:
    uid = F.col("university_id")
    name: Column = F.concat(F.lit("Universidade "), uid.cast("string"))
    acronym: Column = F.concat(F.lit("UNI"), uid.cast("string"))
    for known, (long, short) in NAMED_UNIVERSITIES.items():
        name = F.when(uid == known, long).otherwise(name)
        acronym = F.when(uid == known, short).otherwise(acronym)
    return (
        users.select("university_id")
        .distinct()
        .select(
            surrogate_key(uid).alias("university_sk"),
            uid,
            name.alias("name"),
            acronym.alias("acronym"),
            F.lit(UNIVERSITY_STATE).alias("state"),
        )
    )


def dim_screens(events: DataFrame) -> DataFrame:
    """One row per screen; a screen seen in several categories keeps the first by name."""
    screens = (
        events.where(F.col("screen_name").isNotNull())
        .groupBy("screen_name")
        .agg(F.min("category").alias("feature_key"))
    )
    route = F.concat(F.lit("/"), F.replace(F.col("screen_name"), F.lit("_"), F.lit("/")))
    return screens.select(
        surrogate_key("screen_name").alias("screen_sk"), "screen_name", "feature_key", route.alias("route_path")
    )


def professor_aliases(events: DataFrame) -> DataFrame:
    """One row per spelling of a professor's name, with the name it cleans to.

    The spellings stay rows: gathering them into one array per professor would
    put an unbounded group into one task.
    """
    raw = json_field("payload_json", "docente")
    # The null name is dropped after the aggregate, so the payload is read once per row.
    spellings = events.groupBy(raw.alias("original_docente_string")).agg(F.count(raw).alias("n")).where("n > 0").drop("n")
    clean = clean_name("original_docente_string")
    return spellings.select(
        surrogate_key(clean).alias("professor_sk"),
        clean.alias("docente_name_clean"),
        "original_docente_string",
        F.to_json(F.array("original_docente_string")).alias("raw_name_variations_json"),
    )


def dim_professors(events: DataFrame) -> DataFrame:
    """One row per cleaned name (the alias rows are in `professor_aliases`)."""
    return professors_of(professor_aliases(events))


def professors_of(aliases: DataFrame) -> DataFrame:
    return (
        aliases.groupBy("professor_sk", "docente_name_clean")
        .agg(
            F.min("original_docente_string").alias("original_docente_string"),
            F.count("*").alias("name_variations"),
        )
    )


def resolve_professors(professors: DataFrame) -> DataFrame:
    """Fuzzy resolution: each name maps to the smallest name within one edit
    (Levenshtein distance of the lower-cased names at most 1).

    No pairs are compared. Each name emits the forms it has without its i-th
    letter. Names that differ in letter i only share the form (i, rest), so a
    minimum per such form finds the smallest. A name with one letter more than
    another has the other's full text among its forms: there the full name
    sees the smallest longer one, and the longer ones see the full name. That is
    2 * length + 1 rows per distinct name, reduced on the map side.
    """
    name = F.col("docente_name_clean")
    folded = F.lower(name)

    def without(i: Column) -> Column:
        return F.concat(F.substring(folded, F.lit(1), i - 1), F.substring(folded, i + 1, F.length(folded)))

    letters = F.sequence(F.lit(1), F.greatest(F.length(folded), F.lit(1)))
    same_length = F.transform(letters, lambda i: F.struct(i.alias("at"), without(i).alias("form")))
    shorter = F.transform(letters, lambda i: F.struct(F.lit(0).alias("at"), without(i).alias("form")))
    full = F.array(F.struct(F.lit(-1).alias("at"), folded.alias("form")))
    emitted = professors.select(name, F.explode(F.concat(same_length, F.array_distinct(shorter), full)).alias("f"))
    emitted = emitted.select("docente_name_clean", "f.at", "f.form")

    # at > 0: same length; at = 0 and -1: shorter forms and full names, compared with each other.
    group = F.greatest("at", F.lit(0))
    best = emitted.groupBy(group.alias("grp"), "form").agg(
        F.min(F.when(F.col("at") >= 0, name)).alias("cut_name"), F.min(F.when(F.col("at") == -1, name)).alias("full_name")
    )
    found = emitted.withColumn("grp", group).join(best, ["grp", "form"])
    candidate = F.when(F.col("at") == 0, F.col("full_name")).otherwise(F.least("cut_name", "full_name"))
    resolved = found.groupBy("docente_name_clean").agg(F.min(F.least(name, candidate)).alias("resolved_name"))
    return resolved.select(
        surrogate_key("docente_name_clean").alias("professor_sk"),
        "docente_name_clean",
        "resolved_name",
        surrogate_key("resolved_name").alias("resolved_sk"),
    )


def dim_users(versions: DataFrame) -> DataFrame:
    """User dimension from the version table (see operators.history)."""
    return versions.select(
        surrogate_key("scd_id").alias("user_sk"),
        "user_id",
        surrogate_key("university_id").alias("university_sk"),
        surrogate_key("course_id").alias("course_sk"),
        "role",
        "registration_date",
        "status",
        "valid_from",
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )
