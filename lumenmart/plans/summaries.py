"""Metrics from stored summaries: bitmaps of active days, sketches of users and of values.

Columns are those of the metrics over detail rows (see `metrics` and `marts`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenmart.functions import key_to_date, ratio
from lumenmart.operators import sketches
from lumenmart.operators.bitmaps import active_between, active_on, last_active, words_of_users
from lumenmart.operators.facts import hits, is_known
from lumenmart.operators.ranking import trailing_actives
from lumenmart.plans.marts import user_days

OFFSETS = (1, 7, 14, 30)


def _registered(blocks: DataFrame, dim_users: DataFrame) -> DataFrame:
    words = words_of_users(blocks, "user_sk")
    return dim_users.select("user_sk", F.col("registration_date").alias("cohort_date")).join(words, "user_sk", "left")


def retention_rates(blocks: DataFrame, dim_users: DataFrame) -> DataFrame:
    """Users active n days after registration."""
    on = [hits(active_on(F.col("words"), F.date_add("cohort_date", n))).alias(f"d{n}_active_users") for n in OFFSETS]
    days = _registered(blocks, dim_users).groupBy("cohort_date").agg(F.count("*").alias("cohort_size"), *on)
    return days.select("*", *[ratio(f"d{n}_active_users", "cohort_size").alias(f"d{n}_retention_rate") for n in OFFSETS])


def rolling_retention(blocks: DataFrame, dim_users: DataFrame) -> DataFrame:
    """Users active n or more days after registration."""
    users = _registered(blocks, dim_users).withColumn("last_day", last_active(F.col("words")))
    from_then = [hits(F.col("last_day") >= F.date_add("cohort_date", n)).alias(f"d{n}_rolling_users") for n in OFFSETS]
    days = users.groupBy("cohort_date").agg(F.count("*").alias("cohort_size"), *from_then)
    return days.select("*", *[ratio(f"d{n}_rolling_users", "cohort_size").alias(f"d{n}_rolling_rate") for n in OFFSETS])


def dormant_users(blocks: DataFrame, windows: tuple[int, ...] = (7, 30)) -> DataFrame:
    """Users active before, but not within, the trailing window of the last day."""
    last = words_of_users(blocks, "user_sk").select(last_active(F.col("words")).alias("last_day"))
    as_of = last.agg(F.max("last_day")).scalar()
    counted = last.groupBy(as_of.alias("as_of")).agg(*[hits(F.col("last_day") <= F.date_sub(as_of, n)).alias(f"w{n}") for n in windows])
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("window_days"), F.col(f"w{n}").alias("dormant_users")) for n in windows]))
    return counted.select("as_of", rows.alias("r")).select("as_of", "r.*")


def cohort_week_matrix(blocks: DataFrame, dim_users: DataFrame) -> DataFrame:
    """Registration week, weeks since registration, active users: a cell looks at the seven bits of a user's week."""
    week = F.to_date(F.date_trunc("week", "cohort_date"))
    users = _registered(blocks, dim_users).withColumn("cohort_week", week)
    sizes = users.groupBy("cohort_week").agg(F.count("*").alias("cohort_size"))
    start, last = F.unix_date("cohort_date"), F.unix_date(last_active(F.col("words")))
    lived = users.where(last >= start).withColumn("week_number", F.explode(F.sequence(F.lit(0), F.floor((last - start) / 7).cast("int"))))
    first = F.unix_date("cohort_date") + 7 * F.col("week_number")
    active = lived.where(active_between(F.col("words"), first, first + 6)).groupBy("cohort_week", "week_number").agg(F.count("*").alias("active_users"))
    rate = ratio("active_users", "cohort_size").alias("retention_rate")
    return active.join(sizes, "cohort_week").select("cohort_week", "week_number", "cohort_size", "active_users", rate)


# --- sketches ----------------------------------------------------------------------


def activity_sketches(events: DataFrame, dim_users: DataFrame) -> DataFrame:
    """One sketch of users per day, platform and institution."""
    known = events.where(is_known("user_sk")).select(key_to_date("event_date_sk").alias("activity_date"), "user_sk", "platform")
    users = dim_users.select("user_sk", "university_sk")
    return sketches.user_sketches(known.join(users, "user_sk", "left"), "activity_date", "user_sk", "platform", "university_sk")


def estimated_actives(stored: DataFrame, platform: str | None = None, university_sk: int | None = None) -> DataFrame:
    """Estimated `wau` and `mau` per day, of a platform or an institution as well, from the sketches alone."""
    for column, value in (("platform", platform), ("university_sk", university_sk)):
        if value is not None:
            stored = stored.where(F.col(column) == value)
    return sketches.trailing_estimates(stored, "activity_date", {"wau": 7, "mau": 30})


def checked_actives(events: DataFrame, stored: DataFrame, platform: str | None = None) -> DataFrame:
    """Exact actives per day and whether the estimates keep to their bound."""
    rows = events if platform is None else events.where(F.col("platform") == platform)
    days = rows.where(is_known("user_sk")).select("user_sk", key_to_date("event_date_sk").alias("activity_date")).distinct()
    exact = trailing_actives(days, "user_sk", "activity_date", {"wau": 7, "mau": 30})
    about = estimated_actives(stored, platform).withColumnsRenamed({"wau": "about_wau", "mau": "about_mau"})
    close = [sketches.users_close(F.col(f"about_{c}"), F.col(c)).alias(f"{c}_close") for c in ("wau", "mau")]
    return exact.join(about, "activity_date", "left").select("activity_date", F.lit(platform or "all").alias("platform"), "wau", "mau", *close)


def duration_sketches(sessions: DataFrame) -> DataFrame:
    """One sketch of session durations per start day."""
    return sketches.value_sketches(
        sessions.withColumn("activity_date", key_to_date("session_start_date_sk")), "session_duration_seconds", "activity_date"
    )


def weekly_durations(stored: DataFrame) -> DataFrame:
    """Estimated median and 90th percentile of a week's sessions, from the sketches of its days."""
    week = F.to_date(F.date_trunc("week", "activity_date")).alias("week")
    weeks = sketches.merged_values(stored, week)
    return weeks.select("week", F.col("n").alias("sessions"), sketches.quantile(0.5).alias("p50"), sketches.quantile(0.9).alias("p90"))


def checked_durations(sessions: DataFrame, stored: DataFrame) -> DataFrame:
    """Weeks with their sessions, and whether the estimated percentiles stand at their ranks but for the bound."""
    about = weekly_durations(stored)
    rows = sessions.select(F.to_date(F.date_trunc("week", key_to_date("session_start_date_sk"))).alias("week"), "session_duration_seconds")
    value = F.col("session_duration_seconds")
    counted = rows.join(about, "week").groupBy("week", "sessions")
    ranks = counted.agg(*(f.alias(name) for p in ("p50", "p90") for f, name in ((hits(value < F.col(p)), f"{p}_below"), (hits(value <= F.col(p)), f"{p}_to"))))
    close = [sketches.rank_close(F.col(f"{c}_below"), F.col(f"{c}_to"), F.col("sessions"), p).alias(f"{c}_close") for c, p in (("p50", 0.5), ("p90", 0.9))]
    return ranks.select("week", "sessions", *close)


def active_days(daily: DataFrame) -> DataFrame:
    return user_days(daily).select("user_sk", "activity_date")
