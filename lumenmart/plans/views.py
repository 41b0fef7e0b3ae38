"""Names for SQL users: staging as views, everything else as views or tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from lumenmart.plans.loader import MARTS
from lumenmart.plans.star import TABLES, Star

STAGING = ("stg_events", "stg_users", "stg_disciplines")


def relations(star: Star) -> dict[str, Callable[[], DataFrame]]:
    """Builders of every named relation of a star."""
    out: dict[str, Callable[[], DataFrame]] = {n: (lambda n=n: getattr(star, n)) for n in (*STAGING, *TABLES)}
    out["fct_pipeline_runs"] = lambda: star.pipeline_runs
    out.update({n: (lambda build=build: build(star)) for n, build in MARTS.items()})
    return out


def publish_views(star: Star, *names: str) -> None:
    """Temporary views (all, or the named ones), for dashboards that send SQL."""
    for name, build in relations(star).items():
        if not names or name in names:
            build().createOrReplaceTempView(name)


def save_tables(star: Star, database: str, *names: str, location: str | None = None) -> None:
    """Marts, dimensions and facts as tables of a database; staging stays a view."""
    at = f" LOCATION '{location}'" if location else ""
    star.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{at}")
    for name, build in relations(star).items():
        if name not in STAGING and (not names or name in names):
            build().write.mode("overwrite").saveAsTable(f"{database}.{name}")
