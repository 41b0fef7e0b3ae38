from lumenmart.plans import views, workloads
from lumenmart.plans.registry import QUERIES


def test_cards_as_sql_text(spark, star):
    """The dashboards' SQL runs as it is on the published views."""
    views.publish_views(star, "mrt_engagement", "mrt_product", "mrt_quality", "fct_pipeline_runs")
    for name in ("card_north_star", "card_feature_usage", "card_errors"):
        mart, columns, order, down = workloads.CARDS[name]
        sql = f"SELECT {', '.join(columns)} FROM {mart} ORDER BY {order} {'DESC' if down else 'ASC'}"
        got = spark.sql(sql).collect()
        assert got == QUERIES[name](star).collect() and len(got) > 0
    assert spark.sql("SELECT count(*) FROM fct_pipeline_runs WHERE status = 'FAILED'").first()[0] > 0


def test_all_relations_have_names(star):
    names = set(views.relations(star))
    assert {"stg_events", "dim_users", "fct_sessions", "mrt_monetization_readiness", "fct_pipeline_runs"} <= names
    assert len(names) == 3 + 11 + 1 + 9


def test_saved_tables(spark, star, tmp_path):
    views.save_tables(star, "metrics_db", "mrt_quality", "dim_universities", location=str(tmp_path / "db"))
    assert spark.table("metrics_db.mrt_quality").count() == 30
    assert {t.name for t in spark.catalog.listTables("metrics_db") if not t.isTemporary} == {"mrt_quality", "dim_universities"}
    spark.sql("DROP DATABASE metrics_db CASCADE")
