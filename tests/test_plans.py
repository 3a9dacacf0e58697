"""Physical plans: shuffles, scans, pruning, and independence of partitioning."""

import pytest

from shelfwise.plans.context import Context
from shelfwise.sources import crosswalk, marts


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_panel_reads_only_needed_columns(spark, sf_dir):
    text = plan(crosswalk.raw_transactions(spark, sf_dir))
    assert "l_tax" not in text and "o_totalprice" not in text and "p_name" not in text


def test_panel_shuffles_lines_once_per_step_without_broadcast(spark, sf_dir):
    """With every side too large to broadcast, the per-order fold reuses the
    partitioning of the order join: two shuffles per join, one per later step."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(crosswalk.raw_transactions(spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("SortMergeJoin") == 3
    assert text.count("Exchange hashpartitioning") == 3 * 2 + 2


def test_year_filter_prunes_partitions(spark, sf_dir):
    fact = Context(spark, sf_dir).star.fact
    text = plan(fact.filter("year = 1996").select("spend"))
    assert "PartitionFilters: [isnotnull(year" in text
    assert "ReadSchema: struct<spend:decimal(18,4)>" in text


def test_stored_and_planned_star_agree(spark, sf_dir):
    stored, planned = marts.stored_star(spark, sf_dir), marts.planned_star(spark, sf_dir)
    for name in ("fact", "product", "store", "calendar"):
        a, b = getattr(stored, name), getattr(planned, name)
        assert a.columns == b.columns
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_same_result_for_any_partitioning(spark, sf_dir):
    from shelfwise.operators.star import Star
    from shelfwise.plans import customer, product

    star = Context(spark, sf_dir).star
    other = Star(star.fact.repartition(13, "promo_type"), star.product, star.store, star.calendar)
    for run in (
        lambda s: product.pareto(s.sales("product")),
        lambda s: customer.household_ratios(s.sales("product", "store")),
    ):
        a, b = run(star), run(other)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_views_answer_sql(spark, sf_dir):
    from shelfwise.operators.report import literal_rows
    from shelfwise.plans.views import VIEWS, create_views

    assert create_views(Context(spark, sf_dir).star) == list(VIEWS)
    assert spark.sql("SELECT count(*) FROM vw_weekly_summary").first()[0] > 0
    assert literal_rows(spark, [("a", 1), ("b", 2)], "k string, v int").count() == 2


def test_shared_folder_follows_the_session(spark):
    from shelfwise import session

    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = session.shared_dir(spark)
    assert folder == (named.rstrip("/") if named else session._OWN_DIRS[spark.sparkContext.applicationId])
    assert marts.cut_lineage(spark.range(5), "ids").count() == 5


def test_a_cluster_must_name_its_folder():
    from types import SimpleNamespace

    from shelfwise import session

    cluster = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: default),
        sparkContext=SimpleNamespace(master="spark://host:7077", applicationId="none"),
    )
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(cluster)


def test_a_stored_star_is_found_again(spark, sf_dir, monkeypatch):
    marts.stored_star(spark, sf_dir)
    monkeypatch.setattr(marts, "_STORED", {})
    monkeypatch.setattr(marts, "write_star", lambda *args: pytest.fail("written again"))
    assert marts.stored_star(spark, sf_dir).fact.count() > 0


def test_changed_inputs_are_noticed(spark, sf_dir, tmp_path):
    import shutil

    for name in ("lineitem", "orders", "part", "supplier", "nation", "region"):
        shutil.copyfile(f"{sf_dir}/{name}.parquet", tmp_path / f"{name}.parquet")
    before = marts.input_state(spark, str(tmp_path))
    assert marts.input_state(spark, str(tmp_path)) == before
    shutil.copyfile(f"{sf_dir}/orders.parquet", tmp_path / "nation.parquet")
    assert marts.input_state(spark, str(tmp_path)) != before
