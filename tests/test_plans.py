"""What the plans of the large jobs may and may not contain."""

import pytest

from paddock.plans import queries as q

FOLDER = "/root/testdata/sf0.001"
# the one Python step of these is none: all stay on the JVM
JVM_ONLY = (
    "silver_listings", "gold_listings", "text_flags", "upsert_listings", "combine_gold", "segment_metrics",
    "market_summary", "feature_screen", "pages_extract", "best_run_summary", "bootstrap_ci",
)


def plan(spark, name):
    return q.plain_queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", JVM_ONLY)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(spark, name)
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text, node


@pytest.mark.parametrize("name", ("dedupe_url", "upsert_listings", "keep_last_by_key", "combine_gold", "best_run_summary", "watchlist"))
def test_ranked_groups_are_cut_on_the_map_side(spark, name):
    assert "Partial" in plan(spark, name) and "WindowGroupLimit" in plan(spark, name)


def test_narrow_results_read_narrow_columns(spark):
    """Statistics of prices read no text."""
    text = plan(spark, "outliers_log")
    assert "text#" not in text


def test_upsert_join_reuses_the_ranking_shuffles(spark):
    """Both crawls are shuffled by URL once; the join adds nothing."""
    text = plan(spark, "upsert_listings")
    assert text.count("hashpartitioning(URL") == 2


def test_result_does_not_depend_on_shuffle_partitions(spark):
    def rows(n):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        return sorted(map(str, q.category_stats(spark, FOLDER).collect()))

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert rows("1") == rows("16")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
