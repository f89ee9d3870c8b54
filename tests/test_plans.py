"""Physical-plan properties the design relies on (checked with explain())."""

import uuid

import pytest

from ledgerlens import registry
from ledgerlens.plans import enrich, questions, star, views

from conftest import plan_text


def test_flagship_pushes_year_range_and_prunes_columns(star_small):
    p = plan_text(star.daily_store_product(star_small))
    assert "GreaterThanOrEqual(l_shipdate" in p and "LessThan(l_shipdate" in p
    scan = [line for line in p.splitlines() if line.startswith("ReadSchema: struct<l_")][0]
    assert "l_tax" not in scan and "l_comment" not in scan and "l_returnflag" not in scan
    assert "BroadcastHashJoin" in p and "partial_sum" in p
    assert "nation.parquet" not in p          # location unused -> nation join eliminated


# Queries that land, write or keep something before they read it, or load a file without a declared schema.
RUNS_JOBS = {
    "ingest_csv_stream", "ingest_csv_sep", "ingest_typed_layer", "ingest_table_set", "ingest_full_refresh", "stream_incremental_append",
    "stream_triggered", "replay_load", "agg_batch_count", "sink_append_json", "read_partitioned", "read_default_format", "mv_materialize",
    "read_json_schema", "clone_table", "sink_ctas", "limit_before_inference", "sort_multi_key", "sort_desc_alias", "sort_chart_order", "filter_rank_le",
}


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - RUNS_JOBS))
def test_no_job_runs_while_a_query_is_built(spark, name):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, name)
    try:
        registry.queries()[name](spark, "/root/testdata/sf0.001")
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_metric_view_prunes_unused_joins(star_small):
    q = views.sales_view(star_small).query(["store_name"], ["total_sales"])
    p = plan_text(q)
    assert "documents.parquet" not in p and "part.parquet" not in p


def test_topk_is_take_ordered(star_small):
    assert "TakeOrderedAndProject" in plan_text(star.top_products(star_small))


def test_per_group_topk_uses_window_group_limit(star_small):
    assert "WindowGroupLimit" in plan_text(star.top_products_per_store(star_small))


def test_lexicon_sentiment_has_no_python(star_small):
    p = plan_text(enrich.sentiment_table(star_small))
    assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p


def test_limit_sits_below_the_model_call(star_small):
    p = plan_text(enrich.product_descriptions(star_small), "simple")
    udf = p.index("ArrowEvalPython")
    # the scorer's input is the 35-row top-k, not the product table
    assert "TakeOrderedAndProject(limit=35" in p[udf:]


def test_two_facts_are_aggregated_before_joining(star_small):
    p = plan_text(questions.sales_with_reviews(star_small), "simple")
    full = p.index("FullOuter")
    assert p.index("HashAggregate", full) > full      # aggregates feed the outer join


def test_global_rank_is_limited_before_the_single_partition_window(star_small):
    # Catalyst turns an un-partitioned ``row_number() <= k`` into a top-k
    # (TakeOrderedAndProject) or a partial WindowGroupLimit below the window.
    p = plan_text(views.top_products_ranked(star_small), "simple")
    window = p.index("Window [")
    assert "TakeOrderedAndProject(limit=5" in p[window:] or "WindowGroupLimit" in p[window:]


@pytest.mark.parametrize("name", ["q_drilldown_by_store", "q_store_growth", "agg_pivot_matrix", "dash_weekly_avg_store"])
def test_the_fact_is_scanned_once(spark, name):
    df = registry.queries()[name](spark, "/root/testdata/sf0.001")
    df.collect()
    assert plan_text(df, "simple").split("Initial Plan")[0].count("lineitem.parquet") == 1
