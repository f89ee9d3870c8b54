"""Name -> query callable ``(spark, sf_dir) -> DataFrame`` for every operator.

``sf_dir`` (or views Spark derives from them) in full.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import params as P
from .plans import star as S
from .sources.fixtures import Star

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Star.load(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        _REGISTRY[name] = run
        return fn
    return deco


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# ------------------------------------------------------------------ 2.1 / 2.2 / 2.3

@register("scan_preview")
def _scan_preview(star: Star) -> DataFrame:
    out = S.transactions_out(star.fct)
    return S.preview(out, P.PREVIEW_ROWS, ["transaction_id", "product_id", "store_id", "transaction_date",
                                           "transaction_qty", "transaction_total"])


@register("scan_dataset")
def _scan_dataset(star: Star) -> DataFrame:
    return S.dataset_scans(star)


@register("project_columns")
def _project_columns(star: Star) -> DataFrame:
    return S.renamed_reviews(star)


@register("project_disaggregated")
def _project_disaggregated(star: Star) -> DataFrame:
    return S.store_table(star)


@register("filter_year_eq")
def _filter_year_eq(star: Star) -> DataFrame:
    return S.transactions_in_year(star)


@register("filter_eq_string")
def _filter_eq_string(star: Star) -> DataFrame:
    return S.transactions_of_store(star)


@register("filter_dq_string")
def _filter_dq_string(star: Star) -> DataFrame:
    return S.mixed_reviews(star)


@register("filter_batch_range")
def _filter_batch_range(star: Star) -> DataFrame:
    lo, hi = P.BATCH_RANGE
    return star.change_rows.filter(F.col("batch").between(lo, hi))


@register("filter_rank_le")
def _filter_rank_le(star: Star) -> DataFrame:
    return S.stores_ranked_by_sales(star)


@register("window_row_number_topk")
def _window_row_number_topk(star: Star) -> DataFrame:
    return S.products_ranked_by_sales(star)


@register("join_fact_store")
def _join_fact_store(star: Star) -> DataFrame:
    return S.fact_with_store(star)


@register("join_fact_product")
def _join_fact_product(star: Star) -> DataFrame:
    return S.fact_with_product(star)


@register("join_star_two_dims")
def _join_star_two_dims(star: Star) -> DataFrame:
    return S.fact_with_store_and_product(star)


@register("join_reviews_store")
def _join_reviews_store(star: Star) -> DataFrame:
    return S.reviews_with_store(star)


# ------------------------------------------------------------------ 2.4 / 2.5 / 2.6

@register("agg_daily_store_product")
def _agg_daily(star: Star) -> DataFrame:
    return S.daily_store_product(star)


@register("agg_hourly_store")
def _agg_hourly(star: Star) -> DataFrame:
    return S.hourly_store(star)


@register("agg_product_qty")
def _agg_product_qty(star: Star) -> DataFrame:
    return S.product_quantity(star)


@register("agg_count_column")
def _agg_count_column(star: Star) -> DataFrame:
    return S.reviews_per_store(star)


@register("agg_distinct")
def _agg_distinct(star: Star) -> DataFrame:
    return S.products_distinct(star)


@register("agg_group_by_all")
def _agg_group_by_all(star: Star) -> DataFrame:
    return S.group_by_all_sql(star)


@register("topk_products")
def _topk_products(star: Star) -> DataFrame:
    return S.top_products(star)


@register("topk_products_store")
def _topk_products_store(star: Star) -> DataFrame:
    return S.top_products_for_store(star)


@register("top1_hour_store")
def _top1_hour_store(star: Star) -> DataFrame:
    return S.busiest_hour_for_store(star)


@register("sort_multi_key")
def _sort_multi_key(star: Star) -> DataFrame:
    return S.hourly_store_positions(star)


@register("sort_desc_alias")
def _sort_desc_alias(star: Star) -> DataFrame:
    return S.reviews_per_store_positions(star)


@register("limit_no_order")
def _limit_no_order(star: Star) -> DataFrame:
    return S.first_mixed_reviews(star)


@register("sort_chart_order")
def _sort_chart_order(star: Star) -> DataFrame:
    return S.custom_ordered_products(star)


@register("q_topk_products_per_store")
def _q_topk_per_store(star: Star) -> DataFrame:
    return S.top_products_per_store(star)


@register("scalar_ratio")
def _scalar_ratio(star: Star) -> DataFrame:
    return S.sales_ratio_by_store(star)


# ------------------------------------------------------------------ 2.9 metric view

from .plans import views as V  # noqa: E402

_MV = {
    "mv_query_one_dim": V.by_store,
    "mv_query_multi_dim": V.by_product,
    "mv_query_time": lambda star: V.by_hour(star, "hour"),
    "mv_query_ratio": V.ratios_by_store,
    "mv_query_topk": V.top_products_ranked,
    "mv_ex_peak_hours": lambda star: V.by_hour(star, "ratio"),
    "mv_ex_product_matrix": V.product_matrix,
    "mv_compose": V.composed_measure,
    "mv_any_subset": V.grand_total,
    "mv_dim_column": V.dim_columns,
    "mv_dim_expr": V.dim_expressions,
    "mv_measure_sum": V.sum_measures,
    "mv_measure_rounded": V.rounded_measure,
    "mv_join_tree": V.join_tree,
    "join_snowflake_nested": V.snowflake,
    "mv_materialize": V.materialized,
}
for _name, _fn in _MV.items():
    register(_name)(_fn)


# ------------------------------------------------------------------ 2.10 dashboard

from .plans import dashboard as D  # noqa: E402

for _name, _fn in D.WIDGETS.items():
    register(_name)(_fn)
register("agg_cube_pivot")(D.sales_cube)
register("agg_pivot_matrix")(D.pivot_matrix)
register("agg_avg")(D.avg_daily_sales)
register("agg_count_if")(D.low_sales_days)
register("agg_two_level")(D.avg_hourly_sales_by_store)
register("agg_count_star")(D.review_count_star)
register("scalar_threshold_flag")(D.flagged_cells)
register("filter_multi_select")(lambda star: D.apply_filters(D.datasets(star), D.default_filters()[:1])["daily"])
register("filter_single_select")(lambda star: D.apply_filters(D.datasets(star), D.default_filters()[1:])["products"]
                                 .withColumn("unit_price", F.col("unit_price").cast("double")))


# ------------------------------------------------------------------ 2.11 inference

from .plans import enrich as N  # noqa: E402

register("ai_prompt_product")(N.product_prompts)
register("ai_product_description")(N.product_descriptions)
register("ai_sentiment_table")(N.sentiment_table)
register("limit_before_inference")(N.limited_scores)
register("sink_ctas")(N.sentiment_ctas)
register("ai_sentiment_counts")(N.sentiment_counts)
register("ai_email_gen")(N.email_prompts)
register("ai_email_generated")(N.generated_emails)


# ------------------------------------------------------------------ 2.1 / 2.12 landing, replay, ingest

from .plans import landing as L  # noqa: E402

register("replay_user_reg")(L.replay_user_reg)
register("replay_cdc")(L.replay_cdc)
register("replay_daily")(L.replay_daily)
register("with_column_drop")(L.with_column_drop)
register("scalar_batch_no")(L.batch_numbers)
register("scalar_epoch_to_date")(L.registration_dates)
register("read_default_format")(L.default_format)
register("read_partitioned")(L.partitioned_roundtrip)
register("ingest_csv_stream")(L.ingest_products)
register("ingest_csv_sep")(L.ingest_stores)
register("ingest_typed_layer")(L.ingest_products_typed)
register("read_json_schema")(L.checked_json)
register("clone_table")(L.cloned_products)
register("replay_load")(L.replayed_registrations)
register("agg_batch_count")(L.batch_counts)
register("sink_append_json")(L.appended_json)
register("ingest_table_set")(L.ingest_table_set)
register("ingest_full_refresh")(L.full_refresh)
register("stream_incremental_append")(L.incremental_append)
register("stream_triggered")(L.triggered_batches)


# ------------------------------------------------------------------ 2.8 columns, 2.13 questions

from .plans.columns import COLUMNS  # noqa: E402
from .plans.questions import QUESTIONS  # noqa: E402

for _name, _fn in {**COLUMNS, **QUESTIONS}.items():
    register(_name)(_fn)
