"""Named business questions over the star, one plan each.

Every top-k has a total order (measure, then key).  Questions that combine
two facts aggregate each fact first and join the aggregates, so neither fact
is repeated by the other (the fan-out hazard).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions.scalars import avg2, cents_to_double, cents_to_money, month_start, ratio2, year_range
from ..operators.lookup import Additive, Lookup, aggregate_over_lookups, lookup
from ..operators.ranking import top_k
from ..sources.fixtures import Star
from .star import product_lookup, store_lookup


def _sales(name: str = "total_sales") -> Additive:
    """Sales as an exact sum of integer cents (converted once per group)."""
    return Additive(name, "sum", F.col("transaction_cents"))


def _hourly_sales(star: Star) -> DataFrame:
    t = star.timed.groupBy(F.hour("transaction_time").alias("hour_of_day")) \
        .agg(F.sum("transaction_cents").alias("total_sales"))
    return t.select("hour_of_day", cents_to_double("total_sales").alias("total_sales"))


def best_hour_chain(star: Star) -> DataFrame:
    """What is the best selling time for the chain?"""
    return top_k(_hourly_sales(star), 1, [F.desc("total_sales"), F.asc("hour_of_day")])


def hours_at_risk(star: Star, threshold=P.HOUR_RISK_THRESHOLD) -> DataFrame:
    """Hours with less than ``threshold`` total sales."""
    return _hourly_sales(star).filter(F.col("total_sales") < threshold)


def negative_count_avg(star: Star) -> DataFrame:
    """How many reviews are negative and what is their average score?"""
    neg = star.reviews_sentiment.filter(F.col("sentiment") == "negative")
    return neg.agg(F.count("review_id").alias("negative_reviews"), avg2("score").alias("avg_score"))


def products_at_risk(star: Star, threshold=P.PRODUCT_RISK_THRESHOLD) -> DataFrame:
    """Products whose total sales are below ``threshold`` (HAVING)."""
    agg = aggregate_over_lookups(star.fct, [product_lookup(star)], ["product_id", "product_detail"],
                                 [_sales()])
    return agg.filter(cents_to_money("total_sales") < threshold) \
        .select("product_id", "product_detail", cents_to_double("total_sales").alias("total_sales"))


def _sales_by(star: Star, key: str, fct: DataFrame | None = None) -> DataFrame:
    lk = store_lookup(star) if key.startswith("store") else product_lookup(star)
    agg = aggregate_over_lookups(fct if fct is not None else star.fct, [lk], [key], [_sales()])
    return agg.select(key, cents_to_double("total_sales").alias("total_sales"))


def best_product(star: Star) -> DataFrame:
    """The best product is the one with the highest sales."""
    return top_k(_sales_by(star, "product_detail"), 1, [F.desc("total_sales"), F.asc("product_detail")])


def sales_by_store_year(star: Star, year: int = P.YEAR) -> DataFrame:
    """Total sales by store for one year, highest first."""
    fct = star.fct.filter(year_range("transaction_date", year))
    return _sales_by(star, "store_name", fct).orderBy(F.desc("total_sales"), F.asc("store_name"))


def sales_by_store(star: Star) -> DataFrame:
    return _sales_by(star, "store_name")


def best_satisfaction(star: Star) -> DataFrame:
    """Store with the highest average review score (ties: more reviews, then id)."""
    per = star.reviews.groupBy("store_id").agg(avg2("score").alias("avg_score"),
                                               F.count("review_id").alias("n_reviews"))
    # Names are looked up on the per-store rows and the top-1 is taken last, so
    # no outer join sits above the ORDER BY ... LIMIT.
    named = lookup(per, Lookup(star.stores.select("store_id", "store_name"), "store_id", on_duplicate="trust"))
    return top_k(named, 1, [F.desc("avg_score"), F.desc("n_reviews"), F.asc("store_id")])


def total_transactions(star: Star) -> DataFrame:
    return star.fct.agg(F.count(F.lit(1)).alias("n_transactions"))


def store_count(star: Star) -> DataFrame:
    return star.stores.agg(F.count_distinct("store_id").alias("n_stores"))


def first_products(star: Star, n: int = 10) -> DataFrame:
    out = top_k(star.products, n, [F.asc("product_id")])
    return out.select("product_id", "product_detail", F.col("unit_price").cast("double").alias("unit_price"))


def avg_txn_by_store(star: Star) -> DataFrame:
    """Average transaction total by store: additive sum and count, divided last."""
    agg = aggregate_over_lookups(star.fct, [store_lookup(star)], ["store_name"],
                                 [_sales("s"), Additive("n", "count", F.col("transaction_cents"))])
    return agg.select("store_name", ratio2(cents_to_money("s"), "n").alias("avg_transaction_total"))


def _category(star: Star, measure: Additive) -> DataFrame:
    return aggregate_over_lookups(star.fct, [product_lookup(star)], ["product_category"], [measure])


def top_category_qty(star: Star) -> DataFrame:
    agg = _category(star, Additive("total_quantity_sold", "sum", F.col("transaction_qty")))
    return top_k(agg, 1, [F.desc("total_quantity_sold"), F.asc("product_category")])


def sales_by_category(star: Star) -> DataFrame:
    agg = _category(star, _sales())
    return agg.select("product_category", cents_to_double("total_sales").alias("total_sales"))


def top_categories(star: Star, k: int = P.TOP_CATEGORIES) -> DataFrame:
    return top_k(sales_by_category(star), k, [F.desc("total_sales"), F.asc("product_category")])


def _category_store_sales(star: Star, extra=()) -> DataFrame:
    return aggregate_over_lookups(star.fct, [product_lookup(star), store_lookup(star)],
                                  ["product_category", "store_name"], [_sales(), *extra])


def _in_top_categories(agg: DataFrame, k: int, measures: Sequence[str]) -> DataFrame:
    """Rows of a (category, store) aggregate in its top ``k`` categories by ``total_sales``.

    Both sides of the join read the same aggregate with the same columns and
    no filter of their own (the join is null-safe, so none is inferred), so
    Spark computes it once and reads its exchange twice.
    """
    per_cat = agg.groupBy("product_category").agg(*[F.sum(m).alias(f"cat_{m}") for m in measures])
    top = top_k(per_cat, k, [F.desc("cat_total_sales"), F.asc("product_category"), *[F.asc(f"cat_{m}") for m in measures]])
    top = top.select(F.col("product_category").alias("__top"))
    # A semi-join would be pushed below the aggregate, and with it a second scan.
    return agg.join(top, F.col("product_category").eqNullSafe(F.col("__top"))).drop("__top")


def top_categories_by_store(star: Star, k: int = P.TOP_CATEGORIES) -> DataFrame:
    """Break the top categories down by store."""
    kept = _in_top_categories(_category_store_sales(star), k, ["total_sales"])
    return kept.select("product_category", "store_name", cents_to_double("total_sales").alias("total_sales"))


def store_growth(star: Star, first: int = P.GROWTH_FIRST_YEAR, last: int = P.GROWTH_LAST_YEAR) -> DataFrame:
    """Store with the highest sales growth from ``first`` to ``last`` in the top category.

    One aggregate carries the all-years total (for the top category) and two
    conditional sums (for the growth); the top category is derived from it.
    """
    in_year = lambda y: F.when(year_range("transaction_date", y), F.col("transaction_cents"))
    agg = _category_store_sales(star, [Additive("s_first", "sum", in_year(first)),
                                       Additive("s_last", "sum", in_year(last))])
    kept = _in_top_categories(agg, 1, ["total_sales", "s_first", "s_last"])
    out = kept.select("product_category", "store_name", cents_to_double("total_sales").alias("total_sales"),
                      cents_to_double("s_first").alias("sales_first_year"),
                      cents_to_double("s_last").alias("sales_last_year"),
                      ratio2(cents_to_money(F.col("s_last") - F.col("s_first")), cents_to_money("s_first"))
                      .alias("growth"))
    return top_k(out, 1, [F.desc_nulls_last("growth"), F.asc("store_name")])


def reviews_by_sentiment(star: Star) -> DataFrame:
    return star.reviews_sentiment.groupBy("sentiment").agg(F.count("review_id").alias("total_reviews"))


def most_negative_store(star: Star) -> DataFrame:
    neg = star.reviews_sentiment.filter(F.col("sentiment") == "negative")
    agg = aggregate_over_lookups(neg, [store_lookup(star)], ["store_name"],
                                 [Additive("negative_reviews", "count", F.col("review_id"))])
    return top_k(agg, 1, [F.desc("negative_reviews"), F.asc("store_name")])


def pos_neg_ratio(star: Star) -> DataFrame:
    """Positive / negative reviews per store; NULL when a store has no negative one."""
    agg = aggregate_over_lookups(
        star.reviews_sentiment, [store_lookup(star)], ["store_name"],
        [Additive("positive_reviews", "count_if", F.col("sentiment") == "positive"),
         Additive("negative_reviews", "count_if", F.col("sentiment") == "negative")])
    return agg.withColumn("pos_neg_ratio", ratio2("positive_reviews", "negative_reviews"))


def monthly_sales(star: Star) -> DataFrame:
    """Sales regrouped by month instead of day."""
    agg = star.fct.groupBy(month_start("transaction_date").alias("month")) \
        .agg(F.sum("transaction_cents").alias("total_sales"))
    return agg.select("month", cents_to_double("total_sales").alias("total_sales"))


def compare_two_stores(star: Star, stores=P.COMPARE_STORES) -> DataFrame:
    """Two stores side by side: conditional sums per measure in one pass."""
    a, b = stores
    chosen = star.stores.filter(F.col("store_name").isin(a, b)).select("store_id", "store_name")
    fct = lookup(star.fct, Lookup(chosen, "store_id", on_duplicate="trust"), how="inner")
    is_a, is_b = F.col("store_name") == a, F.col("store_name") == b
    out = fct.agg(F.sum(F.when(is_a, F.col("transaction_cents"))).alias("sales_a"),
                  F.sum(F.when(is_b, F.col("transaction_cents"))).alias("sales_b"),
                  F.sum(F.when(is_a, F.col("transaction_qty"))).alias("qty_a"),
                  F.sum(F.when(is_b, F.col("transaction_qty"))).alias("qty_b"))
    return out.select(F.lit(a).alias("store_a"), F.lit(b).alias("store_b"),
                      cents_to_double("sales_a").alias("sales_a"), cents_to_double("sales_b").alias("sales_b"),
                      "qty_a", "qty_b")


def sales_with_reviews(star: Star) -> DataFrame:
    """Sales and review counts per store: each fact aggregated first, then joined."""
    sales = star.fct.groupBy("store_id").agg(F.sum("transaction_cents").alias("s"))
    revs = star.reviews.groupBy("store_id").agg(F.count("review_id").alias("n"))
    both = sales.join(revs, "store_id", "full_outer")
    named = lookup(both, Lookup(star.stores.select("store_id", "store_name"), "store_id", on_duplicate="trust"))
    return named.select("store_id", "store_name",
                        cents_to_double(F.coalesce(F.col("s"), F.lit(0).cast("bigint"))).alias("total_sales"),
                        F.coalesce(F.col("n"), F.lit(0)).alias("total_reviews"))


TRUSTED_SQL = {
    "top_products_by_store": """
        SELECT s.store_name, p.product_detail, CAST(SUM(f.transaction_total) AS DOUBLE) AS total_quantity_sold
        FROM ll_q_fct f
        LEFT JOIN ll_q_products p ON f.product_id = p.product_id
        LEFT JOIN ll_q_stores s ON f.store_id = s.store_id
        WHERE s.store_name = :store
        GROUP BY s.store_name, p.product_detail
        ORDER BY total_quantity_sold DESC, p.product_detail
        LIMIT :k""",
}


def run_trusted(star: Star, name: str, **args) -> DataFrame:
    """A named, verified SQL query with bound parameters (never string-formatted)."""
    star.fct.createOrReplaceTempView("ll_q_fct")
    star.products.createOrReplaceTempView("ll_q_products")
    star.stores.createOrReplaceTempView("ll_q_stores")
    return star.spark.sql(TRUSTED_SQL[name], args=args)


def trusted_top_products(star: Star) -> DataFrame:
    return run_trusted(star, "top_products_by_store", store=P.NAMED_STORE, k=P.TOP_PER_STORE)


QUESTIONS = {
    "q_best_hour_chain": best_hour_chain,
    "q_negative_count_avg": negative_count_avg,
    "q_products_at_risk": products_at_risk,
    "q_hours_at_risk": hours_at_risk,
    "q_best_product": best_product,
    "q_sales_by_store_year": sales_by_store_year,
    "q_best_satisfaction": best_satisfaction,
    "q_total_transactions": total_transactions,
    "q_store_count": store_count,
    "q_first_products": first_products,
    "q_sales_by_store": sales_by_store,
    "q_avg_txn_by_store": avg_txn_by_store,
    "q_top_category_qty": top_category_qty,
    "q_drilldown_category": sales_by_category,
    "q_drilldown_top3": top_categories,
    "q_drilldown_by_store": top_categories_by_store,
    "q_store_growth": store_growth,
    "q_reviews_by_sentiment": reviews_by_sentiment,
    "q_most_negative_store": most_negative_store,
    "q_pos_neg_ratio": pos_neg_ratio,
    "q_monthly_sales": monthly_sales,
    "q_compare_two": compare_two_stores,
    "q_sales_with_reviews": sales_with_reviews,
    "q_trusted_sql": trusted_top_products,
}


def sales_by_store_via_relationships(star: Star) -> DataFrame:
    """'Total sales by store name', with the join found from declared relationships."""
    from ..operators.relationships import star_relationships
    joined = star_relationships(star).join_path("transactions", ["stores"], {"stores": ["store_name"]})
    agg = joined.groupBy("store_name").agg(F.sum("transaction_cents").alias("total_sales"))
    return agg.select("store_name", cents_to_double("total_sales").alias("total_sales"))


QUESTIONS["join_relationships"] = sales_by_store_via_relationships
