"""Star-schema queries of the reference notebook and dashboard datasets.

Each function takes a :class:`~ledgerlens.sources.fixtures.Star` (lazy views)
and returns a lazy DataFrame; no job runs while one is built.  The star's
dimension keys are the primary keys of their tables, so lookups trust them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P
from ..functions.scalars import cents_to_double, cents_to_money, day_of, ratio2, year_range
from ..operators.lookup import Additive, Lookup, aggregate_over_lookups, lookup
from ..operators.ranking import rank_all, top_k, top_k_per_group, with_position
from ..sources.fixtures import Star


def store_lookup(star: Star) -> Lookup:
    return Lookup(star.stores, "store_id", name="stores", on_duplicate="trust")


def product_lookup(star: Star) -> Lookup:
    return Lookup(star.products, "product_id", name="products", on_duplicate="trust")


def timed_store_lookup(star: Star) -> Lookup:
    return Lookup(star.timed_stores, "store_id", name="timed_stores", on_duplicate="trust")


def _sum(name: str, col: str) -> Additive:
    return Additive(name, "sum", F.col(col))


def _sales(name: str = "total_sales") -> Additive:
    """Sales as an exact sum of integer cents."""
    return Additive(name, "sum", F.col("transaction_cents"))


# ------------------------------------------------------------------ datasets

def daily_store_product(star: Star, year: int = P.YEAR, ordered: bool = True) -> DataFrame:
    """Transactions, sales and quantity by store, product and day for one year.

    The year predicate is a date range, so it reaches the parquet scan as
    pushed filters on ``l_shipdate``.
    """
    fct = (star.fct.filter(year_range("transaction_date", year))
           .withColumn("month_day", day_of("transaction_date")))
    agg = aggregate_over_lookups(
        fct, [store_lookup(star), product_lookup(star)],
        ["store_name", "product_detail", "month_day"],
        [_sum("total_transactions", "transaction_id"), _sales(),
         _sum("total_quantity_sold", "transaction_qty")])
    out = agg.select("store_name", "product_detail", "month_day", "total_transactions",
                     cents_to_double("total_sales").alias("total_sales"), "total_quantity_sold")
    return out.orderBy("store_name", "month_day") if ordered else out


def product_quantity(star: Star) -> DataFrame:
    """Total quantity sold per product detail."""
    return aggregate_over_lookups(
        star.fct, [product_lookup(star)], ["product_detail"],
        [_sum("total_quantity_sold", "transaction_qty")])


def top_products(star: Star, k: int = P.TOP_PRODUCTS) -> DataFrame:
    """Top ``k`` products by quantity (ties broken by name)."""
    return top_k(product_quantity(star), k, [F.desc("total_quantity_sold"), F.asc("product_detail")])


def hourly_store(star: Star, ordered: bool = True) -> DataFrame:
    """Quantity and sales per store and hour of day (timed transactions)."""
    timed = star.timed.withColumn("hour_of_day", F.hour("transaction_time"))
    agg = aggregate_over_lookups(
        timed, [timed_store_lookup(star)], ["hour_of_day", "store_name"],
        [_sum("total_transactions_per_hour", "transaction_qty"), _sales("total_store_sales_per_hour")])
    out = agg.select("store_name", "hour_of_day", "total_transactions_per_hour",
                     cents_to_double("total_store_sales_per_hour").alias("total_store_sales_per_hour"))
    return out.orderBy("store_name", F.asc("hour_of_day")) if ordered else out


def hourly_store_positions(star: Star) -> DataFrame:
    """``ORDER BY store_name, hour_of_day ASC``, each row with its place in that order."""
    return with_position(hourly_store(star, ordered=False), [F.asc("store_name"), F.asc("hour_of_day")])


def reviews_per_store_positions(star: Star) -> DataFrame:
    """``ORDER BY total_reviews DESC`` (ties by name), each row with its place in that order."""
    return with_position(reviews_per_store(star, ordered=False), [F.desc("total_reviews"), F.asc("store_name")])


def reviews_per_store(star: Star, ordered: bool = True) -> DataFrame:
    """``COUNT(review_id)`` per store name, most reviewed first."""
    agg = aggregate_over_lookups(
        star.reviews, [store_lookup(star)], ["store_name"],
        [Additive("total_reviews", "count", F.col("review_id"))])
    return agg.orderBy(F.desc("total_reviews"), F.asc("store_name")) if ordered else agg


# ------------------------------------------------------------------ named-store questions

def top_products_for_store(star: Star, store_name: str = P.NAMED_STORE, k: int = P.TOP_PER_STORE) -> DataFrame:
    """Top ``k`` products of one store by sales (the reference's first trusted query).

    ``store_name = x`` on the LEFT-joined side drops unmatched rows, so the
    store lookup becomes an inner join with the one-name dimension slice; the
    fact is cut to that store before the product lookup and the aggregate.
    """
    chosen = star.stores.filter(F.col("store_name") == store_name).select("store_id", "store_name")
    fct = lookup(star.fct, Lookup(chosen, "store_id", name="stores", on_duplicate="trust"), how="inner")
    agg = aggregate_over_lookups(
        fct, [product_lookup(star)], ["store_name", "product_detail"],
        [_sales("total_quantity_sold")])
    agg = agg.select("store_name", "product_detail",
                     cents_to_double("total_quantity_sold").alias("total_quantity_sold"))
    return top_k(agg, k, [F.desc("total_quantity_sold"), F.asc("product_detail")])


def busiest_hour_for_store(star: Star, store_name: str = P.NAMED_TIMED_STORE) -> DataFrame:
    """Hour with the highest sales for one store (the second trusted query)."""
    chosen = star.timed_stores.filter(F.col("store_name") == store_name)
    timed = lookup(star.timed, Lookup(chosen, "store_id", name="timed_stores", on_duplicate="trust"), how="inner")
    agg = (timed.groupBy("store_name", F.hour("transaction_time").alias("hour_of_day"))
           .agg(F.sum("transaction_cents").alias("total_transactions")))
    agg = agg.select("store_name", "hour_of_day", cents_to_double("total_transactions").alias("total_transactions"))
    return top_k(agg, 1, [F.desc("total_transactions"), F.asc("hour_of_day")])


# ------------------------------------------------------------------ projections, filters, joins

def transactions_out(df: DataFrame) -> DataFrame:
    """Fact columns for row output (money as double, no time column)."""
    return df.select("transaction_id", "transaction_date", "transaction_qty",
                     F.col("transaction_total").cast("double").alias("transaction_total"),
                     "store_id", "product_id")


def transactions_in_year(star: Star, year: int = P.YEAR) -> DataFrame:
    return transactions_out(star.fct.filter(year_range("transaction_date", year)))


def transactions_of_store(star: Star, store_name: str = P.NAMED_STORE) -> DataFrame:
    """Fact rows of one store; the filter on the joined name makes the join inner."""
    chosen = star.stores.filter(F.col("store_name") == store_name).select("store_id", "store_name")
    joined = lookup(star.fct, Lookup(chosen, "store_id", name="stores", on_duplicate="trust"), how="inner")
    return joined.select("transaction_id", "transaction_date", "transaction_qty",
                         F.col("transaction_total").cast("double").alias("transaction_total"),
                         "store_id", "product_id", "store_name")


def fact_with_store(star: Star) -> DataFrame:
    j = lookup(star.fct, store_lookup(star))
    return j.select("transaction_id", "transaction_date", "transaction_qty",
                    F.col("transaction_total").cast("double").alias("transaction_total"),
                    "store_id", "product_id", "store_name", "store_location")


def fact_with_product(star: Star) -> DataFrame:
    j = lookup(star.fct, product_lookup(star))
    return j.select("transaction_id", "transaction_date", "transaction_qty",
                    F.col("transaction_total").cast("double").alias("transaction_total"),
                    "store_id", "product_id", "product_category", "product_detail",
                    F.col("unit_price").cast("double").alias("unit_price"))


def fact_with_store_and_product(star: Star) -> DataFrame:
    j = lookup(lookup(star.fct, store_lookup(star)), product_lookup(star))
    return j.select("transaction_id", "transaction_date", "transaction_qty",
                    F.col("transaction_total").cast("double").alias("transaction_total"),
                    "store_id", "product_id", "store_name", "product_detail")


def reviews_with_store(star: Star) -> DataFrame:
    j = lookup(star.reviews, store_lookup(star))
    return j.select("review_id", "store_id", "email", "score", "store_name")


def mixed_reviews(star: Star) -> DataFrame:
    """``sentiment = "mixed"`` -- a double-quoted string literal in the reference."""
    return star.reviews_sentiment.filter(F.col("sentiment") == F.lit("mixed"))


def first_mixed_reviews(star: Star, n: int = P.MIXED_LIMIT) -> DataFrame:
    """``LIMIT 15`` over mixed reviews, made deterministic by key order."""
    return top_k(mixed_reviews(star).select("review_id", "email", "sentiment"), n, [F.asc("review_id")])


def row_content(*cols: str) -> Column:
    """The named columns of a row as one string, null as empty."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])


# Columns of the four datasets that are plain scans of a table, the key first.
SCANNED = {
    "stores": ("store_id", "store_name", "store_location", "store_description"),
    "products": ("product_id", "product_category", "product_detail", "unit_price"),
    "transactions": ("transaction_id", "transaction_date", "transaction_qty", "transaction_total", "store_id", "product_id"),
    "reviews": ("review_id", "store_id", "email", "review", "score"),
}


def dataset_scans(star: Star) -> DataFrame:
    """``SELECT * FROM`` each of the four tables behind the dashboard, a row's values as one string (a review as its MD5)."""
    tables = {"stores": star.stores, "products": star.products, "transactions": star.fct,
              "reviews": star.reviews.withColumn("review", F.md5(F.coalesce("review", F.lit(""))))}
    scans = [tables[name].select(F.lit(name).alias("dataset"), F.col(cols[0]).cast("bigint").alias("row_key"), row_content(*cols).alias("content"))
             for name, cols in SCANNED.items()]
    return reduce(DataFrame.unionByName, scans)


def preview(df: DataFrame, n: int, order_by) -> DataFrame:
    """``SELECT * FROM t LIMIT n`` with a key order for a stable answer."""
    return top_k(df, n, order_by)


def products_distinct(star: Star) -> DataFrame:
    return star.products.select("product_id", "product_category", "product_detail",
                                F.col("unit_price").cast("double").alias("unit_price")).distinct()


def renamed_reviews(star: Star) -> DataFrame:
    """Projection with renames, including a name with a space."""
    return star.reviews_sentiment.select(
        F.col("review_id").alias("Review ID"), F.col("store_id").alias("store"),
        "email", F.col("score").alias("review_score"), "sentiment")


def store_table(star: Star) -> DataFrame:
    """Raw projection of the store dimension (disaggregated widget)."""
    return star.stores.select("store_location", "store_name", "store_description")


# ------------------------------------------------------------------ windows

def stores_ranked_by_sales(star: Star, k: int = P.RANK_LIMIT) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY sales DESC) AS rank ... WHERE rank <= k``, for any ``k``."""
    agg = aggregate_over_lookups(star.fct, [store_lookup(star)], ["store_name"], [_sales()])
    ranked = rank_all(agg, [F.desc("total_sales"), F.asc("store_name")], k)
    return ranked.select("rank", "store_name", cents_to_double("total_sales").alias("total_sales"))


def products_ranked_by_sales(star: Star, k: int = P.RANK_LIMIT) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY total_sales DESC) AS rank`` over products, ``rank <= k``.

    The rank comes after the aggregate, and Spark keeps ``k`` rows of each
    task before the window that has no partition.
    """
    agg = aggregate_over_lookups(star.fct, [product_lookup(star)], ["product_detail"], [_sales("sales"), _sum("quantity", "transaction_qty")])
    order = Window.orderBy(F.desc("sales"), F.asc("product_detail"))
    return agg.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "rank", "product_detail", cents_to_double("sales").alias("revenue"), "quantity")


def top_products_per_store(star: Star, k: int = P.TOP_PER_STORE) -> DataFrame:
    """Top ``k`` products by sales for every store."""
    agg = aggregate_over_lookups(star.fct, [store_lookup(star), product_lookup(star)],
                                 ["store_name", "product_detail"],
                                 [_sales()])
    agg = agg.withColumn("total_sales", cents_to_double("total_sales"))
    return top_k_per_group(agg, ["store_name"], k, [F.desc("total_sales"), F.asc("product_detail")],
                           rank_col="rank")


def custom_ordered_products(star: Star, order=P.CHART_ORDER) -> DataFrame:
    """Top-10 dataset with a custom axis order (place in a fixed value list), and each row's place on the axis."""
    pos = F.array_position(F.array(*[F.lit(v) for v in order]), F.col("product_detail"))
    out = top_products(star).withColumn("sort_pos", F.when(pos > 0, pos.cast("int")))
    return with_position(out, [F.asc_nulls_last("sort_pos"), F.desc("total_quantity_sold"), F.asc("product_detail")])


def sales_ratio_by_store(star: Star) -> DataFrame:
    """Ratios of measures per store; a zero divisor gives NULL, never an error."""
    agg = aggregate_over_lookups(
        star.fct, [store_lookup(star)], ["store_name"],
        [_sales(), _sum("total_quantity_sold", "transaction_qty"),
         Additive("full_lines", "count_if", F.col("transaction_qty") >= 50)])
    return agg.select("store_name",
                      ratio2(cents_to_money("total_sales"), "total_quantity_sold").alias("avg_price_per_item"),
                      ratio2("total_quantity_sold", "full_lines").alias("qty_per_full_line"))


def group_by_all_sql(star: Star) -> DataFrame:
    """``GROUP BY ALL`` through Spark SQL over the fixture views."""
    star.fct.createOrReplaceTempView("ll_fct")
    star.stores.createOrReplaceTempView("ll_stores")
    return star.spark.sql("""
        SELECT store_location, store_name, SUM(transaction_qty) AS total_quantity_sold,
               COUNT(*) AS n_lines
        FROM ll_fct LEFT JOIN ll_stores ON ll_fct.store_id = ll_stores.store_id
        GROUP BY ALL""")
