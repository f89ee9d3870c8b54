"""Metric-view definitions over the fixture star, and the queries asked of them.

``SALES_VIEW`` mirrors the reference's metric view: the transaction fact
with a store lookup (and the store reviews nested under it, which no field
reads -- so it is never joined), a product lookup, five dimensions and three
measures.  ``TIMED_VIEW`` is the same layer over the timed transactions, for
hour-of-day questions.  ``SNOWFLAKE_VIEW`` is a three-level nested join tree
over the raw tables.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import ratio2
from ..sources.fixtures import Star
from ..sources.files import scratch_path
from .materialized import FileSource, answer, materialize
from .metricview import BoundMetricView, MetricView, Ranking

# The dimension and measure names of the reference's view
# (product, Product detail, store_name, month_day, hour_of_day; total_transactions,
# total_sales, total_quantity_sold), so its queries can be asked unchanged.
SALES_VIEW_YAML = """
version: 1.2
source: fct
joins:
  - name: stores
    source: stores
    "on": source.store_id = stores.store_id
    on_duplicate: trust
    joins:
      - name: store_reviews
        source: reviews
        "on": stores.store_id = store_reviews.store_id
  - name: products
    source: products
    on: source.product_iD = products.product_id
    on_duplicate: trust
dimensions:
  - name: product
    expr: source.product_iD
    comment: Key of the sold item
    display_name: Product ID
  - name: Product detail
    expr: products.product_detail
    comment: What the item is called on the menu
    display_name: Product Detail
    synonyms: [product name, item]
  - name: store_name
    expr: stores.store_name
    comment: Shop that rang up the sale
    display_name: Store Name
    synonyms: [store, shop]
  - name: month_day
    expr: "make_date(year(transaction_date), month(transaction_date), day(transaction_date))"
    comment: Calendar day of the sale
    display_name: Transaction Date
  - name: hour_of_day
    expr: HOUR(transaction_time)
    comment: Clock hour of the sale, 0 to 23
    display_name: Hour of Day
measures:
  - name: total_transactions
    sum: CAST(transaction_id AS DECIMAL(20,0))
    comment: Ids added up, as the view has always reported them; transaction_count counts lines
    display_name: Total Transactions
  - name: transaction_count
    count: transaction_id
    comment: How many sale lines there are
    display_name: Transaction Count
  - name: total_sales
    sum: transaction_total
    round: 2
    comment: Money taken, added up exactly and rounded once
    display_name: Total Sales
    synonyms: [revenue, sales]
    format:
      type: currency
      currency_code: USD
      decimal_places:
        type: exact
        places: 2
  - name: total_quantity_sold
    sum: transaction_qty
    comment: Pieces sold
    display_name: Total Quantity Sold
    synonyms: [quantity, items sold]
  - name: avg_price_per_item
    expr: "ROUND(CAST(try_divide(CAST(MEASURE(total_sales) AS DOUBLE), CAST(MEASURE(total_quantity_sold) AS DOUBLE)) AS DECIMAL(38,6)), 2)"
    comment: Money taken for each piece sold
    display_name: Average Price per Item
"""

TIMED_VIEW_YAML = """
version: 1.2
source: timed
joins:
  - name: stores
    source: timed_stores
    "on": source.store_id = stores.store_id
    on_duplicate: trust
dimensions:
  - name: store_name
    expr: stores.store_name
  - name: month_day
    expr: "make_date(year(transaction_date), month(transaction_date), day(transaction_date))"
  - name: hour_of_day
    expr: HOUR(transaction_time)
measures:
  - name: total_transactions
    sum: CAST(transaction_id AS DECIMAL(20,0))
  - name: total_sales
    sum: transaction_total
    round: 2
  - name: total_quantity_sold
    sum: transaction_qty
"""

SNOWFLAKE_VIEW_YAML = """
version: 1.2
source: lineitem
joins:
  - name: supplier
    source: supplier
    "on": source.l_suppkey = supplier.s_suppkey
    on_duplicate: trust
    joins:
      - name: nation
        source: nation
        "on": supplier.s_nationkey = nation.n_nationkey
        on_duplicate: trust
        joins:
          - name: region
            source: region
            "on": nation.n_regionkey = region.r_regionkey
            on_duplicate: trust
  - name: part
    source: part
    "on": source.l_partkey = part.p_partkey
    on_duplicate: trust
dimensions:
  - name: region
    expr: region.r_name
  - name: nation
    expr: nation.n_name
  - name: part_type
    expr: part.p_type
measures:
  - name: revenue
    sum: CAST(l_extendedprice AS DECIMAL(18,2))
    round: 2
  - name: lines
    count: 1
"""


@lru_cache(maxsize=None)
def _definition(text: str) -> MetricView:
    """A parsed definition; it holds no data."""
    return MetricView.from_yaml(text)


def _bound(star: Star, key: str, build) -> BoundMetricView:
    # One bound view per star.
    cache = star.__dict__.setdefault("_bound_views", {})
    if key not in cache:
        cache[key] = build()
    return cache[key]


def sales_view(star: Star) -> BoundMetricView:
    return _bound(star, "sales", lambda: _definition(SALES_VIEW_YAML).bind(
        star.spark, {"fct": star.fct, "stores": star.stores, "products": star.products,
                     "reviews": star.reviews}))


def timed_view(star: Star) -> BoundMetricView:
    return _bound(star, "timed", lambda: _definition(TIMED_VIEW_YAML).bind(
        star.spark, {"timed": star.timed, "timed_stores": star.timed_stores}))


def snowflake_view(star: Star) -> BoundMetricView:
    return _bound(star, "snowflake", lambda: _definition(SNOWFLAKE_VIEW_YAML).bind(
        star.spark, {n: star.table(n) for n in ("lineitem", "supplier", "nation", "region", "part")}))


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Money and sums of ids leave the registered queries as double (exact sums were taken on decimals)."""
    return df.select(*[F.col(f"`{f.name}`").cast("double").alias(f.name)
                       if f.dataType.typeName() == "decimal" else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


# ------------------------------------------------------------------ queries of the workshop

def by_store(star: Star) -> DataFrame:
    """Revenue, transactions and items sold by store, revenue first."""
    q = sales_view(star).query(
        dims=["store_name"],
        measures=[("total_sales", "revenue"), ("total_transactions", "transactions"),
                  ("total_quantity_sold", "items_sold")],
        order_by=[F.desc("revenue"), F.asc("store_name")])
    return decimals_to_double(q)


def by_product(star: Star) -> DataFrame:
    """Product id and detail: revenue and quantity, top 10 by revenue."""
    q = sales_view(star).query(
        dims=["product", "Product detail"],
        measures=[("total_sales", "revenue"), ("total_quantity_sold", "quantity")],
        order_by=[F.desc("revenue"), F.asc("product")], limit=10)
    return decimals_to_double(q)


def by_hour(star: Star, order: str = "hour") -> DataFrame:
    """Peak hours: revenue, transactions and their ratio per hour of day."""
    order_by = [F.asc("hour_of_day")] if order == "hour" else \
        [F.desc("avg_transaction_value"), F.asc("hour_of_day")]
    rev = "revenue" if order == "hour" else "total_revenue"
    q = timed_view(star).query(
        dims=["hour_of_day"],
        measures=[("total_sales", rev), ("total_transactions", "transactions")],
        derived={"avg_transaction_value": ratio2(rev, "transactions")},
        order_by=order_by)
    return decimals_to_double(q)


def ratios_by_store(star: Star) -> DataFrame:
    """Calculated metrics combining several measures, per store."""
    q = sales_view(star).query(
        dims=["store_name"],
        measures=[("total_sales", "total_revenue"), ("total_transactions", "transactions"),
                  ("total_quantity_sold", "items_sold")],
        derived={"avg_transaction_value": ratio2("total_revenue", "transactions"),
                 "avg_price_per_item": ratio2("total_revenue", "items_sold")},
        order_by=[F.desc("total_revenue"), F.asc("store_name")])
    return decimals_to_double(q)


def top_products_ranked(star: Star, k: int = 5) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY MEASURE(total_sales) DESC) AS rank`` ... ``rank <= k``."""
    q = sales_view(star).query(
        dims=["Product detail"],
        measures=[("total_sales", "revenue"), ("total_quantity_sold", "quantity")],
        rank=Ranking("rank", [F.desc("revenue"), F.asc("`Product detail`")], k))
    return decimals_to_double(q.select("rank", "`Product detail`", "revenue", "quantity"))


def product_matrix(star: Star) -> DataFrame:
    """Exercise 2: revenue, quantity and average price per product."""
    q = sales_view(star).query(
        dims=["Product detail"],
        measures=[("total_sales", "revenue"), ("total_quantity_sold", "quantity_sold")],
        derived={"avg_price_per_item": ratio2("revenue", "quantity_sold")},
        order_by=[F.desc("revenue"), F.asc("`Product detail`")])
    return decimals_to_double(q)


def composed_measure(star: Star) -> DataFrame:
    """A measure defined from two other measures (``MEASURE(a) / MEASURE(b)``)."""
    q = sales_view(star).query(dims=["store_name"], measures=["total_sales", "avg_price_per_item"])
    return decimals_to_double(q)


def grand_total(star: Star) -> DataFrame:
    """No dimensions: one grand-total row of every measure."""
    q = sales_view(star).query(measures=["total_transactions", "transaction_count", "total_sales",
                                         "total_quantity_sold"])
    return decimals_to_double(q)


def dim_columns(star: Star) -> DataFrame:
    """Dimensions that are columns of the source and of two joined tables."""
    q = sales_view(star).query(dims=["product", "Product detail", "store_name"],
                               measures=["total_quantity_sold"])
    return decimals_to_double(q)


def dim_expressions(star: Star) -> DataFrame:
    """Derived dimensions (``make_date``, ``HOUR``) resolved on the source."""
    q = sales_view(star).query(dims=["month_day", "hour_of_day"], measures=["total_sales"])
    return decimals_to_double(q)


def sum_measures(star: Star) -> DataFrame:
    q = sales_view(star).query(dims=["store_name"], measures=["total_transactions", "total_quantity_sold"])
    return decimals_to_double(q)


def rounded_measure(star: Star) -> DataFrame:
    q = sales_view(star).query(dims=["month_day"], measures=["total_sales"])
    return decimals_to_double(q)


def join_tree(star: Star) -> DataFrame:
    """Store and product dimensions through the join tree; the nested reviews
    join is pruned, so totals equal the plain star query."""
    q = sales_view(star).query(dims=["store_name", "Product detail"], measures=["total_sales"])
    return decimals_to_double(q)


def snowflake(star: Star) -> DataFrame:
    """Three-level nested joins: lineitem -> supplier -> nation -> region."""
    q = snowflake_view(star).query(dims=["region", "nation"], measures=["revenue", "lines"])
    return decimals_to_double(q)


def materialized(star: Star) -> DataFrame:
    """Revenue by store from a materialisation that was refreshed after a second half of the sales had come.

    A fine and a coarse one are kept; the coarse one, with fewer rows, answers.
    """
    root = scratch_path(star.spark, "mv")
    source = FileSource(f"{root}/sales")

    def append(half: int) -> None:
        star.fct.where(F.abs("transaction_id") % 2 == half).write.mode("append").parquet(source.path)

    append(0)
    bound = MetricView.from_yaml(SALES_VIEW_YAML).bind(star.spark, {
        "fct": source.rows(star.spark), "stores": star.stores, "products": star.products, "reviews": star.reviews})
    measures = ["total_sales", "total_quantity_sold", "transaction_count", "avg_price_per_item"]
    stored = [materialize(bound, source, dims, measures, f"{root}/by{len(dims)}") for dims in (["store_name", "Product detail", "month_day"], ["store_name"])]
    append(1)
    for m in stored:
        m.refresh()
    return decimals_to_double(answer(bound, stored, ["store_name"], ["total_sales", "total_quantity_sold", "transaction_count"]))
