"""The retail star schema, derived from the driver's TPC-H-like tables.

The reference analyses a retail-chain star schema (transactions, stores,
products, reviews).  Its data are not shipped, so the same roles are played by
columns of the driver tables; the mapping is fixed in FIXTURES.md and repeated
verbatim in the DuckDB oracles (``ledgerlens.oracles``).

Money is ``decimal(18,2)`` at the source and is also carried as exact integer
cents (``transaction_cents``); aggregations sum the cents (fast long sums) and
convert once per group, so totals are exact and independent of the order in
which partitions are added up.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import to_cents
from ..operators.lookup import first_per_key
from .tables import read_table

MONEY = "decimal(18,2)"
PRICE = "decimal(10,2)"

# Fixed values of the mapping (FIXTURES.md section C).
REVIEW_STORE_COUNT = 10                 # review store_id = doc_id % 10
REVIEW_EMAIL_PREFIX = "user."
REVIEW_EMAIL_DOMAIN = "@example.com"
REPLAY_PIVOT_DATE = "2024-01-10"        # stands in for the reference's 2019-12-01
SENTIMENT_BY_LABELS = {                  # (quality, toxic) -> sentiment
    (1, 0): "positive",
    (0, 1): "negative",
    (1, 1): "mixed",
    (0, 0): "neutral",
}


def money(col: Column | str) -> Column:
    """Exact money column: decimal(18,2)."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast(MONEY)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fct``: one row per sold line (lineitem)."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("transaction_id"),
        F.col("l_shipdate").cast("date").alias("transaction_date"),
        F.col("l_shipdate").cast("timestamp").alias("transaction_time"),
        F.col("l_quantity").cast("bigint").alias("transaction_qty"),
        money("l_extendedprice").alias("transaction_total"),
        to_cents("l_extendedprice").alias("transaction_cents"),
        F.col("l_suppkey").alias("store_id"),
        F.col("l_partkey").alias("product_id"),
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``stores``: supplier with its nation name as location."""
    sup = read_table(spark, sf_dir, "supplier")
    # One row per key (an aggregate over the small nation table) lets Catalyst
    # drop the join from plans that never read the location.
    nat = first_per_key(read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), ["n_nationkey"])
    joined = sup.join(nat, sup.s_nationkey == nat.n_nationkey, "left")
    return joined.select(
        F.col("s_suppkey").alias("store_id"),
        F.col("s_name").alias("store_name"),
        F.col("n_name").alias("store_location"),
        F.concat(F.lit("balance "), money("s_acctbal").cast("string")).alias("store_description"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``products``: part."""
    part = read_table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("product_category"),
        F.col("p_name").alias("product_detail"),
        F.col("p_retailprice").cast(PRICE).alias("unit_price"),
    )


def timed_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``timed``: transactions with a time of day (events)."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("transaction_id"),
        F.col("ts").cast("date").alias("transaction_date"),
        F.col("ts").alias("transaction_time"),
        F.lit(1).cast("bigint").alias("transaction_qty"),
        money("value").alias("transaction_total"),
        to_cents("value").alias("transaction_cents"),
        F.col("user_id").alias("store_id"),
    )


def timed_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``timed_stores``: customer; the market segment plays the store name."""
    cust = read_table(spark, sf_dir, "customer")
    return cust.select(
        F.col("c_custkey").alias("store_id"),
        F.col("c_mktsegment").alias("store_name"),
    )


def sentiment_from_labels(quality: Column, toxic: Column) -> Column:
    expr = None
    for (q, t), label in SENTIMENT_BY_LABELS.items():
        cond = (quality == q) & (toxic == t)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def _reviews_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels")
    # Every document is a review; labels is keyed by doc_id (unique), so the join
    # preserves document rows, and an unlabelled one has no score.  Both sides
    # grow with the data, so the planner / AQE pick the strategy.
    return docs.join(labels, "doc_id", "left")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``reviews``: documents as store reviews; the score is null without labels."""
    base = _reviews_base(spark, sf_dir)
    return base.select(
        F.col("doc_id").alias("review_id"),
        (F.col("doc_id") % REVIEW_STORE_COUNT).alias("store_id"),
        F.concat(F.lit(REVIEW_EMAIL_PREFIX), F.col("doc_id").cast("string"),
                 F.lit(REVIEW_EMAIL_DOMAIN)).alias("email"),
        F.col("text").alias("review"),
        (F.lit(1) + 2 * F.col("quality") + 2 * (1 - F.col("toxic"))).alias("score"),
    )


def reviews_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``reviews_sentiment``: reviews plus the label-derived sentiment."""
    base = _reviews_base(spark, sf_dir)
    return base.select(
        F.col("doc_id").alias("review_id"),
        (F.col("doc_id") % REVIEW_STORE_COUNT).alias("store_id"),
        F.concat(F.lit(REVIEW_EMAIL_PREFIX), F.col("doc_id").cast("string"),
                 F.lit(REVIEW_EMAIL_DOMAIN)).alias("email"),
        F.col("text").alias("review"),
        (F.lit(1) + 2 * F.col("quality") + 2 * (1 - F.col("toxic"))).alias("score"),
        sentiment_from_labels(F.col("quality"), F.col("toxic")).alias("sentiment"),
    )


def registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``registrations``: the user-registration replay source (events)."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("device_id"),
        F.col("event_type").alias("mac_address"),
        F.col("ts").cast("timestamp").cast("double").alias("registration_timestamp"),
        F.col("user_id"),
    )


def change_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change rows carrying an integer ``batch`` (day of month of the event)."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id"), F.col("user_id"), F.col("event_type").alias("op"),
        F.col("value"), F.dayofmonth("ts").alias("batch"),
    )


def daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bronze rows: source columns plus ``date``, ``week_part``, ``topic``."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id"), F.col("user_id"), F.col("value"),
        F.col("ts").cast("date").alias("date"),
        F.concat(F.year("ts").cast("string"), F.lit("-w"),
                 F.lpad(F.weekofyear("ts").cast("string"), 2, "0")).alias("week_part"),
        F.col("event_type").alias("topic"),
    )


class Star:
    """The fixture views of one scale-factor directory, built lazily.

    Only the views a query touches are planned; each is a lazy DataFrame, so
    nothing is read until an action runs.
    """

    VIEWS = ("fct", "stores", "products", "timed", "timed_stores", "reviews",
             "reviews_sentiment", "registrations", "change_rows", "daily_events")

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @classmethod
    def load(cls, spark: SparkSession, sf_dir: str) -> "Star":
        """The views of ``sf_dir`` over the files that are there now; a Star never outlives its caller."""
        return cls(spark, sf_dir.rstrip("/"))

    @cached_property
    def fct(self) -> DataFrame:
        return transactions(self.spark, self.sf_dir)

    @cached_property
    def stores(self) -> DataFrame:
        return stores(self.spark, self.sf_dir)

    @cached_property
    def products(self) -> DataFrame:
        return products(self.spark, self.sf_dir)

    @cached_property
    def timed(self) -> DataFrame:
        return timed_transactions(self.spark, self.sf_dir)

    @cached_property
    def timed_stores(self) -> DataFrame:
        return timed_stores(self.spark, self.sf_dir)

    @cached_property
    def reviews(self) -> DataFrame:
        return reviews(self.spark, self.sf_dir)

    @cached_property
    def reviews_sentiment(self) -> DataFrame:
        return reviews_sentiment(self.spark, self.sf_dir)

    @cached_property
    def registrations(self) -> DataFrame:
        return registrations(self.spark, self.sf_dir)

    @cached_property
    def change_rows(self) -> DataFrame:
        return change_rows(self.spark, self.sf_dir)

    @cached_property
    def daily_events(self) -> DataFrame:
        return daily_events(self.spark, self.sf_dir)

    def table(self, name: str) -> DataFrame:
        """A raw driver table of the same directory."""
        return read_table(self.spark, self.sf_dir, name)

    def register(self, prefix: str = "") -> None:
        """Register every view as ``{prefix}{name}`` for SQL use."""
        for name in self.VIEWS:
            getattr(self, name).createOrReplaceTempView(prefix + name)
