"""Column-function queries: one scalar over a whole table each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import (concat_strict, day_of, email_to_name, format_compact, format_currency, format_plain, path_name, slug,
                                 week_start)
from ..operators.lookup import Additive, aggregate_over_lookups, lookup
from ..sources.fixtures import Star
from .star import product_lookup, store_lookup

TAX_RATE = "1.0825"


def make_date_q(star: Star) -> DataFrame:
    return star.fct.select("transaction_id", "product_id", day_of("transaction_date").alias("month_day"))


def date_parts(star: Star) -> DataFrame:
    d = F.col("transaction_date")
    return star.fct.select("transaction_id", "product_id", F.year(d).alias("year"),
                           F.month(d).alias("month"), F.dayofmonth(d).alias("day"))


def hour_q(star: Star) -> DataFrame:
    return star.timed.select("transaction_id", F.hour("transaction_time").alias("hour_of_day"))


def week_trunc(star: Star) -> DataFrame:
    return star.fct.select("transaction_id", "product_id", week_start("transaction_date").alias("week_start"))


def round_price(star: Star) -> DataFrame:
    """``ROUND(x, 2)`` on exact decimals (half-up): price with tax."""
    p = star.products
    taxed = F.round(F.col("unit_price") * F.lit(TAX_RATE).cast("decimal(6,4)"), 2)
    return p.select("product_id", taxed.cast("double").alias("price_with_tax"))


def concat_prompt(star: Star) -> DataFrame:
    """``CONCAT`` is NULL as soon as a part is NULL (e.g. an unmatched store)."""
    r = lookup(star.reviews, store_lookup(star))
    return r.select("review_id", concat_strict("Review of ", F.col("store_name"), " by ", F.col("email"),
                                               ": ", F.col("review")).alias("prompt"))


def email_names(star: Star) -> DataFrame:
    return star.reviews.select("review_id", "email", email_to_name("email").alias("name_hint"))


def slugs(star: Star) -> DataFrame:
    return star.products.select("product_id", slug("product_detail").alias("slug"),
                                slug(F.concat_ws(" / ", "product_category", "product_detail")).alias("path_slug"))


def page_names(star: Star) -> DataFrame:
    return star.table("pages").select("page_id", path_name("url").alias("page_name"))


def display_formats(star: Star) -> DataFrame:
    """Amounts as a dashboard shows them: currency, plain and compact, for sales of every product and their negative."""
    sales = aggregate_over_lookups(star.fct, [product_lookup(star)], ["product_detail"],
                                   [Additive("cents", "sum", F.col("transaction_cents"))])
    amount = F.col("cents").cast("decimal(38,0)") / 100
    shown = sales.select("product_detail", F.explode(F.array(amount, -amount, F.round(amount / 1000, 2))).alias("amount"))
    return shown.select("product_detail", format_currency("amount").alias("currency"), format_plain("amount").alias("plain"),
                        format_compact("amount").alias("compact"))


COLUMNS = {
    "scalar_format_currency": display_formats,
    "scalar_make_date": make_date_q,
    "scalar_date_parts": date_parts,
    "scalar_hour": hour_q,
    "scalar_week_trunc": week_trunc,
    "scalar_round_money": round_price,
    "scalar_concat_prompt": concat_prompt,
    "scalar_email_to_name": email_names,
    "scalar_slug": slugs,
    "scalar_path_name": page_names,
}
