"""Batch inference over the star: product descriptions, review sentiment, e-mails.

Every model call sits behind the rules of :mod:`ledgerlens.operators.inference`:
distinct inputs, NULL skipped, and the ``ORDER BY ... LIMIT`` placed below the
scorer so only the kept rows are scored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions.scalars import concat_strict, email_to_name
from ..operators.inference import Scorer, keyword_generator, lexicon_scorer, lexicon_sentiment, score_text
from ..operators.lookup import lookup
from ..operators.ranking import top_k
from ..operators.scored import ScoredTexts
from ..sources.files import create_table_as, scratch_path
from ..sources.fixtures import Star
from .star import store_lookup

# Prompt texts of the reference's two generation calls.
PRODUCT_PROMPT = (
    "Create a description of the product based on the product category",
    "and detail",
    "and unit price in dollars",
    "The output should be just the description and vary for each product",
)
EMAIL_PROMPT = (
    "Use this review:",
    "to create a email advertising a 10% discount at the store:",
    "Use the email:",
    "as to infer the user name",
    ". The output should be just the email and vary for each review",
)


def product_prompts(star: Star, k: int = P.PROMPT_LIMIT) -> DataFrame:
    """Distinct products, the ``k`` highest ids, with the description prompt.

    The distinct runs first (as in the reference's CTE) and the top-k cut is a
    ``TakeOrderedAndProject`` below any scorer.
    """
    prods = star.products.select("product_id", "product_category", "product_detail", "unit_price").distinct()
    kept = top_k(prods, k, [F.desc("product_id")])
    prompt = concat_strict(PRODUCT_PROMPT[0], F.col("product_category"), PRODUCT_PROMPT[1],
                           F.col("product_detail"), PRODUCT_PROMPT[2],
                           F.col("unit_price").cast("string"), PRODUCT_PROMPT[3])
    return kept.select("product_id", "product_category", "product_detail", prompt.alias("prompt"))


def product_descriptions(star: Star, scorer: Scorer | None = None) -> DataFrame:
    prompts = product_prompts(star)
    scored = score_text(prompts, "prompt", scorer or keyword_generator("Description: "),
                        "product_description")
    return scored.select("product_id", "product_category", "product_detail", "product_description")


def sentiment_table(star: Star) -> DataFrame:
    """Reviews with a model sentiment column (default: Spark-native lexicon)."""
    r = star.reviews
    return r.select("review_id", "store_id", "email", "review", "score",
                    lexicon_sentiment("review").alias("sentiment"))


def limited_scores(star: Star, n: int = P.MIXED_LIMIT) -> DataFrame:
    """The first ``n`` reviews through a model and its store: the limit comes first, so no other text is scored.

    A second run over twice as many reviews scores the new texts only.
    """
    store = ScoredTexts(star.spark, scratch_path(star.spark, "scores"), lexicon_scorer())
    calls = [store.add(top_k(star.reviews.select("review_id", "review"), k, [F.asc("review_id")]), "review") for k in (n, 2 * n)]
    kept = top_k(star.reviews.select("review_id", "review"), 2 * n, [F.asc("review_id")])
    scored = store.score(kept, "review", "sentiment")
    return scored.select("review_id", "sentiment", F.lit(calls[0]).cast("bigint").alias("first_run"), F.lit(calls[1]).cast("bigint").alias("second_run"))


def sentiment_ctas(star: Star) -> DataFrame:
    """``CREATE OR REPLACE TABLE .. AS SELECT *, sentiment ..``, read back."""
    return create_table_as(sentiment_table(star), scratch_path(star.spark, "sentiment"))


def sentiment_counts(star: Star) -> DataFrame:
    return sentiment_table(star).groupBy("sentiment").agg(F.count("review_id").alias("total_reviews"))


def email_prompts(star: Star, n: int = P.MIXED_LIMIT) -> DataFrame:
    """Mixed reviews joined to their store, first ``n`` by id, with the e-mail prompt."""
    mixed = star.reviews_sentiment.filter(F.col("sentiment") == "mixed")
    combined = lookup(mixed, store_lookup(star)).select("review_id", "review", "email", "sentiment",
                                                         "store_name")
    kept = top_k(combined, n, [F.asc("review_id")])
    prompt = concat_strict(EMAIL_PROMPT[0], F.col("review"), EMAIL_PROMPT[1], F.col("store_name"),
                           EMAIL_PROMPT[2], F.col("email"), EMAIL_PROMPT[3], EMAIL_PROMPT[4])
    return kept.select("review_id", "email", email_to_name("email").alias("name_hint"),
                       prompt.alias("prompt"))


def generated_emails(star: Star, scorer: Scorer | None = None) -> DataFrame:
    prompts = email_prompts(star)
    scored = score_text(prompts, "prompt", scorer or keyword_generator("Email: "), "advertising_emails")
    return scored.select("review_id", "email", "advertising_emails")
