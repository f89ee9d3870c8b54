"""Mixing sources to target weights by systematic sampling, with DataFrame functions only.

Targets: every source asks for its weight's share of all words and stops at
``MOST`` times its own size; the excess goes to the others by weight.  The
final level is found in closed form from the sources ordered by the level at
which each of them stops.

Sampling: a source's rate is its target over its size, the expected number of
copies of each of its documents.  The documents of a source are put in an
order by size, each one's expected copies are added up along it (rate times
rank, as the rate is one number), one random offset per source is added, and a
document is taken once for each integer that its stretch crosses.  Ordering by
size makes the sample follow the size distribution, so the words taken come
near the target.  The order is (size band, hash bucket, size, doc_id); ranks
are counted per band and bucket, so a source with a third of all rows is
spread over thousands of groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, shared_table, word_array

WEIGHTS = (5, 2, 1)
#: A target is at most so many times its source's size, and so are a document's copies.
MOST = 3
SEED = "mix-1"
#: Hash buckets of each (source, size band).
BUCKETS = 128


def _hash(*parts: Column) -> Column:
    """28 bits of an MD5, the same in every engine."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 7), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, most: float = MOST) -> DataFrame:
    """``source_key``, ``source_size`` and ``target`` from ``sizes`` (source_key, source_size; one row per source).

    Sources take the weights in turn in the order of their keys (code points,
    null last).  A source's limit over its weight is the level at which it
    stops, so with the sources in that order the level is what is left after
    the full ones, over the weights of the others.
    """
    by_name = Window.orderBy("source_key")
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int")).cast("double")
    own = sizes.withColumn("_weight", weight).withColumn("_limit", F.lit(float(most)) * F.col("source_size"))
    by_stop = Window.orderBy(F.col("_limit") / F.col("_weight"), "source_key")
    total = F.sum("source_size").over(Window.partitionBy()).cast("double")
    before = F.coalesce(F.sum("_limit").over(by_stop.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    others = F.sum("_weight").over(by_stop.rowsBetween(0, Window.unboundedFollowing))
    level = own.withColumn("_level", (total - before) / others)
    fits = F.when(F.col("_level") * F.col("_weight") <= F.col("_limit"), F.col("_level"))
    first = F.first(fits, ignorenulls=True).over(by_stop.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    share = F.least(F.col("_limit"), F.coalesce(first, F.lit(float("inf"))) * F.col("_weight"))
    return level.select("source_key", "source_size", F.when(F.col("source_size") > 0, share).otherwise(F.lit(0.0)).alias("target"))


def mix_documents(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST, seed: str = SEED, row: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken (copies times size) of every row of ``docs``.

    Size is the number of words; a null or empty text has none and is never
    taken.  A null source is a source of its own, last in order.  Rows with
    the same doc_id are documents of their own; a null doc_id comes first
    among equal sizes.  The columns ``row`` go along and decide ties of
    the order; others are ignored.  An empty table gives an empty result.
    """
    key = F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), "source"))
    # Grouping by source is combined in every task before it is shuffled.
    sized = shared_table(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "text", *row).select(
        "doc_id", "source", key.alias("source_key"), F.size(word_array(F.col("text"))).cast("long").alias("size"),
        # Rows of one id, or of none, are spread by their texts.
        F.md5(F.coalesce("text", F.lit(""))).alias("_digest"), *row), "sizes")
    goal = targets(sized.groupBy("source_key").agg(F.sum("size").alias("source_size")), weights, most)
    goal = shared_table(goal, "targets")
    bits = F.length(F.bin("size"))
    band = bits * 8 + F.expr("shiftright(size, greatest(length(bin(size)) - 3, 0))").cast("int")  # four for each doubling
    bucket = _hash(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("_digest"), F.lit(seed)) % BUCKETS
    keyed = sized.withColumn("_band", band).withColumn("_bucket", bucket).drop("_digest")
    cells = keyed.groupBy("source_key", "_band", "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("source_key").orderBy("_band", "_bucket").rowsBetween(Window.unboundedPreceding, -1)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = _hash(F.col("source_key"), F.lit(seed), F.lit("offset")) / F.lit(float(1 << 28))
    cells = cells.join(goal, "source_key").select(
        "source_key", "_band", "_bucket", "source_size", "target", rate.alias("_rate"), offset.alias("_offset"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("source_key", "_band", "_bucket").orderBy("size", "doc_id", *row)
    placed = keyed.withColumn("_place", F.row_number().over(inside)).join(cells, ["source_key", "_band", "_bucket"])
    rank = F.col("_before") + F.col("_place")
    crossed = F.floor(F.col("_offset") + F.col("_rate") * rank) - F.floor(F.col("_offset") + F.col("_rate") * (rank - 1))
    copies = F.when(F.col("size") > 0, F.least(crossed, F.lit(most))).otherwise(F.lit(0)).cast("long")
    return placed.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"), *row)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: words of each document and of its source, the source's target, and words taken."""
    return mix_documents(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def resample(docs: DataFrame) -> DataFrame:
    """``docs`` with each row as often as the mix takes that row.

    Rows that share a doc_id, or have none, and repeated rows stay apart: each
    has a number of its own, which also decides ties of the order.  Columns of
    any name are kept.  Null and empty texts are never taken, so they go; an
    empty table gives an empty result.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    numbered = shared_table(docs.select(row, F.monotonically_increasing_id().alias("number")), "rows")  # written, so the numbers stay
    own = numbered.select("row.doc_id", "row.source", "row.text", F.xxhash64("row.text").alias("digest"), "number")
    taken = mix_documents(own, row=("digest", "number"))
    copied = numbered.join(taken.where("copies > 0").select("number", F.col("copies").cast("int").alias("copies")), "number")
    return copied.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")


ORACLE = f"""
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS source_key,
         md5(coalesce(text, '')) AS digest, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source_key, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source_key),
w AS (SELECT *, CAST([5, 2, 1][(row_number() OVER (ORDER BY source_key) - 1) % 3 + 1] AS DOUBLE) AS weight,
             CAST({MOST} * source_size AS DOUBLE) AS cap FROM s),
l AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE)
              - coalesce(sum(cap) OVER (ORDER BY cap / weight, source_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(weight) OVER (ORDER BY cap / weight, source_key ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
f AS (SELECT *, first_value(CASE WHEN level * weight <= cap THEN level END IGNORE NULLS) OVER (
             ORDER BY cap / weight, source_key ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS lv FROM l),
t AS (SELECT source_key, source_size, CASE WHEN source_size > 0 THEN least(cap, coalesce(lv, 'inf'::DOUBLE) * weight) ELSE 0 END AS target,
             CAST(('0x' || substr(md5(source_key || ':{SEED}:offset'), 1, 7)) AS BIGINT) / 268435456.0 AS u FROM f),
k AS (SELECT *, length(bin(size)) * 8 + (size >> greatest(length(bin(size)) - 3, 0)) AS band,
             CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || digest || ':{SEED}'), 1, 7)) AS BIGINT) % {BUCKETS} AS bucket FROM d),
r AS (SELECT k.*, t.source_size, t.target, t.u, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
             row_number() OVER (PARTITION BY k.source_key ORDER BY band, bucket, size, doc_id NULLS FIRST) AS rank
      FROM k JOIN t USING (source_key))
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN size = 0 THEN 0 ELSE least(floor(u + rate * rank) - floor(u + rate * (rank - 1)), {MOST}) * size END AS BIGINT) AS taken
FROM r
"""
