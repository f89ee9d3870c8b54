"""A store of scored texts, so that a text goes to the model once, whatever runs ask for it.

Scores are kept by text (and its hash, which the joins go by first).  A run
scores only texts that the store does not have, adds them as one batch and
joins its rows with the store.  A batch that died before its record was
written is unseen and is written again by the next run; one run at a time may
add to a store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..streaming.batches import BatchTable
from .inference import Scorer, iterator_udf

HASH, TEXT, SCORE = "__hash", "__text", "__score"


class ScoredTexts:
    """Scores by ``scorer`` below ``path``; give each model its own path."""

    def __init__(self, spark: SparkSession, path: str, scorer: Scorer, out_type: str = "string"):
        self.table = BatchTable(spark, path)
        self.udf = iterator_udf(scorer, out_type)
        self.schema = T.StructType([T.StructField(HASH, T.LongType()), T.StructField(TEXT, T.StringType()), T.StructField(SCORE, self.udf.returnType)])

    def scores(self) -> DataFrame:
        """All stored texts: their hash, text and score."""
        return self.table.read(self.schema)

    def unseen(self, df: DataFrame, col: str) -> DataFrame:
        """Distinct texts of ``df[col]`` without a score; a null is no text."""
        texts = df.select(F.xxhash64(F.col(col)).alias(HASH), F.col(col).alias(TEXT)).where(F.col(TEXT).isNotNull()).distinct()
        return texts.join(self.scores().select(HASH, TEXT), [HASH, TEXT], "left_anti")

    def add(self, df: DataFrame, col: str) -> int:
        """Score what is unseen and keep it; the number of texts that went to the model."""
        new = self.unseen(df, col)
        if new.isEmpty():
            return 0
        return self.table.write(new.withColumn(SCORE, self.udf(F.col(TEXT))), self.table.last() + 1)

    def score(self, df: DataFrame, col: str, out: str) -> DataFrame:
        """``df`` with column ``out``: the score of ``df[col]``, NULL for NULL."""
        self.add(df, col)
        known = self.scores().withColumnRenamed(SCORE, out)
        keyed = df.withColumn(HASH, F.xxhash64(F.col(col))).withColumn(TEXT, F.col(col))
        return keyed.join(known, [HASH, TEXT], "left").select(*[F.col(f"`{c}`") for c in df.columns], F.col(f"`{out}`"))
