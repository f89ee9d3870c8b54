"""A table made of numbered batches, each in a folder of its own, with a log of what every batch held.

A micro-batch may be handed to its sink again after a failure, with the same
number and the same input.  :meth:`BatchTable.write` therefore replaces the
batch's folder and then its log record, so a batch counts once however often
it is written.  Readers take only batches that are in the log, so a folder
whose record is still missing is not seen.

Everything is written and read by Spark below one path, which on a cluster is
a shared folder; nothing is kept on the driver between runs.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_SCHEMA = "batch long, rows long, files long, columns string"


def with_count(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` that reports its number of rows (``rows``) in the pass that writes it."""
    seen = Observation(f"rows_{uuid.uuid4().hex[:12]}")
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


class BatchTable:
    """Batches below ``path``: ``_batch_no=<number>/`` with the rows, ``_batches/`` with the log."""

    NUMBER = "_batch_no"

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def log(self) -> DataFrame:
        """One row for each finished batch: ``batch``, ``rows``, ``files`` and its columns (a JSON list)."""
        try:
            return self.spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", "true").json(f"{self.path}/_batches")
        except AnalysisException:
            return self.spark.createDataFrame([], LOG_SCHEMA)

    def last(self) -> int:
        """Number of the last finished batch, -1 before the first."""
        return self.log().agg(F.coalesce(F.max("batch"), F.lit(-1))).first()[0]

    def rows_since(self, batch: int) -> int:
        """Rows of the finished batches after number ``batch``."""
        return self.log().where(F.col("batch") > batch).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]

    def write(self, df: DataFrame, batch: int, files: int = 0) -> int:
        """Write (or write again) one batch; the number of its rows, counted in the same pass."""
        rows = 0
        if df.columns:  # a batch of empty files has no columns and leaves only its record
            counted, seen = with_count(df)
            counted.write.mode("overwrite").parquet(f"{self.path}/{self.NUMBER}={batch}")
            rows = int(seen.get["rows"])
        record = self.spark.createDataFrame([(batch, rows, files, json.dumps(df.columns))], LOG_SCHEMA)
        record.coalesce(1).write.mode("overwrite").json(f"{self.path}/_batches/batch-{batch}")
        return rows

    def columns(self) -> list[str]:
        """Columns of all finished batches, in the order in which they first came."""
        lists = self.log().groupBy("columns").agg(F.min("batch").alias("first")).orderBy("first").collect()
        names: dict[str, str] = {}
        for r in lists:  # a row for each distinct set of columns
            for c in json.loads(r["columns"]):
                names.setdefault(c.lower(), c)
        return list(names.values())

    def read(self, schema: T.StructType | None = None, number: str | None = None) -> DataFrame:
        """All finished batches, with the batch's number as column ``number`` if it is named.

        Without ``schema`` every column is a string, and one that a batch lacks is null.
        """
        if schema is None:
            schema = T.StructType([T.StructField(c, T.StringType()) for c in self.columns()])
        whole = T.StructType([*schema.fields, T.StructField(self.NUMBER, T.LongType())])
        if self.rows_since(-1):
            table = self.spark.read.schema(whole).parquet(self.path).where(F.col(self.NUMBER) <= self.last())
        else:
            table = self.spark.createDataFrame([], whole)
        return table.withColumnRenamed(self.NUMBER, number) if number else table.drop(self.NUMBER)


def run_triggered(stream: DataFrame, table: BatchTable, checkpoint: str,
                  prepare: Callable[[DataFrame], tuple[DataFrame, int]] | None = None, name: str | None = None):
    """Start a run that takes what is there now in bounded micro-batches and stops; returns ``(query, finish)``.

    ``prepare`` makes of a micro-batch the rows to write and the number of its
    files.  ``finish()`` waits and returns the rows that this run added, from
    the batches' own records: the query's progress keeps only its last 100.
    """
    before = table.last()

    def sink(batch: DataFrame, number: int) -> None:
        rows, files = prepare(batch) if prepare else (batch, 0)
        BatchTable(batch.sparkSession, table.path).write(rows, number, files)

    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query = (writer.queryName(name) if name else writer).start()

    def finish() -> int:
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
        return table.rows_since(before)

    return query, finish
