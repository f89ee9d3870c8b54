"""Replay a batch-numbered source into a landing directory, batch by batch.

A *rule* names the rows of batches ``start..end`` of a source and gives every
row its batch number.  :class:`BatchReplay` lands batches in order: one for
each ``load()``, all that are left for ``load(continuous=True)``, none once the
source is exhausted.

Where a replay stands is kept in a log beside the landing directory: one
record for each landed batch with its number and its rows, only ever added to;
the highest number wins.  Rows are counted in the pass that writes them.  A
batch is written before its record, each batch into a folder of its own that a
second write replaces, so a replay that died in between lands the same batch
again and neither loses nor repeats a row.  One replay at a time may write a
landing directory.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import batch_from_date_after, batch_from_date_through, epoch_to_date
from ..sources.fixtures import REPLAY_PIVOT_DATE

BATCH_COL = "batch"
LOG_SCHEMA = "batch int, rows long"
#: Batches that one write takes at most (each has an expression that counts it).
BATCHES_PER_WRITE = 200


# ------------------------------------------------------------------ batch rules

def _in_batches(source: DataFrame, number: Column, start: int, end: int, without: tuple[str, ...] = ()) -> DataFrame:
    kept = [F.col(f"`{c}`") for c in source.columns if c not in (*without, BATCH_COL)]
    return source.select(*kept, number.alias(BATCH_COL)).where(F.col(BATCH_COL).between(start, end))


def user_reg_batches(source: DataFrame, start: int, end: int, pivot: str = REPLAY_PIVOT_DATE) -> DataFrame:
    """Registrations: batch 1 before the pivot date, afterwards the day of the month plus one."""
    return _in_batches(source, batch_from_date_after(epoch_to_date("registration_timestamp"), pivot), start, end)


def cdc_batches(source: DataFrame, start: int, end: int) -> DataFrame:
    """Change rows, by the batch number that they carry; copied, not merged."""
    return _in_batches(source, F.col(BATCH_COL), start, end)


def daily_batches(source: DataFrame, start: int, end: int, pivot: str = REPLAY_PIVOT_DATE) -> DataFrame:
    """Daily rows without their date columns: batch 1 up to and including the pivot date, then the day of the month."""
    return _in_batches(source, batch_from_date_through("date", pivot), start, end, ("date", "week_part"))


# ------------------------------------------------------------------ the replayer

class BatchReplay:
    """Lands batches ``1..max_batch`` of ``batches(start, end)`` as ``batch=<n>`` folders of ``target_dir``."""

    def __init__(self, spark: SparkSession, batches: Callable[[int, int], DataFrame], target_dir: str,
                 max_batch: int, fmt: str = "json"):
        self.spark = spark
        self.batches = batches
        self.target_dir = target_dir.rstrip("/")
        self.max_batch = max_batch
        self.fmt = fmt

    def log(self) -> DataFrame:
        """``batch`` and ``rows`` of every landed batch."""
        try:  # "_"-prefixed: readers of the landing directory never see it
            return self.spark.read.schema(LOG_SCHEMA).json(f"{self.target_dir}/_landed")
        except AnalysisException:
            return self.spark.createDataFrame([], LOG_SCHEMA)

    @property
    def batch(self) -> int:
        """Number of the next batch."""
        return self.log().agg(F.coalesce(F.max("batch"), F.lit(0)) + 1).first()[0]

    def _land(self, start: int, end: int) -> list[tuple[int, int]]:
        """Write (or write again) the folders of some batches; each batch's rows."""
        df = self.batches(start, end)
        if BATCH_COL not in df.columns:
            raise ValueError("a batch rule must keep the batch column")
        seen = Observation(f"landed_{uuid.uuid4().hex[:12]}")
        counts = [F.count_if(F.col(BATCH_COL) == n).alias(f"rows_{n}") for n in range(start, end + 1)]
        (df.observe(seen, *counts).write.format(self.fmt).partitionBy(BATCH_COL).mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").save(self.target_dir))
        rows = seen.get
        return [(n, int(rows[f"rows_{n}"])) for n in range(start, end + 1)]

    def _record(self, landed: list[tuple[int, int]]) -> None:
        self.spark.createDataFrame(landed, LOG_SCHEMA).coalesce(1).write.mode("append").json(f"{self.target_dir}/_landed")

    def load(self, continuous: bool = False) -> int:
        """Land the next batch (or all remaining); the number of rows landed, 0 when the source is exhausted."""
        start, total = self.batch, 0
        last = self.max_batch if continuous else min(start, self.max_batch)
        while start <= last:
            end = min(last, start + BATCHES_PER_WRITE - 1)
            landed = self._land(start, end)
            self._record(landed)
            total += sum(rows for _, rows in landed)
            start = end + 1
        return total

    def read(self, ddl: str) -> DataFrame:
        """What has been landed, with its batch number; ``ddl`` names the columns beside it."""
        if not self.log().head(1):
            return self.spark.createDataFrame([], f"{ddl}, {BATCH_COL} int")
        done = self.batch
        return self.spark.read.format(self.fmt).schema(f"{ddl}, {BATCH_COL} int").load(self.target_dir).where(F.col(BATCH_COL) < done)
