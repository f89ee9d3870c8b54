"""File sources and sinks: JSON with a DDL schema, default-format loads,
partitioned directories, append sinks that count in the same pass, CTAS and
table clones.

No path is hard-coded: callers pass locations, and scratch output goes under
the session's ``spark.checkpoint.dir`` (a shared folder on a cluster).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh directory under the shared checkpoint root."""
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def read_json(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """JSON with an explicit schema (no inference pass over the files)."""
    return spark.read.schema(ddl).json(path)


def read_default(spark: SparkSession, path: str) -> DataFrame:
    """``spark.read.load(path)``: the session's default source (parquet here)."""
    return spark.read.load(path)


def write_partitioned(df: DataFrame, path: str, partition_cols, fmt: str = "parquet") -> str:
    """Write ``df`` as ``col=value/`` directories (overwrite)."""
    df.write.mode("overwrite").partitionBy(*partition_cols).format(fmt).save(path)
    return path


def read_partitioned(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a partitioned directory; filters on partition columns prune directories."""
    return spark.read.format(fmt).load(path)


def append_counted(df: DataFrame, path: str, fmt: str = "json", partition_by=None,
                   overwrite_partitions: bool = False) -> int:
    """Append ``df`` and return its row count, measured in the same pass.

    An :class:`Observation` counts rows as they are written, so the source is
    read once -- no cache and no second ``count()`` job.  With
    ``overwrite_partitions`` only the partitions present in ``df`` are
    replaced, which makes a retried batch idempotent.
    """
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if overwrite_partitions:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    writer.save(path)
    return int(obs.get["rows"])


def create_table_as(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """``CREATE OR REPLACE TABLE t AS (SELECT ...)`` on a path; returns the table."""
    df.write.mode("overwrite").format(fmt).save(path)
    return df.sparkSession.read.format(fmt).load(path)


def clone_table(spark: SparkSession, name: str, source_path: str, mode: str = "reference",
                fmt: str = "parquet", target_path: str | None = None) -> DataFrame:
    """Register table ``name`` from the files at ``source_path``.

    ``mode="reference"`` points an external table at the same files (cheap,
    like a shallow clone, but later changes to the source files show through:
    it does not isolate).  ``mode="copy"`` writes a full copy to
    ``target_path`` (a deep clone).
    """
    if mode == "reference":
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, path=source_path, source=fmt)
    elif mode == "copy":
        if target_path is None:
            raise ValueError("mode='copy' needs target_path")
        spark.read.format(fmt).load(source_path).write.mode("overwrite").format(fmt).save(target_path)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, path=target_path, source=fmt)
    else:
        raise ValueError("mode must be 'reference' or 'copy'")
    return spark.table(name)


def use_namespace(spark: SparkSession, database: str, create: bool = True) -> None:
    """``USE SCHEMA db`` (created first when asked)."""
    if create:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.catalog.setCurrentDatabase(database)


def write_bucketed(df: DataFrame, table: str, keys, buckets: int, path: str | None = None) -> DataFrame:
    """Save ``df`` as a table bucketed and sorted by ``keys`` (overwrite).

    Two tables bucketed the same way on their join key join without a
    shuffle (each bucket pair is joined locally) -- the layout for joins
    where both sides grow with the data, such as documents with their labels.
    ``path`` puts the files in a shared location (an external table).
    """
    writer = df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)
