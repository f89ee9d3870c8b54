"""Incremental file ingest with Structured Streaming.

Each landing directory of CSV files (with a header) becomes an append-only
table.  A file stream with a checkpoint and ``trigger(availableNow=True)``
finds the files that came since the run before -- a triggered, not continuous,
pipeline -- and hands them on in micro-batches of a bounded number of files.

Columns go by name.  Every file's own header says what its columns are, so
files may differ in the order of columns, and may lack some or add new ones:
a batch reads the files of each distinct header with that header as schema,
and unites them by name.  A column that a file lacks is null in its rows.
Names that differ in upper and lower case only are one column.

The stream itself lists files and reads none of their content; headers come
from one job over the batch's files (first line of each).  All values stay
strings (the landing files carry no types).

Batches are written by :class:`~ledgerlens.streaming.batches.BatchTable`, so a
batch that is run again replaces itself.  A full refresh starts a new version
directory for both the table and its checkpoint, so readers of the old version
are never disturbed mid-write.
"""

from __future__ import annotations

import csv
import re
import urllib.parse
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import BatchTable, run_triggered

#: Files of a micro-batch at most; also the rows that the driver gets with their headers.
FILES_PER_BATCH = 1000

#: What Spark's source of whole files gives for each file.
LISTING_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


@dataclass(frozen=True)
class CsvTable:
    """One landing directory and its CSV options."""

    name: str
    subdir: str
    options: dict = field(default_factory=dict)


# The reference's four landed tables -- landing sub-folders
# Transactions, Stores (";"-separated), Customers and Products.
DEFAULT_TABLES = (
    CsvTable("transactions", "Transactions"),
    CsvTable("stores", "Stores", {"sep": ";"}),
    CsvTable("reviews", "Customers"),
    CsvTable("products", "Products"),
)


class HeaderError(ValueError):
    """A file's header cannot name columns."""


def _literal(path: str) -> str:
    """``path`` for readers that take patterns."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def file_headers(spark: SparkSession, paths: list[str], options: dict | None = None) -> dict[tuple[str, ...], list[str]]:
    """The files of each distinct header, by name; files without a line have none.

    The first line comes from the task that reads a file's first block, where
    lines arrive in order; one line for each file reaches the driver.
    """
    opts = options or {}
    lines = spark.read.option("encoding", opts.get("encoding", "UTF-8")).text([_literal(p) for p in paths])
    start = lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), "value").where("at = 0")
    first = start.groupBy("path").agg(F.first("value").alias("line"))
    found: dict[tuple[str, ...], list[str]] = {}
    for r in first.collect():
        names = next(csv.reader([r["line"].lstrip("\ufeff")], delimiter=opts.get("sep", ","), quotechar=opts.get("quote", '"')), [])
        folded = [n.lower() for n in names]
        if not all(names) or len(set(folded)) < len(folded):
            raise HeaderError(f"{r['path']}: column names are empty or repeated: {names}")
        found.setdefault(tuple(names), []).append(urllib.parse.unquote(r["path"]))
    return {h: sorted(found[h]) for h in sorted(found)}


def read_by_name(spark: SparkSession, paths: list[str], options: dict | None = None) -> DataFrame:
    """All rows of CSV files with headers, as strings, united by column name (regardless of case)."""
    frames, known = [], {}
    for header, some in file_headers(spark, paths, options).items():
        schema = T.StructType([T.StructField(n, T.StringType()) for n in header])
        table = spark.read.schema(schema).options(**{**(options or {}), "header": "true", "enforceSchema": "true"}).csv([_literal(p) for p in some])
        frames.append(table.select(*[F.col(f"`{n}`").alias(known.setdefault(n.lower(), n)) for n in header]))
    if not frames:
        return spark.createDataFrame([], T.StructType([]))
    return reduce(partial(DataFrame.unionByName, allowMissingColumns=True), frames)


def _join(*parts: str) -> str:
    return "/".join([parts[0].rstrip("/")] + [p.strip("/") for p in parts[1:]])


def current_version(spark: SparkSession, target_root: str, name: str) -> int | None:
    """The highest version in the table's pointer records (written by Spark, not the OS)."""
    try:
        rows = spark.read.json(_join(target_root, name, "_current")).collect()
    except AnalysisException:
        return None
    return max(int(r["version"]) for r in rows) if rows else None


def _set_version(spark: SparkSession, target_root: str, name: str, version: int) -> None:
    # Records are added, never replaced, so there is no moment without one.
    spark.createDataFrame([(version,)], "version int").coalesce(1).write.mode("append") \
        .json(_join(target_root, name, "_current"))


def table_path(target_root: str, name: str, version: int) -> str:
    return _join(target_root, name, f"v{version:04d}")


def start_ingest(spark: SparkSession, landing_root: str, table: CsvTable, target_root: str,
                 checkpoint_root: str, full_refresh: bool = False, files_per_batch: int = FILES_PER_BATCH):
    """Start one triggered ingest of ``table``; returns ``(query, finish)``.

    Files are picked up recursively, so each landing batch may sit in its own
    sub-folder; hidden and ``_``-prefixed paths (writers' temporary files) are
    never read.  A header with an empty or repeated name fails the run, and
    nothing of its batch is committed.  ``finish()`` waits for the query,
    records the table version and returns the number of new rows.
    """
    src = _join(landing_root, table.subdir)
    cur = current_version(spark, target_root, table.name)
    version = 1 if cur is None else cur + (1 if full_refresh else 0)
    ckpt = _join(checkpoint_root, table.name, f"v{version:04d}")
    # Only the paths are read: without its content column this source opens no file.
    found = (spark.readStream.format("binaryFile").schema(LISTING_SCHEMA).option("recursiveFileLookup", "true")
             .option("maxFilesPerTrigger", str(files_per_batch)).load(src).select("path"))

    def prepare(batch: DataFrame) -> tuple[DataFrame, int]:
        paths = sorted(r["path"] for r in batch.collect())
        return read_by_name(batch.sparkSession, paths, table.options), len(paths)

    query, wait = run_triggered(found, BatchTable(spark, table_path(target_root, table.name, version)), ckpt, prepare,
                                f"ingest_{table.name}_v{version}")

    def finish() -> int:
        rows = wait()
        if cur != version:
            _set_version(spark, target_root, table.name, version)
        return rows

    return query, finish


def ingest_table(spark: SparkSession, landing_root: str, table: CsvTable, target_root: str,
                 checkpoint_root: str, full_refresh: bool = False, files_per_batch: int = FILES_PER_BATCH) -> int:
    """Run one triggered ingest of ``table``; returns the number of new rows."""
    _, finish = start_ingest(spark, landing_root, table, target_root, checkpoint_root, full_refresh, files_per_batch)
    return finish()


VOLUME_CONF = "param.volume"
MODE_CONF = "pipeline.etl_mode"


def ingest_tables(spark: SparkSession, landing_root: str | None, target_root: str, checkpoint_root: str,
                  tables=DEFAULT_TABLES, full_refresh: bool | None = None) -> dict[str, int]:
    """Ingest every table of the set (one streaming query each, run concurrently).

    ``landing_root=None`` takes the root from the session conf ``param.volume``,
    the pipeline parameter of the reference's ingest layer; ``full_refresh=None``
    follows ``pipeline.etl_mode`` (``full_refresh`` or incremental).
    """
    if full_refresh is None:
        full_refresh = spark.conf.get(MODE_CONF, "incremental") == "full_refresh"
    if landing_root is None:
        landing_root = spark.conf.get(VOLUME_CONF, None)
        if not landing_root:
            raise ValueError(f"no landing root given and {VOLUME_CONF} is not set")
    # All streams start first and run concurrently; then each is awaited.
    started = {t.name: start_ingest(spark, landing_root, t, target_root, checkpoint_root, full_refresh)
               for t in tables}
    return {name: finish() for name, (_, finish) in started.items()}


def read_ingested(spark: SparkSession, target_root: str, name: str, number: str | None = None) -> DataFrame:
    """The table's current version, all columns as strings; ``number`` names a column with the row's batch."""
    version = current_version(spark, target_root, name)
    if version is None:
        raise FileNotFoundError(f"table {name} has not been ingested under {target_root}")
    return BatchTable(spark, table_path(target_root, name, version)).read(number=number)


def land_csv(df: DataFrame, landing_root: str, table: CsvTable, batch_label: str) -> str:
    """Write ``df`` as CSV files with a header into a new landing sub-folder."""
    path = _join(landing_root, table.subdir, batch_label)
    df.write.mode("errorifexists").options(header="true", **table.options).csv(path)
    return path


def typed_layer(raw: DataFrame, ddl: str, path: str, corrupt: str | None = None, file: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Cast the columns of ``raw`` to declared types, and keep apart what can't be; returns ``(good, rejected)``.

    ``ddl`` is a schema string such as ``"store_id bigint, unit_price decimal(10,2)"``;
    columns not named keep their type.  A row is rejected if a value is present
    and its cast fails, or if ``corrupt`` (the reader's column for records it
    could not parse) is set.  Both kinds are written below ``path`` in one pass
    over ``raw``, each to its own partition.  ``rejected`` has one row for each
    rejected row of the input: its columns as far as they could be cast, the
    failures as an array of (``column``, ``value``), and the file it came from
    (column ``file`` of ``raw``), so good and rejected rows add up to the input.
    """
    spark = raw.sparkSession
    types = {f.name: f.dataType for f in spark.createDataFrame([], ddl).schema.fields}      # DDL parsed by Spark itself
    kept = [c for c in raw.columns if c not in (corrupt, file)]
    cast = {c: F.col(f"`{c}`").try_cast(types[c]) if c in types else F.col(f"`{c}`") for c in kept}

    def failure(name: str, value) -> Column:
        return F.struct(F.lit(name).alias("column"), value.cast("string").alias("value"))

    found = [F.when(F.col(f"`{c}`").isNotNull() & cast[c].isNull(), failure(c, F.col(f"`{c}`"))) for c in kept if c in types]
    if corrupt is not None:
        found.append(F.when(F.col(f"`{corrupt}`").isNotNull(), failure(corrupt, F.col(f"`{corrupt}`"))))
    none = F.array().cast("array<struct<column:string,value:string>>")
    failures = F.array_compact(F.array(*found)) if found else none
    source = (F.col(f"`{file}`") if file else F.lit(None)).cast("string")
    out = raw.select(*[cast[c].alias(c) for c in kept], failures.alias("__failures"), source.alias("__file")).withColumn("__rejected", F.size("__failures") > 0)
    out.write.partitionBy("__rejected").parquet(path)
    back = spark.read.schema(out.schema).parquet(path)
    columns = [F.col(f"`{c}`") for c in kept]
    return (back.where(~F.col("__rejected")).select(*columns),
            back.where("__rejected").select(*columns, F.col("__failures").alias("failures"), F.col("__file").alias("file")))


def read_json_checked(spark: SparkSession, source: str, ddl: str, path: str) -> tuple[DataFrame, DataFrame]:
    """JSON lines with a declared schema as ``(good, rejected)``: a record that does not parse, or has a value
    of another type, is rejected with its text (see :func:`typed_layer`)."""
    bad, file = "_corrupt_record", "__source"
    rows = spark.read.schema(f"{ddl}, {bad} string").option("columnNameOfCorruptRecord", bad).json(source)
    return typed_layer(rows.withColumn(file, F.col("_metadata.file_path")), ddl, path, corrupt=bad, file=file)
