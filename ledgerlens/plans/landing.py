"""Queries over the replay, file and streaming-ingest paths.

Each query derives its input from the driver's tables with Spark, writes where
the operator writes (under the session's shared checkpoint folder) and returns
what a reader of the result sees.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions.scalars import batch_from_date_after, epoch_to_date
from ..sources.files import (append_counted, clone_table, create_table_as, read_default, read_json, read_partitioned,
                             scratch_path, write_partitioned)
from ..sources.fixtures import REPLAY_PIVOT_DATE, Star
from ..sources.tables import table_path
from .star import SCANNED, row_content
from ..streaming import ingest as I
from ..streaming.batches import BatchTable, run_triggered
from ..streaming.replay import BATCH_COL, BatchReplay, cdc_batches, daily_batches, user_reg_batches


def replay_user_reg(star: Star, rng=P.REPLAY_RANGE) -> DataFrame:
    return user_reg_batches(star.registrations, *rng).drop(BATCH_COL)


REGISTRATIONS_DDL = "device_id long, mac_address string, registration_timestamp double, user_id long"
LAST_BATCH = 32         # a day of the month, plus one


def _landed_registrations(star: Star) -> BatchReplay:
    """A replay of the registrations: two single loads, the rest at once, and one load too many."""
    target = scratch_path(star.spark, "user-reg")
    for continuous in (False, False, True, False):      # a new replayer each time, as after a restart
        replay = BatchReplay(star.spark, lambda a, b: user_reg_batches(star.registrations, a, b), target, LAST_BATCH)
        replay.load(continuous)
    return replay


def replayed_registrations(star: Star) -> DataFrame:
    """Every landed row, read back from JSON, with its batch and the batch's rows as the replay counted them."""
    replay = _landed_registrations(star)
    counted = replay.log().withColumnRenamed("rows", "batch_rows")      # one row for each batch
    return replay.read(REGISTRATIONS_DDL).join(counted, BATCH_COL)


def batch_counts(star: Star) -> DataFrame:
    """The replay's log: rows of each landed batch, empty ones too."""
    return _landed_registrations(star).log()


def appended_json(star: Star, ranges=((1, 2), (3, 7), (8, 31))) -> DataFrame:
    """Change rows appended to one JSON directory in three writes, read back with a declared schema."""
    path = scratch_path(star.spark, "cdc")
    counts = [append_counted(cdc_batches(star.change_rows, *r), path) for r in ranges]
    back = read_json(star.spark, path, "event_id long, user_id long, op string, value double, batch int")
    return back.withColumn("rows_appended", F.lit(sum(counts)).cast("bigint"))


def replay_cdc(star: Star, rng=P.BATCH_RANGE) -> DataFrame:
    return cdc_batches(star.change_rows, *rng)


def replay_daily(star: Star, rng=P.REPLAY_RANGE) -> DataFrame:
    return daily_batches(star.daily_events, *rng).drop(BATCH_COL)


def with_column_drop(star: Star) -> DataFrame:
    """Helper columns added for a filter and dropped before the write."""
    return user_reg_batches(star.registrations, 1, 1).drop(BATCH_COL)


def batch_numbers(star: Star) -> DataFrame:
    r = star.registrations
    return r.select("device_id", batch_from_date_after(epoch_to_date("registration_timestamp"),
                                                       REPLAY_PIVOT_DATE).alias("batch"))


def registration_dates(star: Star) -> DataFrame:
    r = star.registrations
    return r.select("device_id", epoch_to_date("registration_timestamp").alias("registration_date"))


def default_format(star: Star) -> DataFrame:
    return read_default(star.spark, table_path(star.sf_dir, "customer"))


def partitioned_roundtrip(star: Star, topic: str = "click") -> DataFrame:
    """Write daily rows as ``topic=/week_part=`` directories, read one topic back.

    The topic filter prunes directories: only ``topic=click`` files are listed.
    """
    path = write_partitioned(star.daily_events, scratch_path(star.spark, "daily"), ["topic", "week_part"])
    back = read_partitioned(star.spark, path).filter(F.col("topic") == topic)
    return back.select("event_id", "user_id", "value", "date", "topic")


def _ingest_roundtrip(star: Star, df: DataFrame, table: I.CsvTable) -> DataFrame:
    root = scratch_path(star.spark, "ingest")
    landing, target, ckpt = f"{root}/landing", f"{root}/tables", f"{root}/checkpoints"
    I.land_csv(df, landing, table, "batch-0001")
    I.ingest_table(star.spark, landing, table, target, ckpt)
    return I.read_ingested(star.spark, target, table.name)


def ingest_products(star: Star) -> DataFrame:
    """Products landed as comma CSV and ingested by a triggered file stream."""
    return _ingest_roundtrip(star, star.products, I.CsvTable("products", "Products"))


def ingest_stores(star: Star) -> DataFrame:
    """Stores landed as ``;``-separated CSV and ingested by a triggered file stream."""
    return _ingest_roundtrip(star, star.stores, I.CsvTable("stores", "Stores", {"sep": ";"}))


# The landed tables of the set; reviews have line breaks and quotes in their texts.
TABLE_SET = (
    I.CsvTable("transactions", "Transactions"),
    I.CsvTable("stores", "Stores", {"sep": ";"}),
    I.CsvTable("reviews", "Customers", {"multiLine": "true", "escape": '"'}),
    I.CsvTable("products", "Products"),
)


def ingest_table_set(star: Star) -> DataFrame:
    """Four tables landed twice and ingested after each landing; every row of both landings, once.

    Each table's files are in the reverse column order the second time, and the
    transactions' second landing brings a column that the first one lacks.
    """
    root = scratch_path(star.spark, "table-set")
    landing, target, ckpt = f"{root}/landing", f"{root}/tables", f"{root}/checkpoints"
    sources = {"transactions": star.fct, "stores": star.stores, "reviews": star.reviews, "products": star.products}
    for half in (0, 1):
        for table in TABLE_SET:
            cols = SCANNED[table.name]
            rows = sources[table.name].where(F.abs(F.col(cols[0])) % 2 == half).select(*(reversed(cols) if half else cols))
            if half and table.name == "transactions":
                rows = rows.withColumn("channel", F.lit("web"))
            I.land_csv(rows, landing, table, f"landing-{half}")
        I.ingest_tables(star.spark, landing, target, ckpt, TABLE_SET, full_refresh=False)
    out = []
    for table in TABLE_SET:
        cols = SCANNED[table.name]
        rows = I.read_ingested(star.spark, target, table.name)
        if table.name == "reviews":
            rows = rows.withColumn("review", F.md5(F.coalesce("review", F.lit(""))))
        shown = (*cols, "channel") if table.name == "transactions" else cols
        out.append(rows.select(F.lit(table.name).alias("table_name"), F.col(cols[0]).cast("bigint").alias("row_key"), row_content(*shown).alias("content")))
    return reduce(DataFrame.unionByName, out)


def incremental_append(star: Star) -> DataFrame:
    """Registrations landed in three parts with an ingest run after each: every row once, with the run that took it."""
    root = scratch_path(star.spark, "append")
    table = I.CsvTable("registrations", "Registrations")
    for part in range(3):
        I.land_csv(star.registrations.where(F.col("device_id") % 3 == part), f"{root}/landing", table, f"part-{part}")
        I.ingest_table(star.spark, f"{root}/landing", table, f"{root}/tables", f"{root}/checkpoints")
    rows = I.read_ingested(star.spark, f"{root}/tables", table.name, number="run")
    return rows.select(F.col("device_id").cast("bigint").alias("device_id"), "mac_address", F.col("user_id").cast("bigint").alias("user_id"), "run")


def full_refresh(star: Star) -> DataFrame:
    """Stores landed and ingested, landed once more and ingested by a full refresh: the second version holds both landings."""
    root = scratch_path(star.spark, "refresh")
    table = I.CsvTable("stores", "Stores", {"sep": ";"})
    for label, refresh in (("first", False), ("second", True)):
        I.land_csv(star.stores, f"{root}/landing", table, label)
        I.ingest_table(star.spark, f"{root}/landing", table, f"{root}/tables", f"{root}/checkpoints", full_refresh=refresh)
    version = I.current_version(star.spark, f"{root}/tables", table.name)
    return I.read_ingested(star.spark, f"{root}/tables", table.name).withColumn("version", F.lit(version).cast("int"))


TRIGGERED_FILES = 104


def triggered_batches(star: Star) -> DataFrame:
    """Events in over 100 files, taken by one triggered run a file at a time: rows by type beside the run's own count."""
    spark, root = star.spark, scratch_path(star.spark, "triggered")
    events = star.table("events").select("event_id", "event_type", "user_id")
    events.repartition(TRIGGERED_FILES).write.parquet(f"{root}/landing")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", "1").parquet(f"{root}/landing")
    table = BatchTable(spark, f"{root}/table")
    _, finish = run_triggered(stream, table, f"{root}/checkpoint")
    added = finish()
    return table.read(events.schema).groupBy("event_type").agg(F.count("event_id").alias("rows")).select(
        "event_type", "rows", F.lit(added).cast("bigint").alias("rows_of_run"), F.lit(table.last() + 1 > 100).alias("over_100_batches"))


PRODUCTS_DDL = "product_id bigint, product_category string, product_detail string, unit_price decimal(10,2)"


def _with_rejects(good: DataFrame, rejected: DataFrame) -> DataFrame:
    """Good rows and rejected ones, those with their first failure."""
    first = F.get("failures", F.lit(0))
    nothing = F.lit(None).cast("string")
    return good.select("*", nothing.alias("failed_column"), nothing.alias("failed_value")).unionByName(
        rejected.select(*[F.col(c) for c in good.columns], first["column"].alias("failed_column"), first["value"].alias("failed_value")))


def ingest_products_typed(star: Star) -> DataFrame:
    """Products landed as CSV, some with a price that is none, and ingested as strings: the typed layer's good and rejected rows."""
    priced = star.products.withColumn("unit_price", F.when(F.col("product_id") % 10 == 3, F.lit("on request")).otherwise(F.col("unit_price").cast("string")))
    raw = _ingest_roundtrip(star, priced, I.CsvTable("products", "Products"))
    both = _with_rejects(*I.typed_layer(raw, PRODUCTS_DDL, scratch_path(star.spark, "typed")))
    return both.withColumn("unit_price", F.col("unit_price").cast("double"))


def checked_json(star: Star) -> DataFrame:
    """Registrations as JSON lines, some cut off and some with a word for a number: good and rejected records."""
    src, path = star.registrations, scratch_path(star.spark, "json-lines")
    head = F.concat(F.lit('{"device_id":'), F.col("device_id").cast("string"), F.lit(',"mac_address":"'), F.col("mac_address"), F.lit('"'))
    user = F.when(F.col("device_id") % 10 == 7, F.lit('"someone"')).otherwise(F.col("user_id").cast("string"))
    whole = F.concat(head, F.lit(',"user_id":'), user, F.lit("}"))
    src.select(F.when(F.col("device_id") % 10 == 3, head).otherwise(whole).alias("value")).write.text(path)
    good, rejected = I.read_json_checked(star.spark, path, "device_id long, mac_address string, user_id long", scratch_path(star.spark, "json-typed"))
    # Of a rejected record only its text counts: how much of it a parser understood is not promised.
    unread = [F.lit(None).cast(f.dataType).alias(f.name) for f in good.schema.fields]
    return _with_rejects(good, rejected.select(*unread, "failures", "file"))


def cloned_products(star: Star) -> DataFrame:
    """A copy and a reference clone of one table, each read under its own name."""
    spark, path = star.spark, scratch_path(star.spark, "clone")
    create_table_as(star.products.withColumn("unit_price", F.col("unit_price").cast("double")), f"{path}/source")
    name = f"ll_clone_{uuid.uuid4().hex[:12]}"
    copied = clone_table(spark, f"{name}_copy", f"{path}/source", mode="copy", target_path=f"{path}/copy")
    linked = clone_table(spark, f"{name}_ref", f"{path}/source", mode="reference")
    return copied.withColumn("clone", F.lit("copy")).unionByName(linked.withColumn("clone", F.lit("reference")))
