"""Triggered file-stream ingest and the batch replayer (land / run / land / run)."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.sources.fixtures import REPLAY_PIVOT_DATE
from ledgerlens.streaming import ingest as I
from ledgerlens.streaming.batches import BatchTable
from ledgerlens.streaming.replay import BatchReplay, cdc_batches, daily_batches, user_reg_batches

from conftest import rows


def test_incremental_ingest_exactly_once(spark, scratch, star_small):
    table = I.CsvTable("stores", "Stores", {"sep": ";"})
    landing, target, ckpt = f"{scratch}/landing", f"{scratch}/tables", f"{scratch}/ckpt"
    stores = star_small.stores
    a = stores.filter(F.col("store_id") < 5)
    b = stores.filter(F.col("store_id") >= 5)
    I.land_csv(a, landing, table, "a")
    assert I.ingest_table(spark, landing, table, target, ckpt) == a.count()
    I.land_csv(b, landing, table, "b")
    assert I.ingest_table(spark, landing, table, target, ckpt) == b.count()
    assert I.ingest_table(spark, landing, table, target, ckpt) == 0          # no new files
    got = I.read_ingested(spark, target, "stores")
    assert got.count() == stores.count()
    assert rows(got, "store_id", "store_name") == rows(stores.select(F.col("store_id").cast("string"),
                                                                     "store_name"))
    # full refresh: a new version re-reads every landed file
    assert I.ingest_table(spark, landing, table, target, ckpt, full_refresh=True) == stores.count()
    assert I.current_version(spark, target, "stores") == 2


def test_csv_quoted_separator_and_header(spark, scratch):
    src = f"{scratch}/landing/Stores/manual"
    df = spark.createDataFrame([("1", "Brews; and more"), ("2", "Plain")], "store_id string, store_name string")
    df.write.options(header="true", sep=";").csv(src)
    table = I.CsvTable("stores", "Stores", {"sep": ";"})
    I.ingest_table(spark, f"{scratch}/landing", table, f"{scratch}/t", f"{scratch}/c")
    got = I.read_ingested(spark, f"{scratch}/t", "stores")
    assert rows(got) == [("1", "Brews; and more"), ("2", "Plain")]


def test_replay_batches_cursor_and_exhaustion(spark, scratch, star_small):
    src = star_small.registrations
    target = f"{scratch}/user_reg"
    rep = BatchReplay(spark, lambda s, e: user_reg_batches(src, s, e), target, max_batch=12)
    first = rep.load()
    assert first == user_reg_batches(src, 1, 1).count() and rep.batch == 2
    # a new replayer (restart) continues from the persisted cursor
    rep2 = BatchReplay(spark, lambda s, e: user_reg_batches(src, s, e), target, max_batch=12)
    assert rep2.batch == 2
    rest = rep2.load(continuous=True)
    assert rest == user_reg_batches(src, 2, 12).count()
    assert rep2.load() == 0                                                  # exhausted
    landed = spark.read.json(target)
    assert landed.count() == first + rest


def test_replay_that_dies_between_write_and_log(spark, scratch, star_small):
    src, target = star_small.change_rows, f"{scratch}/cdc"

    def replay():
        return BatchReplay(spark, lambda s, e: cdc_batches(src, s, e), target, max_batch=31)

    first = replay().load()
    dying = replay()
    dying._record = lambda landed: (_ for _ in ()).throw(RuntimeError("the driver was lost"))
    with pytest.raises(RuntimeError):
        dying.load()
    ddl = "event_id long, user_id long, op string, value double"
    assert replay().read(ddl).count() == first and replay().batch == 2       # the unlogged batch is not seen
    second = replay().load()                                                # lands the same batch again
    assert second == src.where("batch = 2").count()
    assert spark.read.json(target).count() == first + second
    assert replay().load(continuous=True) == src.where("batch > 2").count()
    back = replay().read(ddl)
    assert rows(back, "event_id", "batch") == rows(src, "event_id", "batch")
    assert {r["batch"]: r["rows"] for r in replay().log().collect()} == {n: src.where(F.col("batch") == n).count() for n in range(1, 32)}


def test_replay_counts_in_bounded_writes(spark, scratch, star_small, monkeypatch):
    from ledgerlens.streaming import replay as R
    monkeypatch.setattr(R, "BATCHES_PER_WRITE", 4)
    src = star_small.change_rows
    rep = BatchReplay(spark, lambda s, e: cdc_batches(src, s, e), f"{scratch}/cdc", max_batch=10)
    assert rep.load(continuous=True) == src.where("batch <= 10").count()
    assert rep.load(continuous=True) == 0 and rep.log().count() == 10


def test_daily_rule_drops_helpers(star_small):
    out = daily_batches(star_small.daily_events, 1, 31, REPLAY_PIVOT_DATE)
    assert "date" not in out.columns and "week_part" not in out.columns
    assert out.count() == star_small.daily_events.count()


def test_ingest_the_four_table_set(spark, scratch, star_small):
    landing, target, ckpt = f"{scratch}/landing", f"{scratch}/tables", f"{scratch}/ckpt"
    sources = {"transactions": star_small.fct, "stores": star_small.stores,
               "reviews": star_small.reviews.drop("review"), "products": star_small.products}
    for t in I.DEFAULT_TABLES:
        I.land_csv(sources[t.name], landing, t, "b1")
    counts = I.ingest_tables(spark, landing, target, ckpt)
    assert counts == {name: df.count() for name, df in sources.items()}
    spark.conf.set(I.VOLUME_CONF, landing)           # root from the pipeline parameter
    try:
        assert I.ingest_tables(spark, None, target, ckpt) == {name: 0 for name in sources}
        spark.conf.set(I.MODE_CONF, "full_refresh")   # a full refresh re-reads every landed file
        assert I.ingest_tables(spark, None, target, ckpt) == {name: df.count() for name, df in sources.items()}
    finally:
        spark.conf.unset(I.VOLUME_CONF)
        spark.conf.unset(I.MODE_CONF)


def test_typed_layer_keeps_good_and_rejected_rows_apart(spark, scratch):
    import decimal
    raw = spark.createDataFrame([("1", "2.50", "x", "f1"), ("oops", "3", "y", "f1"), (None, "bad", "z", "f2"), ("no", "nil", None, "f2"), (None, None, None, "f3")],
                                "id string, price string, name string, src string")
    good, rejected = I.typed_layer(raw, "id bigint, price decimal(10,2)", f"{scratch}/t", file="src")
    assert good.schema.simpleString() == "struct<id:bigint,price:decimal(10,2),name:string>"
    assert rows(good) == sorted([(1, decimal.Decimal("2.50"), "x"), (None, None, None)], key=repr)
    got = {r["file"] + str(r["name"]): (r["id"], r["price"], [(f["column"], f["value"]) for f in r["failures"]]) for r in rejected.collect()}
    assert got == {"f1y": (None, decimal.Decimal("3.00"), [("id", "oops")]), "f2z": (None, None, [("price", "bad")]),
                   "f2None": (None, None, [("id", "no"), ("price", "nil")])}
    assert good.count() + rejected.count() == raw.count()


def test_typed_layer_of_nothing_and_without_casts(spark, scratch):
    raw = spark.createDataFrame([], "id string")
    good, rejected = I.typed_layer(raw, "id bigint", f"{scratch}/a")
    assert good.count() == rejected.count() == 0
    good, rejected = I.typed_layer(spark.createDataFrame([("x",)], "id string"), "other bigint", f"{scratch}/b")
    assert rows(good) == [("x",)] and rejected.count() == 0


def test_json_records_that_do_not_parse_or_fit_are_kept_with_their_file(spark, scratch):
    lines = ['{"a": 1, "b": "x"}', '{"a": "one", "b": "y"}', '{"a": 3, "b"', '', '{"b": "z"}']
    spark.createDataFrame([(x,) for x in lines], "line string").coalesce(1).write.text(f"{scratch}/in")
    good, rejected = I.read_json_checked(spark, f"{scratch}/in", "a int, b string", f"{scratch}/out")
    assert rows(good) == sorted([(1, "x"), (None, "z")], key=repr)
    got = rejected.collect()
    assert sorted(r["failures"][0]["value"] for r in got) == sorted(lines[1:3])
    assert all(r["failures"][0]["column"] == "_corrupt_record" and "/in/" in r["file"] for r in got)


def _land(spark, landing, label, rows, ddl, table):
    I.land_csv(spark.createDataFrame(rows, ddl).coalesce(1), landing, table, label)


def test_columns_go_by_name(spark, scratch):
    """Files of one batch with other orders, missing, new and differently spelled columns."""
    landing, table = f"{scratch}/landing", I.CsvTable("products", "Products")
    _land(spark, landing, "a", [("1", "100")], "id string, price string", table)
    _land(spark, landing, "b", [("200", "2"), (None, "3")], "price string, id string", table)
    _land(spark, landing, "c", [("4", "x, \"y\"")], "ID string, note string", table)
    assert I.ingest_table(spark, landing, table, f"{scratch}/t", f"{scratch}/c") == 4
    got = I.read_ingested(spark, f"{scratch}/t", "products")
    assert rows(got, "id", "price", "note") == sorted([("1", "100", None), ("2", "200", None), ("3", None, None), ("4", None, 'x, "y"')], key=repr)
    _land(spark, landing, "d", [("now", "5")], "note string, id string", table)      # a later batch without price
    assert I.ingest_table(spark, landing, table, f"{scratch}/t", f"{scratch}/c") == 1
    got = I.read_ingested(spark, f"{scratch}/t", "products", number="run")
    assert rows(got.where("run = 1"), "id", "price", "note") == [("5", None, "now")] and got.count() == 5


def test_paths_that_look_like_patterns_and_empty_files(spark, scratch):
    table = I.CsvTable("t", "In")
    _land(spark, f"{scratch}/landing", "a {1} [b] 100%", [("1",)], "id string", table)
    spark.createDataFrame([], "line string").coalesce(1).write.text(f"{scratch}/landing/In/empty")
    assert I.ingest_table(spark, f"{scratch}/landing", table, f"{scratch}/t", f"{scratch}/c") == 1
    assert rows(I.read_ingested(spark, f"{scratch}/t", "t")) == [("1",)]


def test_header_without_usable_names_is_refused(spark, scratch):
    from pyspark.errors import StreamingQueryException
    landing, table = f"{scratch}/landing", I.CsvTable("products", "Products")
    spark.createDataFrame([("id,ID",), ("1,2",)], "line string").coalesce(1).write.text(f"{landing}/Products/a")
    with pytest.raises((StreamingQueryException, I.HeaderError), match="empty or repeated"):
        I.ingest_table(spark, landing, table, f"{scratch}/t", f"{scratch}/c")
    assert I.current_version(spark, f"{scratch}/t", "products") is None


def test_batches_are_bounded_and_counted_by_their_own_records(spark, scratch):
    landing, table = f"{scratch}/landing", I.CsvTable("products", "Products")
    I.land_csv(spark.range(50).selectExpr("cast(id as string) id").repartition(5), landing, table, "a")
    assert I.ingest_table(spark, landing, table, f"{scratch}/t", f"{scratch}/c", files_per_batch=2) == 50
    log = BatchTable(spark, I.table_path(f"{scratch}/t", "products", 1)).log()
    assert sorted((r["batch"], r["files"]) for r in log.collect()) == [(0, 2), (1, 2), (2, 1)]
    assert I.read_ingested(spark, f"{scratch}/t", "products").distinct().count() == 50


def test_a_batch_written_again_replaces_itself_and_unlogged_ones_are_unseen(spark, scratch):
    table = BatchTable(spark, f"{scratch}/t")
    assert table.last() == -1 and table.rows_since(-1) == 0 and table.read().count() == 0
    assert table.write(spark.range(5).selectExpr("id", "id AS batch"), 0) == 5
    assert table.write(spark.range(7).selectExpr("id", "id AS batch"), 0) == 7      # the retry of a crashed run
    assert table.rows_since(-1) == 7 and table.last() == 0
    spark.range(3).selectExpr("id", "id AS batch").write.parquet(f"{scratch}/t/{BatchTable.NUMBER}=1")   # crash before the record
    back = table.read(spark.range(1).selectExpr("id", "id AS batch").schema, number="no")
    assert back.columns == ["id", "batch", "no"] and back.count() == 7
    assert table.write(spark.range(3).selectExpr("id", "id AS batch"), 1) == 3
    assert table.read(spark.range(1).schema).count() == 10 and table.rows_since(0) == 3
