"""File sources and sinks."""

from pyspark.sql import functions as F

from ledgerlens.sources import files as S

from conftest import plan_text, rows


def test_json_with_ddl_schema(spark, scratch, star_small):
    src = star_small.registrations
    src.write.json(f"{scratch}/reg")
    back = S.read_json(spark, f"{scratch}/reg",
                       "device_id long, mac_address string, registration_timestamp double, user_id long")
    assert back.count() == src.count()
    assert rows(back.limit(0)) == []


def test_append_counted_counts_in_one_pass(spark, scratch, star_small):
    df = star_small.change_rows
    assert S.append_counted(df, f"{scratch}/out") == df.count()
    assert S.append_counted(df, f"{scratch}/out") == df.count()
    assert spark.read.json(f"{scratch}/out").count() == 2 * df.count()


def test_partitioned_read_prunes(spark, scratch, star_small):
    path = S.write_partitioned(star_small.daily_events, f"{scratch}/daily", ["topic", "week_part"])
    q = S.read_partitioned(spark, path).filter(F.col("topic") == "click")
    assert "PartitionFilters: [isnotnull(topic" in plan_text(q)
    assert q.count() == star_small.daily_events.filter(F.col("topic") == "click").count()


def test_ctas_and_clone(spark, scratch, star_small):
    t = S.create_table_as(star_small.products, f"{scratch}/products")
    assert t.count() == star_small.products.count()
    ref = S.clone_table(spark, "ll_clone_ref", f"{scratch}/products", mode="reference")
    cpy = S.clone_table(spark, "ll_clone_copy", f"{scratch}/products", mode="copy",
                        target_path=f"{scratch}/products_copy")
    assert ref.count() == cpy.count() == t.count()


def test_use_namespace(spark):
    S.use_namespace(spark, "ll_test_db")
    assert spark.catalog.currentDatabase() == "ll_test_db"
    spark.catalog.setCurrentDatabase("default")


def test_recommended_conf_for_100_tb():
    from ledgerlens.session import recommended_conf
    conf = recommended_conf(100 * (1 << 40), executors=1000, cores_per_executor=8, executor_memory_gb=32)
    parts = int(conf["spark.sql.shuffle.partitions"])
    assert parts % 8000 == 0 and parts >= 16_000
    per_partition = 100 * (1 << 40) / 3 / parts
    assert per_partition <= 210 * (1 << 20)


def test_bucketed_tables_join_without_shuffle(spark, scratch, star_small):
    docs = star_small.table("documents").select("doc_id", "text")
    labels = star_small.table("labels")
    d = S.write_bucketed(docs, "ll_docs_b", ["doc_id"], 4, path=f"{scratch}/docs_b")
    lb = S.write_bucketed(labels, "ll_labels_b", ["doc_id"], 4, path=f"{scratch}/labels_b")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = d.join(lb, "doc_id")
        p = plan_text(j, "simple")
        assert "SortMergeJoin" in p and "Exchange" not in p
        assert j.count() == docs.join(labels, "doc_id").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
