"""Row-preserving lookups: NULL and unmatched keys, duplicates, and plans that nothing is counted for."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators.lookup import (Additive, Lookup, aggregate_over_lookups, checked_unique,
                                         first_per_key, lookup)

from conftest import plan_text, rows


@pytest.fixture()
def fact(spark):
    return spark.createDataFrame(
        [(1, 10, 5.0), (1, 11, 1.0), (2, 10, 2.0), (None, 10, 4.0), (9, 12, 8.0)],
        "store_id long, product_id long, amount double")


@pytest.fixture()
def stores(spark):
    return spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "store_id long, store_name string")


@pytest.mark.parametrize("on_duplicate", ["trust", "error", "first"])
def test_null_and_unmatched_keys_form_a_null_group(fact, stores, on_duplicate):
    out = aggregate_over_lookups(fact, [Lookup(stores, "store_id", on_duplicate=on_duplicate)], ["store_name"],
                                 [Additive("total", "sum", F.col("amount")),
                                  Additive("n", "count", F.col("amount"))])
    assert rows(out) == sorted([("A", 6.0, 2), ("B", 2.0, 1), (None, 12.0, 2)], key=repr)


def test_fact_side_groups_and_every_kind(fact, stores):
    out = aggregate_over_lookups(fact, [Lookup(stores, "store_id")], ["store_name", "product_id"],
                                 [Additive("total", "sum", F.col("amount")), Additive("hi", "max", F.col("amount")),
                                  Additive("lo", "min", F.col("amount")), Additive("big", "count_if", F.col("amount") > 3)])
    assert rows(out) == sorted([("A", 10, 5.0, 5.0, 5.0, 1), ("A", 11, 1.0, 1.0, 1.0, 0), ("B", 10, 2.0, 2.0, 2.0, 0),
                                (None, 10, 4.0, 4.0, 4.0, 1), (None, 12, 8.0, 8.0, 8.0, 1)], key=repr)


def test_unused_lookup_is_not_joined(fact, stores):
    dup = stores.union(stores)                      # would inflate sums if joined
    out = aggregate_over_lookups(fact, [Lookup(dup, "store_id")], ["product_id"],
                                 [Additive("total", "sum", F.col("amount"))])
    assert dict(out.collect()) == {10: 11.0, 11: 1.0, 12: 8.0}


def test_duplicate_dimension_key_fails_the_query_that_reads_it(spark, fact):
    dup = spark.createDataFrame([(1, "A"), (1, "A2"), (None, "x"), (None, "y")], "store_id long, store_name string")
    joined = lookup(fact, Lookup(dup, "store_id", name="stores"))         # building it is fine
    with pytest.raises(Exception, match="stores: key .* is not unique"):
        joined.collect()
    fine = checked_unique(dup.where("store_name <> 'A2'"), ["store_id"])  # null keys match nothing and may repeat
    assert {r["store_id"] for r in fine.collect()} == {1, None}
    assert rows(lookup(fact, Lookup(dup, "store_id", on_duplicate="first")).groupBy("store_name").count()) == \
        sorted([("A", 2), (None, 3)], key=repr)


def test_a_lookup_must_say_what_it_knows(fact, stores):
    with pytest.raises(ValueError, match="on_duplicate"):
        lookup(fact, Lookup(stores, "store_id", on_duplicate="maybe"))


def test_first_per_key_is_deterministic(spark):
    dup = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (2, "z", 1)], "k long, name string, x int")
    assert rows(first_per_key(dup, ["k"])) == [(1, "a", 9), (2, "z", 1)]


def test_joins_carry_no_hint(spark, fact, stores):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = lookup(fact, Lookup(stores, "store_id", on_duplicate="trust"))
        assert "BroadcastHashJoin" not in plan_text(shuffled)
        want = rows(shuffled)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows(lookup(fact, Lookup(stores, "store_id"))) == want


def test_empty_fact(spark, stores):
    empty = spark.createDataFrame([], "store_id long, amount double")
    out = aggregate_over_lookups(empty, [Lookup(stores, "store_id")], ["store_name"],
                                 [Additive("total", "sum", F.col("amount"))])
    assert out.count() == 0


def test_relationship_join_path(spark):
    from ledgerlens.operators.relationships import Relationship, Relationships
    fact = spark.createDataFrame([(1, 10), (2, 11), (3, 12)], "store_id long, product_id long")
    stores = spark.createDataFrame([(1, "A", 7), (2, "B", 8)], "store_id long, store_name string, region_id long")
    regions = spark.createDataFrame([(7, "North"), (8, "South")], "rid long, region string")
    rel = Relationships([Relationship("f", "store_id", "s", "store_id"),
                         Relationship("s", "region_id", "r", "rid")],
                        {"f": fact, "s": stores, "r": regions})
    out = rel.join_path("f", ["r"])                      # two hops, found from the declarations
    assert rows(out, "store_id", "store_name", "region") == [(1, "A", "North"), (2, "B", "South"),
                                                             (3, None, None)]


def test_results_do_not_depend_on_partitioning(star_small):
    from ledgerlens.plans import star as S
    base = star_small.fct
    lk = [S.store_lookup(star_small), S.product_lookup(star_small)]
    args = (["store_name", "product_detail"], [Additive("c", "sum", F.col("transaction_cents")),
                                               Additive("n", "count", F.col("transaction_id"))])
    a = aggregate_over_lookups(base, lk, *args)
    b = aggregate_over_lookups(base.repartition(13, "transaction_qty"), lk, *args)
    c = aggregate_over_lookups(base.coalesce(1), lk, *args)
    assert rows(a) == rows(b) == rows(c)


def test_hot_key_with_a_third_of_the_rows(star_small):
    """One store holds a third of all fact rows; broadcast and shuffle joins agree with a plain join."""
    from ledgerlens.plans import star as S
    hot = star_small.fct.withColumn(
        "store_id", F.when(F.col("transaction_id") % 3 == 0, F.lit(0)).otherwise(F.col("store_id")))
    out = aggregate_over_lookups(hot, [S.store_lookup(star_small)], ["store_name"], [Additive("c", "sum", F.col("transaction_cents"))])
    brute = rows(hot.join(star_small.stores, "store_id", "left").groupBy("store_name").agg(F.sum("transaction_cents").alias("c")))
    assert rows(out) == brute
    star_small.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(out.select("*")) == brute
    finally:
        star_small.spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert hot.filter(F.col("store_id") == 0).count() / hot.count() > 0.3


def test_appended_rows_are_seen(spark, scratch):
    from ledgerlens.sources.tables import read_table
    path = f"{scratch}/region.parquet"
    fact = spark.createDataFrame([(1,)], "r_regionkey int")
    spark.createDataFrame([(1, "a")], "r_regionkey int, r_name string").write.parquet(path)
    assert rows(lookup(fact, Lookup(read_table(spark, scratch, "region"), "r_regionkey"))) == [(1, "a")]
    spark.createDataFrame([(1, "b")], "r_regionkey int, r_name string").write.mode("append").parquet(path)
    with pytest.raises(Exception, match="is not unique"):
        lookup(fact, Lookup(read_table(spark, scratch, "region"), "r_regionkey")).collect()
