"""Positions in a whole order, without a task that sees all rows."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators.ranking import rank_all, with_position

from conftest import plan_text


@pytest.mark.parametrize("n", [0, 1, 7, 5000])
def test_position_is_the_place_in_the_order(spark, n):
    df = spark.range(n).select((F.col("id") * 7919 % 5003).alias("v"), "id", (F.col("id") % 3).alias("__n")).repartition(5)
    got = [(r["v"], r["id"], r["at"]) for r in with_position(df, [F.desc("v"), F.asc("id")], "at").collect()]
    want = sorted(((i * 7919 % 5003, i) for i in range(n)), key=lambda r: (-r[0], r[1]))
    assert sorted(got, key=lambda r: r[2]) == [(v, i, k + 1) for k, (v, i) in enumerate(want)]


def test_nulls_and_a_value_that_most_rows_share(spark):
    df = spark.range(2000).select(F.when(F.col("id") % 10 == 1, None).when(F.col("id") % 10 < 8, 5).otherwise(F.col("id")).alias("v"), "id").repartition(4)
    ranked = rank_all(df, [F.asc_nulls_last("v"), F.asc("id")], 1500)
    got = sorted((r["rank"], r["v"], r["id"]) for r in ranked.where("v IS NOT NULL").collect())
    rows = sorted((v, i) for i in range(2000) if (v := None if i % 10 == 1 else 5 if i % 10 < 8 else i) is not None)
    assert got == [(k + 1, v, i) for k, (v, i) in enumerate(rows[:1500])]


def test_no_exchange_takes_all_rows_to_one_task(spark):
    ranked = rank_all(spark.range(5000).withColumn("v", F.col("id") % 17), [F.asc("v"), F.asc("id")], 4000)
    plan = plan_text(ranked, "simple")
    assert "rangepartitioning" not in plan                   # the order was written once, not evaluated again
    single = plan.split("Exchange SinglePartition")[1:]      # the ranges' sizes only: a row for each
    assert len(single) == 1 and "HashAggregate(keys=[__range" in single[0]
    assert ranked.count() == 4000
