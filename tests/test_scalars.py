"""Column functions on hand-made edge rows (FIXTURES.md section D)."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlens.functions import scalars as S


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {typ}")


def test_email_to_name_edge_cases(spark):
    df = one_col(spark, ["John.Doe@Example.com", "UPPER_case@x.org", "no-at-sign.here", "a+b@c", None])
    got = [r[0] for r in df.select(S.email_to_name("v")).collect()]
    assert got == ["john_doe", "upper_case", "no_at_sign_here", "a_b", None]


def test_slug_collapses_runs(spark):
    df = one_col(spark, ["I Need My Bean! Latte cup", "--a--b--", "plain"])
    got = [r[0] for r in df.select(S.slug("v")).collect()]
    assert got == ["I-Need-My-Bean-Latte-cup", "-a-b-", "plain"]


def test_path_name(spark):
    df = one_col(spark, ["/a/b/file.csv", "dir/", "name"])
    assert [r[0] for r in df.select(S.path_name("v")).collect()] == ["file.csv", "", "name"]


def test_ratio_zero_and_null_divisor_is_null(spark):
    df = spark.createDataFrame([(10, 4), (1, 0), (5, None), (1, 3)], "a int, b int")
    got = [r[0] for r in df.select(S.ratio2("a", "b")).collect()]
    assert got == [2.5, None, None, 0.33]


def test_ratio_half_up_on_exact_ties(spark):
    # 2.345 is not exact in binary; half-up on the decimal value gives 2.35
    df = spark.createDataFrame([(2345, 1000), (-2345, 1000)], "a long, b long")
    assert [r[0] for r in df.select(S.ratio2("a", "b")).collect()] == [2.35, -2.35]


def test_avg2_groups(spark):
    df = spark.createDataFrame([("x", 1), ("x", 2), ("y", None)], "k string, v int")
    got = dict(df.groupBy("k").agg(S.avg2("v").alias("a")).collect())
    assert got == {"x": 1.5, "y": None}


def test_batch_numbers_around_pivot(spark):
    dates = [dt.date(2019, 11, 30), dt.date(2019, 12, 1), dt.date(2019, 12, 31), dt.date(2020, 1, 3), None]
    df = spark.createDataFrame([(d,) for d in dates], "d date")
    after = [r[0] for r in df.select(S.batch_from_date_after("d", "2019-12-01")).collect()]
    through = [r[0] for r in df.select(S.batch_from_date_through("d", "2019-12-01")).collect()]
    # month is ignored: January 3 falls back to a low batch number
    assert after == [1, 2, 32, 4, None]
    assert through == [1, 1, 31, 3, None]


def test_epoch_to_date_utc(spark):
    df = spark.createDataFrame([(1575158399.5,), (1575158400.0,)], "t double")
    assert [r[0] for r in df.select(S.epoch_to_date("t")).collect()] == [dt.date(2019, 11, 30),
                                                                          dt.date(2019, 12, 1)]


def test_year_range_matches_year_and_pushes_down(spark):
    df = spark.createDataFrame([(dt.date(1997, 12, 31),), (dt.date(1998, 1, 1),), (dt.date(1998, 12, 31),),
                                (dt.date(1999, 1, 1),)], "d date")
    assert df.filter(S.year_range("d", 1998)).count() == 2


def test_week_start_is_monday(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 3),), (dt.date(2024, 1, 7),), (dt.date(2024, 1, 8),)], "d date")
    assert [r[0] for r in df.select(S.week_start("d")).collect()] == [dt.date(2024, 1, 1)] * 2 + [dt.date(2024, 1, 8)]


def test_concat_strict_null(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "x string, y string")
    assert [r[0] for r in df.select(S.concat_strict("p:", F.col("x"), F.col("y"))).collect()] == ["p:ab", None]


def test_formats(spark):
    df = spark.createDataFrame([(1234.5,), (-3.0,), (1_250_000.0,), (999.999,), (None,)], "v double")
    got = df.select(S.format_currency("v").alias("c"), S.format_plain("v", 2).alias("p"),
                    S.format_compact("v").alias("k")).collect()
    assert [tuple(r) for r in got] == [
        ("$1,234.50", "1234.50", "1.23K"),
        ("-$3.00", "-3.00", "-3"),
        ("$1,250,000.00", "1250000.00", "1.25M"),
        ("$1,000.00", "1000.00", "1000"),
        (None, None, None),
    ]


def test_threshold_flag(spark):
    df = spark.createDataFrame([(599.99,), (600.0,), (None,)], "v double")
    assert [r[0] for r in df.select(S.threshold_flag("v", 600)).collect()] == [True, False, None]
