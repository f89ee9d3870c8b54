"""Dashboard widgets, filters and facets on hand-made datasets."""

from pyspark.sql import functions as F

from ledgerlens.plans.dashboard import (Filter, apply_filters, dim, facet_counts, measure,
                                        widget_query)

from conftest import rows


def _daily(spark):
    return spark.createDataFrame(
        [("S1", "P1", 100.0), ("S1", "P2", 50.0), ("S2", "P1", 10.0), ("S3", "P2", 5.0)],
        "store_name string, product_detail string, total_sales double")


def test_empty_selection_is_no_filter(spark):
    ds = {"daily": _daily(spark)}
    out = apply_filters(ds, [Filter("store", [("daily", "store_name")], values=[])])
    assert out["daily"].count() == 4


def test_filter_reaches_only_bound_datasets(spark):
    ds = {"daily": _daily(spark), "other": _daily(spark)}
    out = apply_filters(ds, [Filter("store", [("daily", "store_name")], values=["S1"])])
    assert out["daily"].count() == 2 and out["other"].count() == 4


def test_facet_keeps_zero_count_values(spark):
    ds = {"daily": _daily(spark)}
    fs = [Filter("store", [("daily", "store_name")], values=["S1"]),
          Filter("product", [("daily", "product_detail")], values=["P2"], single=True)]
    got = {(r["filter"], r["value"]): r["associativity"] for r in facet_counts(ds, fs, "daily").collect()}
    assert got == {("store", "S1"): 1, ("store", "S2"): 0, ("store", "S3"): 1, ("product", "P1"): 1, ("product", "P2"): 1}


def test_facets_equal_a_count_for_each_filter(spark):
    """Five filters of three scopes on two fields, one without a selection: each facet against its own count_if."""
    import itertools
    data = [(s, p, 1.0) for s, p in itertools.product(["S1", "S2", None], ["P1", "P2", "P3"]) for _ in range(1 + len(p + str(s)) % 3)]
    df = spark.createDataFrame(data, "store_name string, product_detail string, total_sales double")
    fs = [Filter("a", [("daily", "store_name")], values=["S1"], page="x"), Filter("b", [("daily", "store_name"), ("other", "store_name")], values=["S1", "S2"]),
          Filter("c", [("daily", "product_detail")], values=["P2"], single=True, page="y"), Filter("d", [("daily", "product_detail")]),
          Filter("e", [("daily", "product_detail")], values=["P1", "P2"], page="x")]
    got = {(r["filter"], r["value"]): r["associativity"] for r in facet_counts({"daily": df, "other": df}, fs, "daily").collect()}
    want = {}
    for f in fs:
        fld = dict(f.bindings)["daily"]
        column = 0 if fld == "store_name" else 1
        for row in data:
            ok = all(row[0 if dict(g.bindings)["daily"] == "store_name" else 1] in g.values for g in fs
                     if g is not f and g.values and (g.page is None or g.page == f.page))
            want[f.name, row[column]] = want.get((f.name, row[column]), 0) + ok
    assert got == want and len({k[0] for k in got}) == 5


def test_facets_read_their_dataset_once(star_small):
    from ledgerlens.plans.dashboard import datasets, default_filters
    from conftest import plan_text
    plan = plan_text(facet_counts(datasets(star_small), default_filters(), "daily"), "simple")
    assert plan.count("lineitem.parquet") == 1


def test_pivot_columns_are_declared_and_totals_add_up(star_small):
    from ledgerlens import params as P
    from ledgerlens.plans.dashboard import pivot_matrix
    from conftest import plan_text
    out = pivot_matrix(star_small)
    assert out.columns == ["product_detail", "is_total", *P.PIVOT_STORES, "other_stores", "all_stores"]
    assert plan_text(out, "simple").count("lineitem.parquet") == 1
    got = out.collect()
    total = [r for r in got if r["is_total"]]
    assert len(total) == 1
    for c in (*P.PIVOT_STORES, "other_stores", "all_stores"):
        assert abs(sum(r[c] or 0 for r in got if not r["is_total"]) - (total[0][c] or 0)) < 0.01
    for r in got:
        assert abs(sum(r[c] or 0 for c in (*P.PIVOT_STORES, "other_stores")) - r["all_stores"]) < 0.01


def test_grouping_sets_subtotals_add_up(spark):
    df = _daily(spark)
    out = widget_query(df, [dim("product_detail"), dim("store_name"),
                            measure("s", F.sum("total_sales"))],
                       grouping_sets=[["product_detail"], ["store_name"]], grouping_id="gid")
    got = {(r["product_detail"], r["store_name"], r["gid"]): r["s"] for r in out.collect()}
    assert got[(None, None, 3)] == 165.0
    assert got[("P1", None, 1)] == 110.0 and got[(None, "S1", 2)] == 150.0
    assert sum(v for (p, s, g), v in got.items() if g == 0) == 165.0


def test_disaggregated_is_a_projection(spark):
    out = widget_query(_daily(spark), [dim("store_name")], disaggregated=True)
    assert out.count() == 4


def test_count_star_is_count_of_rows(spark):
    out = widget_query(_daily(spark), [measure("count", F.count(F.lit(1)))])
    assert rows(out) == [(4,)]


def test_page_filter_stays_on_its_page(spark):
    ds = {"daily": _daily(spark)}
    fs = [Filter("store", [("daily", "store_name")], values=["S1"], page="corporate"),
          Filter("product", [("daily", "product_detail")], values=["P1"], single=True)]      # global
    assert apply_filters(ds, fs, page="corporate")["daily"].count() == 1
    assert apply_filters(ds, fs, page="marketing")["daily"].count() == 2


def test_refresh_page_shares_datasets_and_matches_widgets(star_small, scratch):
    from ledgerlens.plans.dashboard import WIDGETS, refresh_page
    names = ["dash_weekly_avg_store", "dash_pivot_sales", "dash_facet_counts", "dash_bar_products"]
    paths = refresh_page(star_small, names, scratch + "/page")
    for n in names:
        got = star_small.spark.read.parquet(paths[n])
        assert rows(got) == rows(WIDGETS[n](star_small).select(*got.columns))
