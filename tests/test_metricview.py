"""Metric view: definition, scoping, fan-out safety, composition, rules, metadata, materialisation."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.plans import views as V
from ledgerlens.plans.materialized import FileSource, answer, materialize
from ledgerlens.plans.metricview import MetricView, MetricViewError, Ranking

from conftest import rows


def test_yaml_on_key_both_forms():
    mv = MetricView.from_yaml(V.SALES_VIEW_YAML)
    joins = {j.name: j.on for j in mv._all_joins()}
    assert joins["products"] == "source.product_iD = products.product_id"     # bare `on:` (YAML True)
    assert joins["stores"] == "source.store_id = stores.store_id"             # quoted "on"


def test_nested_reviews_join_is_pruned_and_totals_match_star(star_small):
    bound = V.sales_view(star_small)
    view = bound.view
    assert view.needed_joins("stores.store_name") == view.needed_joins("UPPER(`stores`.store_name)") == frozenset({"stores"})
    assert view.needed_joins("IF(x = 'stores.y', other_stores.z, a.stores.b)") == frozenset()
    assert view.needed_joins("store_reviews.score") == frozenset({"stores", "store_reviews"})
    assert view.joins_of_measure("avg_price_per_item") == frozenset()
    got = dict(bound.query(["store_name"], ["total_quantity_sold"]).collect())
    plain = star_small.fct.join(star_small.stores, "store_id", "left").groupBy("store_name") \
        .agg(F.sum("transaction_qty")).collect()
    assert got == dict(plain)


def test_fan_out_join_is_refused(star_small):
    mv = MetricView.from_dict({
        "source": "fct",
        "joins": [{"name": "stores", "source": "stores", "on": "source.store_id = stores.store_id",
                   "joins": [{"name": "r", "source": "reviews", "on": "stores.store_id = r.store_id"}]}],
        "dimensions": [{"name": "review_score", "expr": "r.score"}],
        "measures": [{"name": "qty", "expr": "SUM(transaction_qty)"}],
    })
    bound = mv.bind(star_small.spark, {"fct": star_small.fct, "stores": star_small.stores,
                                       "reviews": star_small.reviews})
    with pytest.raises(Exception, match="join r: key .* is not unique"):
        bound.query(["review_score"], ["qty"]).collect()


def test_on_duplicate_first_keeps_one_row(spark):
    fact = spark.createDataFrame([(1, 2.0), (1, 3.0), (2, 1.0)], "k long, v double")
    dim = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "k long, name string")
    mv = MetricView.from_dict({
        "source": "f",
        "joins": [{"name": "d", "source": "dim", "on": "source.k = d.k", "on_duplicate": "first"}],
        "dimensions": [{"name": "name", "expr": "d.name"}],
        "measures": [{"name": "total", "expr": "SUM(v)"}],
    })
    out = mv.bind(spark, {"f": fact, "dim": dim}).query(["name"], ["total"])
    assert rows(out) == [("a", 5.0), ("c", 1.0)]


def test_grand_total_and_metamorphic_sum(star_small):
    bound = V.sales_view(star_small)
    total = bound.query(measures=["total_quantity_sold"]).collect()[0][0]
    for dim in ("store_name", "Product detail", "month_day", "hour_of_day", "product"):
        parts = bound.query([dim], ["total_quantity_sold"]).agg(F.sum("total_quantity_sold")).collect()[0][0]
        assert parts == total


def test_composed_measure_equals_ratio_of_measures(star_small):
    bound = V.sales_view(star_small)
    a = bound.query(["store_name"], ["avg_price_per_item"])
    from ledgerlens.functions.scalars import ratio2
    b = bound.query(["store_name"], ["total_sales", "total_quantity_sold"],
                    derived={"r": ratio2("total_sales", "total_quantity_sold")}).select("store_name", "r")
    assert rows(V.decimals_to_double(a)) == rows(b)


def test_measure_cycle_is_rejected():
    with pytest.raises(MetricViewError):
        MetricView.from_dict({"source": "t", "dimensions": [],
                              "measures": [{"name": "a", "expr": "MEASURE(b) + 1"},
                                           {"name": "b", "expr": "MEASURE(a)"}]})


@pytest.mark.parametrize("dims,measures", [(["*"], ["total_sales"]), (["total_sales"], []),
                                           (["nope"], ["total_sales"]), (["store_name"], ["store_name"])])
def test_query_rules(star_small, dims, measures):
    with pytest.raises(MetricViewError):
        V.sales_view(star_small).query(dims, measures)


def test_nested_aggregation_is_rejected(star_small):
    with pytest.raises(MetricViewError):
        V.sales_view(star_small).query(["store_name"], ["total_sales"], derived={"m": "max(total_sales)"})


def test_rank_with_ties_is_total(spark):
    fact = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 1.0), ("d", 0.5)], "g string, v double")
    mv = MetricView.from_dict({"source": "f", "dimensions": [{"name": "g", "expr": "g"}],
                               "measures": [{"name": "s", "expr": "SUM(v)"}]})
    out = mv.bind(spark, {"f": fact}).query(["g"], ["s"], rank=Ranking("rank", [F.desc("s"), F.asc("g")], 2))
    assert rows(out) == [("a", 1.0, 1), ("b", 1.0, 2)]


def test_metadata_and_synonyms(star_small):
    mv = MetricView.from_yaml(V.SALES_VIEW_YAML)
    assert mv.find("revenue") == "total_sales"
    assert mv.find("Store Name") == "store_name"
    d = {r["name"]: r for r in mv.describe(star_small.spark).collect()}
    assert d["total_sales"]["format"]["currency_code"] == "USD"
    assert d["Product detail"]["display_name"] == "Product Detail"


def _landed(star, scratch):
    """The sales view over files of its own, half of the sales landed."""
    source = FileSource(f"{scratch}/sales")
    star.fct.where("transaction_id % 2 = 0").write.parquet(source.path)
    bound = MetricView.from_yaml(V.SALES_VIEW_YAML).bind(star.spark, {
        "fct": source.rows(star.spark), "stores": star.stores, "products": star.products, "reviews": star.reviews})
    return source, bound


def _rest(star, source):
    star.fct.where("transaction_id % 2 <> 0").write.mode("append").parquet(source.path)
    return MetricView.from_yaml(V.SALES_VIEW_YAML).bind(star.spark, {
        "fct": source.rows(star.spark), "stores": star.stores, "products": star.products, "reviews": star.reviews})


MEASURES = ["total_sales", "total_quantity_sold", "total_transactions", "transaction_count", "avg_price_per_item"]


def test_materialized_equals_direct_before_and_after_a_refresh(star_small, scratch):
    source, bound = _landed(star_small, scratch)
    mat = materialize(bound, source, ["store_name", "month_day"], MEASURES, scratch + "/mv")
    for bound_now in (bound, None):
        if bound_now is None:
            mat.bound = bound_now = _rest(star_small, source)
            assert mat.refresh() > 0 and mat.refresh() == 0
        for dims in (["store_name"], ["month_day"], ["month_day", "store_name"], []):
            assert rows(V.decimals_to_double(mat.query(dims, MEASURES))) == rows(V.decimals_to_double(bound_now.query(dims, MEASURES)))
    assert not mat.covers(["Product detail"], ["total_sales"], None)          # falls back to the source
    assert not mat.covers(["store_name"], ["total_sales"], "transaction_qty > 1")
    assert rows(mat.query(["Product detail"], ["total_sales"])) == rows(mat.bound.query(["Product detail"], ["total_sales"]))


def test_refresh_reads_new_files_only_and_notices_changed_ones(star_small, scratch):
    source, bound = _landed(star_small, scratch)
    mat = materialize(bound, source, ["store_name"], ["total_quantity_sold"], scratch + "/mv")
    before = {r["path"] for r in mat.covered().collect()}
    mat.bound = _rest(star_small, source)
    now = {r["path"] for r in source.files(star_small.spark).collect()}
    fresh = sorted(now - before)
    partial = mat.partial(fresh)
    assert {f.split("/")[-1] for f in partial.inputFiles() if "/sales/" in f} == {f.split("/")[-1] for f in fresh}
    assert mat.refresh() == len(fresh) and {r["path"] for r in mat.covered().collect()} == now
    assert mat.pointer()[0] == 2
    star_small.fct.limit(50).write.mode("overwrite").parquet(source.path)     # covered files are gone: all anew
    mat.bound = MetricView.from_yaml(V.SALES_VIEW_YAML).bind(star_small.spark, {
        "fct": source.rows(star_small.spark), "stores": star_small.stores, "products": star_small.products, "reviews": star_small.reviews})
    assert mat.refresh() > 0
    assert rows(mat.query([], ["total_quantity_sold"])) == rows(mat.bound.query([], ["total_quantity_sold"]))


def test_the_smallest_covering_materialisation_answers(star_small, scratch):
    source, bound = _landed(star_small, scratch)
    fine = materialize(bound, source, ["store_name", "Product detail"], MEASURES, scratch + "/fine")
    small = materialize(bound, source, ["store_name"], MEASURES, scratch + "/small")
    by_store = answer(bound, [fine, small], ["store_name"], ["total_sales"])
    assert f"{scratch}/small/" in str(by_store.inputFiles())
    by_product = answer(bound, [fine, small], ["Product detail"], ["total_sales"])
    assert f"{scratch}/fine/" in str(by_product.inputFiles())
    assert f"{scratch}/sales/" in str(answer(bound, [fine, small], ["month_day"], ["total_sales"]).inputFiles())
    assert rows(by_store) == rows(bound.query(["store_name"], ["total_sales"]))


def test_global_rank_needs_k(spark):
    fact = spark.createDataFrame([("a", 1.0)], "g string, v double")
    mv = MetricView.from_dict({"source": "f", "dimensions": [{"name": "g", "expr": "g"}],
                               "measures": [{"name": "s", "expr": "SUM(v)"}]})
    with pytest.raises(MetricViewError):
        mv.bind(spark, {"f": fact}).query(["g"], ["s"], rank=Ranking("rank", [F.desc("s")]))


def test_source_may_be_a_sql_query(star_small):
    star_small.fct.createOrReplaceTempView("ll_mv_fct")
    mv = MetricView.from_dict({
        "source": "SELECT store_id, transaction_qty FROM ll_mv_fct WHERE transaction_qty > 10",
        "dimensions": [{"name": "store", "expr": "store_id"}],
        "measures": [{"name": "qty", "expr": "SUM(transaction_qty)"}],
    })
    out = mv.bind(star_small.spark).query(["store"], ["qty"])
    want = star_small.fct.filter("transaction_qty > 10").groupBy("store_id").agg(F.sum("transaction_qty"))
    assert rows(out) == rows(want)


def test_output_columns_carry_metadata(star_small):
    q = V.sales_view(star_small).query(["store_name"], [("total_sales", "revenue")])
    md = q.schema["revenue"].metadata
    assert md["name"] == "total_sales" and md["display_name"] == "Total Sales"
    assert md["format"]["currency_code"] == "USD"
    assert q.schema["store_name"].metadata["display_name"] == "Store Name"


SHAPES = {"ratio": {"expr": "SUM(amt) / SUM(qty)"}, "rounded_ratio": {"expr": "ROUND(SUM(amt) / SUM(qty), 2)"}, "distinct": {"expr": "COUNT(DISTINCT amt)"},
          "rounded": {"sum": "amt", "round": 2}, "total": {"sum": "amt"}, "nested": {"sum": "IF(name_ = ')', amt, (amt))"},
          "shifted": {"expr": "SUM(amt) + 1"}, "rows a": {"count": 1}, "rows_a": {"count": "amt"}, "low": {"min": "amt"}, "high": {"max": "qty"},
          "per_row": {"expr": "MEASURE(total) / MEASURE(`rows a`)"}, "of_ratio": {"expr": "MEASURE(ratio) * 2"}, "twice": {"expr": "MEASURE(per_row) * 2"}}


def _shapes(spark, scratch, rows_=5):
    source = FileSource(f"{scratch}/f")
    fact = [(1, 10.0, 1.0, ")"), (1, 10.0, 4.0, "x"), (2, 5.0, 1.0, "x"), (2, 30.0, 1.0, "y"), (3, None, 2.0, "z")][:rows_]
    spark.createDataFrame(fact, "k long, amt double, qty double, name_ string").repartition(3).write.parquet(source.path)
    dim = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "k long, name string")
    mv = MetricView.from_dict({
        "source": "f", "joins": [{"name": "d", "source": "dim", "on": "source.k = d.k"}],
        "dimensions": [{"name": "name", "expr": "d.name"}], "measures": [{"name": n, **e} for n, e in SHAPES.items()]})
    return source, mv.bind(spark, {"f": source.rows(spark), "dim": dim})


def test_every_measure_shape_agrees_with_its_materialisation(spark, scratch):
    source, bound = _shapes(spark, scratch)
    kept = materialize(bound, source, ["name"], list(SHAPES), f"{scratch}/mv")
    stored = {m for m in SHAPES if kept.covers(["name"], [m])}
    assert stored == {"rounded", "total", "nested", "rows a", "rows_a", "low", "high", "per_row", "twice"}
    for m in SHAPES:
        assert rows(kept.query(["name"], [m])) == rows(bound.query(["name"], [m]))
        assert rows(kept.query([], [m])) == rows(bound.query([], [m]))


def test_materialised_count_of_no_rows_is_zero(spark, scratch):
    source, bound = _shapes(spark, scratch, rows_=0)
    kept = materialize(bound, source, ["name"], ["rows a"], f"{scratch}/mv")
    assert rows(kept.query([], ["rows a"])) == [(0,)]


@pytest.mark.parametrize("measure", [{"sum": "a", "expr": "SUM(a)"}, {"sum": "a", "max": "a"}, {}, {"expr": "SUM(a)", "uses": ["nowhere"]}])
def test_a_measure_is_declared_in_one_way(measure):
    with pytest.raises(MetricViewError):
        MetricView.from_dict({"source": "t", "dimensions": [], "measures": [{"name": "m", **measure}]})


def test_joins_without_qualified_names_are_listed_under_uses(spark):
    fact = spark.createDataFrame([(1, 2.0), (2, 1.0)], "k long, v double")
    dim = spark.createDataFrame([(1, "a")], "k long, name string")
    mv = MetricView.from_dict({
        "source": "f", "joins": [{"name": "d", "source": "dim", "on": "source.k = d.k", "on_duplicate": "trust"}],
        "dimensions": [{"name": "known", "expr": "d IS NOT NULL", "uses": "d"}], "measures": [{"name": "total", "sum": "v"}]})
    assert rows(mv.bind(spark, {"f": fact, "dim": dim}).query(["known"], ["total"])) == [(False, 1.0), (True, 2.0)]
