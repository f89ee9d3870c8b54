"""Dashboard datasets, widget queries, filters and facet counts.

A dashboard has *datasets* (named queries) and *widgets*; a widget's query
runs on top of its dataset's result (including the dataset's own ORDER BY /
LIMIT).  A filter declares its scope -- one page, or every page -- and the
(dataset, field) pairs it is bound to; it injects an ``IN`` / ``=`` predicate
into those datasets before any widget of its scope aggregates, and leaves all
others alone.  A filter widget lists each value of its field with the number of
rows on which all *other* filters in its scope hold -- values without such a
row stay listed with 0.

Everything composes into one lazy plan per widget: dataset -> filters ->
widget aggregate.
"""

from __future__ import annotations

import uuid
from collections import Counter
from dataclasses import dataclass, field
from functools import reduce
from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions.scalars import (cents_to_double, format_plain, money_avg2, threshold_flag, to_cents,
                                 week_start, year_range)
from ..operators.lookup import Additive, aggregate_over_lookups
from ..sources.fixtures import Star
from . import star as S



# ------------------------------------------------------------------ datasets

class Datasets(Mapping):
    """The dashboard's named datasets, each planned on first use and then reused."""

    def __init__(self, builders: dict):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def replace(self, name: str, df: DataFrame) -> None:
        """Take ``df`` for a dataset from now on."""
        self._built[name] = df

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def datasets(star: Star, ordered: bool = False) -> Datasets:
    """The seven datasets: four raw scans and three aggregates (lazy, cached per star).

    ``ordered=False`` drops the datasets' ORDER BY when a widget aggregates
    over them anyway (ordering a set that is re-grouped is wasted work); the
    top-10 dataset keeps its order because its LIMIT depends on it.
    """
    cache = star.__dict__.setdefault("_datasets", {})
    if ordered not in cache:
        cache[ordered] = Datasets({
            "stores": lambda: star.stores,
            "products": lambda: star.products,
            "transactions": lambda: star.fct,
            "reviews": lambda: star.reviews_sentiment,
            "daily": lambda: S.daily_store_product(star, ordered=ordered),
            "top_products": lambda: S.top_products(star),
            "hourly": lambda: S.hourly_store(star, ordered=ordered),
        })
    return cache[ordered]


# ------------------------------------------------------------------ widgets

@dataclass(frozen=True)
class WField:
    """One widget field: ``expr AS name``; ``agg`` marks an aggregate."""

    name: str
    expr: Column = field(compare=False)
    agg: bool = False


def dim(name: str, expr: Column | None = None) -> WField:
    return WField(name, F.col(name) if expr is None else expr)


def measure(name: str, expr: Column) -> WField:
    return WField(name, expr, agg=True)


def widget_query(df: DataFrame, fields: Sequence[WField], disaggregated: bool = False,
                 grouping_sets: Sequence[Sequence[str]] | None = None,
                 orders: Sequence[Column | str] = (), grouping_id: str | None = None) -> DataFrame:
    """The query a widget runs over its dataset.

    ``disaggregated``: plain projection.  Otherwise non-aggregate fields are the
    group keys.  ``grouping_sets`` adds subtotal levels (the full key set and
    the grand total are always included), like a pivot's row/column totals.
    """
    if disaggregated:
        return df.select(*[f.expr.alias(f.name) for f in fields]).orderBy(*orders) if orders \
            else df.select(*[f.expr.alias(f.name) for f in fields])
    keys = [f for f in fields if not f.agg]
    aggs = [f.expr.alias(f.name) for f in fields if f.agg]
    if grouping_id:
        aggs.append(F.grouping_id().cast("int").alias(grouping_id))
    if grouping_sets is None:
        out = df.groupBy(*[k.expr.alias(k.name) for k in keys]).agg(*aggs)
    else:
        names = [k.name for k in keys]
        base = df.select(*[k.expr.alias(k.name) for k in keys], *[c for c in df.columns if c not in names])
        sets = [names] + [list(s) for s in grouping_sets] + [[]]
        uniq = []
        for s in sets:
            if s not in uniq:
                uniq.append(s)
        out = base.groupingSets(uniq, *names).agg(*aggs)
    return out.orderBy(*orders) if orders else out


# ------------------------------------------------------------------ filters and facets

@dataclass
class Filter:
    """A filter widget: selected values and the (dataset, field) pairs it drives.

    ``page=None`` is a global filter (every page); otherwise it acts only on
    widgets of that page.
    """

    name: str
    bindings: Sequence[tuple[str, str]]
    values: Sequence = ()
    single: bool = False
    page: str | None = None

    def predicate(self, field_name: str) -> Column | None:
        if not self.values:
            return None                       # empty selection = no filter
        c = F.col(field_name)
        return c == F.lit(self.values[0]) if self.single else c.isin(list(self.values))

    def acts_on(self, page: str | None) -> bool:
        """Whether widgets of ``page`` (None: the page of the global filters) see this filter."""
        return self.page is None or self.page == page


def apply_filters(ds: Mapping[str, DataFrame], filters: Sequence[Filter],
                  page: str | None = None) -> Datasets:
    """Inject every active filter in scope into the datasets it is bound to.

    In scope: global filters, and page filters of ``page`` (all page filters
    when ``page`` is None).  Datasets stay lazy: only those a widget reads
    are planned.
    """
    out = {name: (lambda name=name: ds[name]) for name in ds}
    for f in filters:
        if page is not None and not f.acts_on(page):
            continue
        for dataset, fld in f.bindings:
            pred = f.predicate(fld)
            if pred is not None and dataset in out:
                out[dataset] = (lambda prev=out[dataset], pred=pred: prev().filter(pred))
    return Datasets(out)


def facet_counts(ds: Mapping[str, DataFrame], filters: Sequence[Filter], dataset: str) -> DataFrame:
    """All facets on ``dataset``: ``filter``, ``dataset``, ``field``, ``value`` and ``associativity``.

    A row gets one bit for each filter that it passes, and is counted in the
    cells (field, value, bits) of its bound fields; rows are combined before
    the exchange, so a frequent value is a few cells.  From the cells, every
    facet sums those whose bits hold all its other filters: one pass over the
    dataset for any number of filters, and a value without a passing row keeps
    its cells and so its line with 0.
    """
    bound = [(i, f, fld) for i, f in enumerate(filters) for d, fld in f.bindings if d == dataset]
    bits, active = F.lit(0).cast("long"), {}
    for i, f, fld in bound:
        pred = f.predicate(fld)
        if pred is not None:
            active[i] = f
            bits = bits.bitwiseOR(F.when(pred, F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    fields = sorted({fld for _, _, fld in bound})
    values = F.array(*[F.struct(F.lit(fld).alias("field"), F.col(fld).cast("string").alias("value")) for fld in fields])
    cells = (ds[dataset].select(F.explode(values).alias("v"), bits.alias("bits"))
             .groupBy("v.field", "v.value", "bits").agg(F.count(F.lit(1)).alias("rows")))

    def others(i: int, f: Filter) -> int:
        """Bits of the other filters that the page of ``f`` sees."""
        return sum(1 << j for j, g in active.items() if j != i and g.acts_on(f.page))

    facets = F.array(*[F.struct(F.lit(f.name).alias("filter"), F.lit(fld).alias("field"), F.lit(others(i, f)).cast("long").alias("others")) for i, f, fld in bound])
    lines = cells.withColumn("facet", F.explode(F.filter(facets, lambda x: x["field"] == F.col("field"))))
    passing = F.col("bits").bitwiseAND(F.col("facet.others")) == F.col("facet.others")
    return (lines.groupBy(F.col("facet.filter").alias("filter"), "field", "value")
            .agg(F.sum(F.when(passing, F.col("rows")).otherwise(0)).alias("associativity"))
            .select("filter", F.lit(dataset).alias("dataset"), "field", "value", "associativity"))


# ------------------------------------------------------------------ the dashboard's widgets

def _money_sum(col: str) -> Column:
    """Exact sum of a money column (2 decimals) via integer cents, as double."""
    return cents_to_double(F.sum(to_cents(col)))


def weekly_avg_by_store(star: Star, filters: Sequence[Filter] = ()) -> DataFrame:
    """Line chart: store, week, AVG(total_sales) over the daily dataset's rows.

    A mean of (store, product, day) sums -- the dataset's grain -- not a weekly total.
    """
    ds = apply_filters(datasets(star), filters)
    return widget_query(ds["daily"], [
        dim("store_name"), dim("week_start", week_start("month_day")),
        measure("avg_total_sales", money_avg2("total_sales"))])


def weekly_avg_chain(star: Star) -> DataFrame:
    return widget_query(datasets(star)["daily"], [
        dim("week_start", week_start("month_day")),
        measure("avg_total_sales", money_avg2("total_sales"))])


def store_table_widget(star: Star) -> DataFrame:
    return widget_query(datasets(star)["stores"],
                        [dim("store_location"), dim("store_name"), dim("store_description")],
                        disaggregated=True)


def product_store_cents(star: Star, year: int = P.YEAR) -> DataFrame:
    """Sales in cents per (product, store) of the daily dataset's year.

    Summing the daily dataset's exact per-day sums by (product, store) equals
    summing the year's fact rows by (product, store) directly, so the fact is
    aggregated once to the coarser keys -- one shuffle instead of two.
    """
    fct = star.fct.filter(year_range("transaction_date", year))
    return aggregate_over_lookups(fct, [S.store_lookup(star), S.product_lookup(star)],
                                  ["product_detail", "store_name"],
                                  [Additive("cents", "sum", F.col("transaction_cents"))])


def sales_cube(star: Star) -> DataFrame:
    """Pivot of sales, product x store, with row, column and grand totals.

    The cells are reduced to (product, store) first; the grouping-set
    expansion then multiplies that small result, not the dataset.
    """
    pre = product_store_cents(star)
    return widget_query(pre, [dim("product_detail"), dim("store_name"),
                              measure("sum_total_sales", cents_to_double(F.sum("cents")))],
                        grouping_sets=[["product_detail"], ["store_name"]],
                        orders=[F.asc("product_detail"), F.asc("store_name")], grouping_id="grouping_id")


def pivot_sales_widget(star: Star, threshold=P.PIVOT_FLAG_THRESHOLD) -> DataFrame:
    """The pivot widget: cube cells, display text and the ``< threshold`` highlight."""
    cube = sales_cube(star)
    return cube.withColumn("display", format_plain("sum_total_sales", 2)) \
        .withColumn("highlight", threshold_flag("sum_total_sales", threshold, "<"))


def pivot_matrix(star: Star, stores: Sequence[str] = P.PIVOT_STORES, year: int = P.YEAR) -> DataFrame:
    """Rows = product, columns = the declared stores in their order, cells = sales of one year, with totals.

    The columns are declared by the widget, so none are searched for in the
    data: each is a conditional sum.  ``other_stores`` has what the declared
    ones leave, ``all_stores`` the row's total, and the row with
    ``is_total`` the column totals.  The cells (product, store) are summed
    first; totals and columns come from those, in one pass over the fact.
    """
    name, cents = F.col("store_name"), F.col("cents")
    cells = [cents_to_double(F.sum(F.when(name == s, cents))).alias(s) for s in stores]
    rest = F.when(name.isNull() | ~name.isin(list(stores)), cents)
    return (product_store_cents(star, year).groupingSets([["product_detail"], []], "product_detail")
            .agg((F.grouping("product_detail") == 1).alias("is_total"), *cells,
                 cents_to_double(F.sum(rest)).alias("other_stores"), cents_to_double(F.sum(cents)).alias("all_stores")))


def heatmap_hours(star: Star, hours: tuple[int, int] = P.HEATMAP_HOURS) -> DataFrame:
    """Cells of the heatmap; ``shown`` says whether the hour lies on the chart's axis."""
    cells = widget_query(datasets(star)["hourly"], [
        measure("sum_total_store_sales_per_hour", _money_sum("total_store_sales_per_hour")),
        dim("hour_of_day"), dim("store_name")])
    return cells.withColumn("shown", F.col("hour_of_day").between(*hours))


def bar_products(star: Star, sort: bool = False) -> DataFrame:
    orders = [F.desc("sum_total_quantity_sold"), F.asc("product_detail")] if sort else ()
    return widget_query(datasets(star)["top_products"], [
        dim("product_detail"), measure("sum_total_quantity_sold", F.sum("total_quantity_sold"))],
        orders=orders)


def bar_hours(star: Star) -> DataFrame:
    return widget_query(datasets(star)["hourly"],
                        [dim("hour_of_day"), dim("total_transactions_per_hour")], disaggregated=True)


def counters(star: Star) -> DataFrame:
    """``COUNT(*)`` counters of three datasets, one row each (no cross join)."""
    ds = datasets(star)
    parts = [ds[name].agg(F.count(F.lit(1)).alias("count")).select(F.lit(name).alias("dataset"), "count")
             for name in ("reviews", "products", "transactions")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def pie_sentiment(star: Star) -> DataFrame:
    return widget_query(datasets(star)["reviews"], [
        measure("count", F.count(F.lit(1))), dim("sentiment")])


STORES_PAGE, MARKETING_PAGE = "stores", "marketing"


def default_filters() -> list[Filter]:
    """A store filter of the stores page, and a store and a product filter of every page, as the dashboard binds them."""
    return [
        Filter("page store", [("stores", "store_name"), ("daily", "store_name"), ("hourly", "store_name")],
               values=list(P.FILTER_STORES), page=STORES_PAGE),
        Filter("store", [("stores", "store_name"), ("daily", "store_name")], values=list(P.GLOBAL_FILTER_STORES)),
        Filter("product", [("products", "product_detail")], values=[P.FILTER_PRODUCT], single=True),
    ]


def all_facets(star: Star) -> DataFrame:
    """The six facets of the three filters."""
    ds, filters = datasets(star), default_filters()
    names = dict.fromkeys(d for f in filters for d, _ in f.bindings)
    return reduce(DataFrame.unionByName, [facet_counts(ds, filters, name) for name in names])


def filtered_lines(star: Star) -> DataFrame:
    """The line charts of both pages, each under the filters of its page."""
    ds, filters = datasets(star), default_filters()
    charts = {STORES_PAGE: [dim("store_name"), dim("week_start", week_start("month_day"))],
              MARKETING_PAGE: [dim("store_name", F.lit(None).cast("string")), dim("week_start", week_start("month_day"))]}
    lines = [widget_query(apply_filters(ds, filters, page)["daily"], [*dims, measure("avg_total_sales", money_avg2("total_sales"))])
             .withColumn("page", F.lit(page)) for page, dims in charts.items()]
    return lines[0].unionByName(lines[1])


WIDGETS: dict[str, Callable[[Star], DataFrame]] = {
    "dash_weekly_avg_store": weekly_avg_by_store,
    "dash_weekly_avg_chain": weekly_avg_chain,
    "dash_store_table": store_table_widget,
    "dash_pivot_sales": pivot_sales_widget,
    "dash_heatmap_hours": heatmap_hours,
    "dash_bar_products": bar_products,
    "dash_bar_products_sorted": lambda star: bar_products(star, sort=True),
    "dash_bar_hours": bar_hours,
    "dash_counters": counters,
    "dash_pie_sentiment": pie_sentiment,
    "dash_facet_counts": all_facets,
    "dash_apply_filters": filtered_lines,
}


def avg_daily_sales(star: Star) -> DataFrame:
    """``AVG(total_sales)`` over all rows of the daily dataset."""
    return datasets(star)["daily"].agg(money_avg2("total_sales").alias("avg_total_sales"))


def low_sales_days(star: Star, threshold=P.LOW_SALES_DAY) -> DataFrame:
    """``COUNT_IF(total_sales < t)`` and ``COUNT(*)`` per store over the daily dataset."""
    return widget_query(datasets(star)["daily"], [
        dim("store_name"), measure("low_sales_days", F.count_if(F.col("total_sales") < threshold)),
        measure("days", F.count(F.lit(1)))])


def avg_hourly_sales_by_store(star: Star) -> DataFrame:
    """Aggregate of an aggregate: mean of the hourly dataset's per-hour sums, per store."""
    return widget_query(datasets(star)["hourly"], [
        dim("store_name"),
        measure("avg_sales_per_hour", money_avg2("total_store_sales_per_hour"))])


def review_count_star(star: Star) -> DataFrame:
    """``COUNT(`*`)`` means COUNT(*), not a column called ``*``."""
    return datasets(star)["reviews"].agg(F.count(F.lit(1)).alias("count"))


def flagged_cells(star: Star, threshold=P.PIVOT_FLAG_THRESHOLD) -> DataFrame:
    """Pivot detail cells with the ``< threshold`` highlight flag."""
    cells = product_store_cents(star).select("product_detail", "store_name",
                                             cents_to_double("cents").alias("total_sales"))
    return cells.withColumn("below_threshold", threshold_flag("total_sales", threshold, "<"))


# ------------------------------------------------------------------ page refresh

# Which dataset each widget of the dashboard reads (for sharing on refresh).
WIDGET_DATASET = {
    "dash_weekly_avg_store": "daily", "dash_weekly_avg_chain": "daily", "dash_store_table": "stores",
    "dash_pivot_sales": "daily", "dash_heatmap_hours": "hourly", "dash_bar_products": "top_products",
    "dash_bar_products_sorted": "top_products", "dash_bar_hours": "hourly", "dash_counters": None,
    "dash_pie_sentiment": "reviews", "dash_facet_counts": "daily", "dash_apply_filters": "daily",
}


def refresh_page(star: Star, widgets, out_dir: str) -> dict[str, str]:
    """Run several widgets at once and write each result under ``out_dir``.

    A dataset read by two or more of the widgets is written first, below
    ``out_dir`` as well, so it is computed once instead of once per widget and
    a lost executor costs a re-read.  Results go to tables, never through the
    driver.  Returns widget -> result path.
    """
    uses = Counter(WIDGET_DATASET[w] for w in widgets if WIDGET_DATASET.get(w))
    root, run = out_dir.rstrip("/"), uuid.uuid4().hex[:12]
    page = Star(star.spark, star.sf_dir)                  # datasets of its own: the caller's stay what they are
    ds = datasets(page)
    for name in (n for n, count in uses.items() if count > 1):
        at = f"{root}/_datasets/{run}-{name}"
        ds[name].write.parquet(at)
        ds.replace(name, star.spark.read.schema(ds[name].schema).parquet(at))
    paths = {}
    for w in widgets:
        paths[w] = f"{root}/{w}"
        WIDGETS[w](page).write.mode("overwrite").parquet(paths[w])
    return paths
