"""Metric view: a semantic layer of dimensions and measures over a join tree.

A definition (``version``, ``source``, ``joins``, ``dimensions``, ``measures``)
is declared once; any combination of dimensions and measures is asked for at
query time and compiled to one DataFrame plan:

    source -> needed joins only -> dimension columns -> filter -> groupBy/agg
           -> derived columns -> rank -> having -> order -> limit

Scoping.  ``source.x`` and a bare ``x`` name the base table, ``<join>.x`` a
joined table.  Each joined table is attached as one struct column named after
the join, so ``stores.store_name`` is a field access, a bare name can never be
ambiguous, and the optimizer prunes unused struct fields.  The joins a field
needs are the ones it qualifies names with (or lists under ``uses``), and their
parents; no other join is built.

Measures.  A measure declares its aggregate -- ``sum``, ``count``, ``min`` or
``max`` of an expression, and ``round`` to places -- or is composed of other
measures with ``MEASURE(name)``, or is any other aggregate expression
(``expr``).  The declared ones can be re-aggregated, and compositions of them
are evaluated after that; an ``expr`` is taken as it is and never re-aggregated.

Fan-out safety.  A measure must not change because a dimension was joined, so
every built join is a row-preserving lookup: ``on_duplicate`` says whether its
key is checked by the plan when it runs (``error``), enforced (``first``) or
vouched for (``trust``).

Building a query runs no job: nothing is counted, probed or sampled.  Joins
carry no hint; Spark's planner and AQE choose their strategy from sizes.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.lookup import ON_DUPLICATE, one_row_per_key

_MEASURE_REF = re.compile(r"MEASURE\s*\(\s*`?([^`()]+?)`?\s*\)", re.IGNORECASE)
_TEXT_LITERAL = re.compile(r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"", re.DOTALL)
_QUALIFIED_EQ = re.compile(r"^\s*`?([\w ]+?)`?\.`?(\w+)`?\s*=\s*`?([\w ]+?)`?\.`?(\w+)`?\s*$")

#: Aggregates that a measure can declare, and what sums up their partial values.
AGGREGATES = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
MERGED_BY = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


class MetricViewError(ValueError):
    """Invalid definition or query."""


@dataclass(frozen=True)
class Field:
    name: str
    expr: str
    comment: str | None = None
    display_name: str | None = None
    synonyms: tuple[str, ...] = ()
    format: Mapping | None = None
    aggregate: str | None = None      # declared measures: sum, count, min or max of ``of``, rounded to ``places``
    of: str | None = None
    places: int | None = None
    uses: tuple[str, ...] = ()        # joins beyond those that the expression names


@dataclass(frozen=True)
class Join:
    name: str
    source: str
    on: str
    joins: tuple["Join", ...] = ()
    on_duplicate: str = "error"       # error | first | trust


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _listed(value) -> tuple[str, ...]:
    return () if not value else (value,) if isinstance(value, str) else tuple(value)


def _parse_fields(items, kind) -> tuple[Field, ...]:
    out = []
    for it in items or []:
        declared = [a for a in AGGREGATES if a in it] if kind == "measure" else []
        if "name" not in it or len(declared) + ("expr" in it) != 1:
            raise MetricViewError(f"{kind} needs a name and one of expr{', ' + ', '.join(AGGREGATES) if kind == 'measure' else ''}: {it}")
        places = it.get("round") if declared else None
        if declared:
            of = str(it[declared[0]])
            expr = f"{declared[0].upper()}({of})" if places is None else f"ROUND({declared[0].upper()}({of}), {int(places)})"
        else:
            of, expr = None, str(it["expr"])
        out.append(Field(name=str(it["name"]), expr=expr, comment=it.get("comment"), display_name=it.get("display_name"),
                         synonyms=_listed(it.get("synonyms")), format=it.get("format"), aggregate=declared[0] if declared else None,
                         of=of, places=None if places is None else int(places), uses=_listed(it.get("uses"))))
    return tuple(out)


def _parse_joins(items) -> tuple[Join, ...]:
    out = []
    for it in items or []:
        # YAML 1.1 loads a bare ``on`` key as boolean True.
        on = it.get("on", it.get(True))
        if on is None or "name" not in it or "source" not in it:
            raise MetricViewError(f"join needs name, source and on: {it}")
        out.append(Join(name=str(it["name"]), source=str(it["source"]), on=str(on),
                        joins=_parse_joins(it.get("joins")),
                        on_duplicate=it.get("on_duplicate", "error")))
    return tuple(out)


class MetricView:
    """A parsed metric-view definition bound to table resolution at query time."""

    def __init__(self, source: str, dimensions: Sequence[Field], measures: Sequence[Field],
                 joins: Sequence[Join] = (), version: str | None = None, comment: str | None = None):
        self.source = source
        self.dimensions = {d.name: d for d in dimensions}
        self.measures = {m.name: m for m in measures}
        self.joins = tuple(joins)
        self.version = version
        self.comment = comment
        self._validate()

    # ------------------------------------------------------------ definition

    @classmethod
    def from_dict(cls, d: Mapping) -> "MetricView":
        if "source" not in d:
            raise MetricViewError("definition needs a source")
        return cls(source=str(d["source"]), dimensions=_parse_fields(d.get("dimensions"), "dimension"),
                   measures=_parse_fields(d.get("measures"), "measure"), joins=_parse_joins(d.get("joins")),
                   version=None if d.get("version") is None else str(d.get("version")),
                   comment=d.get("comment"))

    @classmethod
    def from_yaml(cls, text: str) -> "MetricView":
        try:
            import yaml
        except ImportError as e:  # pragma: no cover
            raise MetricViewError("PyYAML is needed for from_yaml; use from_dict") from e
        return cls.from_dict(yaml.safe_load(text))

    def _validate(self) -> None:
        names = list(self.dimensions) + list(self.measures)
        dup = {n.lower() for n in names if [x.lower() for x in names].count(n.lower()) > 1}
        if dup:
            raise MetricViewError(f"duplicate field names: {sorted(dup)}")
        jn = [j.name for j in self._all_joins()]
        if len(set(jn)) != len(jn) or "source" in jn:
            raise MetricViewError(f"join names must be unique and not 'source': {jn}")
        for j in self._all_joins():
            if j.on_duplicate not in ON_DUPLICATE:
                raise MetricViewError(f"join {j.name}: on_duplicate must be error, first or trust")
        for f in (*self.dimensions.values(), *self.measures.values()):
            if set(f.uses) - set(jn):
                raise MetricViewError(f"{f.name}: uses joins that are not declared: {sorted(set(f.uses) - set(jn))}")
        for m in self.measures:
            self.expand_measure(m)          # raises on unknown references and cycles

    def _all_joins(self, joins=None):
        """Every join of the tree, parents before their children."""
        for j in (self.joins if joins is None else joins):
            yield j
            yield from self._all_joins(j.joins)

    def _parents(self) -> dict[str, str | None]:
        out: dict[str, str | None] = {}

        def walk(js, parent):
            for j in js:
                out[j.name] = parent
                walk(j.joins, j.name)
        walk(self.joins, None)
        return out

    def expand_measure(self, name: str, _stack: tuple = ()) -> str:
        """Measure expression with every ``MEASURE(m)`` replaced by m's expression."""
        if name not in self.measures:
            raise MetricViewError(f"unknown measure {name!r}")
        if name in _stack:
            raise MetricViewError(f"measure cycle: {' -> '.join(_stack + (name,))}")
        expr = self.measures[name].expr

        def repl(m):
            return "(" + self.expand_measure(m.group(1).strip(), _stack + (name,)) + ")"
        return _MEASURE_REF.sub(repl, expr)

    def composed_of(self, name: str) -> list[str] | None:
        """Measures a composition refers to; None for a declared aggregate and for any other expression."""
        f = self.measures[name]
        refs = [r.strip() for r in _MEASURE_REF.findall(f.expr)] if f.aggregate is None else []
        return refs or None

    def needed_joins(self, expr: str, uses: Sequence[str] = ()) -> frozenset:
        """Joins whose columns ``expr`` names (outside text literals), those in ``uses``, and the parents of both."""
        text, parents = _TEXT_LITERAL.sub("''", expr), self._parents()
        need = set()
        for j in parents:
            if j in uses or re.search(r"(?<![\w`.])`?" + re.escape(j) + r"`?\s*\.", text):
                while j is not None:
                    need.add(j)
                    j = parents[j]
        return frozenset(need)

    def joins_of_measure(self, name: str) -> frozenset:
        f = self.measures[name]
        need = self.needed_joins(_MEASURE_REF.sub("", f.expr), f.uses)
        for ref in self.composed_of(name) or ():
            need |= self.joins_of_measure(ref)
        return need

    # ------------------------------------------------------------ metadata

    def describe(self, spark: SparkSession) -> DataFrame:
        """Dimensions and measures with their semantic metadata, as a DataFrame."""
        schema = T.StructType([
            T.StructField("kind", T.StringType()), T.StructField("name", T.StringType()),
            T.StructField("expr", T.StringType()), T.StructField("display_name", T.StringType()),
            T.StructField("comment", T.StringType()),
            T.StructField("synonyms", T.ArrayType(T.StringType())),
            T.StructField("format", T.MapType(T.StringType(), T.StringType())),
        ])
        rows = []
        for kind, fields in (("dimension", self.dimensions), ("measure", self.measures)):
            for f in fields.values():
                rows.append((kind, f.name, f.expr, f.display_name, f.comment, list(f.synonyms),
                             _flatten_format(f.format)))
        return spark.createDataFrame(rows, schema)

    def find(self, word: str) -> str:
        """Field name for a name, display name or synonym (case-insensitive)."""
        w = word.strip().lower()
        for f in list(self.dimensions.values()) + list(self.measures.values()):
            cands = [f.name, f.display_name or ""] + list(f.synonyms)
            if w in [c.lower() for c in cands]:
                return f.name
        raise MetricViewError(f"no dimension or measure called {word!r}")

    # ------------------------------------------------------------ binding

    def bind(self, spark: SparkSession, tables: Mapping[str, DataFrame] | None = None) -> "BoundMetricView":
        """Attach table resolution: ``tables[name]``, else a SQL query, else ``spark.table``."""
        return BoundMetricView(self, spark, dict(tables or {}))


def _field_metadata(f: "Field") -> dict:
    """Semantic metadata carried on an output column (``df.schema[c].metadata``)."""
    md = {"name": f.name}
    if f.display_name:
        md["display_name"] = f.display_name
    if f.comment:
        md["comment"] = f.comment
    if f.synonyms:
        md["synonyms"] = list(f.synonyms)
    if f.format:
        md["format"] = _flatten_format(f.format)
    return md


def _flatten_format(fmt, prefix=""):
    if not fmt:
        return None
    out = {}
    for k, v in fmt.items():
        if isinstance(v, Mapping):
            out.update(_flatten_format(v, f"{prefix}{k}.") or {})
        else:
            out[f"{prefix}{k}"] = str(v)
    return out


@dataclass
class Ranking:
    """``ROW_NUMBER() OVER ([PARTITION BY p] ORDER BY o) AS name`` then ``name <= k``."""

    name: str
    order_by: Sequence[Column | str]
    k: int | None = None
    partition_by: Sequence[str] = ()


class BoundMetricView:
    def __init__(self, view: MetricView, spark: SparkSession, tables: dict):
        self.view = view
        self.spark = spark
        self.tables = tables

    # ------------------------------------------------------------ tables

    def _table(self, ref: str) -> DataFrame:
        if ref in self.tables:
            return self.tables[ref]
        if re.match(r"^\s*(SELECT|WITH)\b", ref, re.IGNORECASE):
            return self.spark.sql(ref)
        return self.spark.table(ref)

    def _right_side(self, j: Join) -> DataFrame:
        """The join's table as one struct column, with what is declared about its key."""
        dim = self._table(j.source)
        if j.on_duplicate != "trust":
            keys = []
            for part in re.split(r"\s+AND\s+", j.on, flags=re.IGNORECASE):
                m = _QUALIFIED_EQ.match(part)
                own = [c for t, c in (m.group(1, 2), m.group(3, 4)) if t.strip() == j.name] if m else []
                if not own:
                    raise MetricViewError(f"join {j.name}: cannot find its key in {j.on!r}; declare on_duplicate='trust'")
                keys.append(own[0])
            dim = one_row_per_key(dim, keys, j.on_duplicate, f"join {j.name}")
        return dim.select(F.struct(*[F.col(_quote(c)) for c in dim.columns]).alias(j.name))

    def _joined(self, joins: frozenset, source: DataFrame | None = None) -> DataFrame:
        """Source with the given joins attached as struct columns (LEFT joins)."""
        frame = (self._table(self.view.source) if source is None else source).alias("source")
        for j in self.view._all_joins():              # parents before children
            if j.name in joins:
                frame = frame.join(self._right_side(j), F.expr(j.on), "left")
        return frame

    def _grouped(self, dims: Sequence[tuple[str, str]], aggregates: Sequence[Column], need: frozenset,
                 filter: str | None = None, source: DataFrame | None = None) -> DataFrame:
        """``aggregates`` over the joined source by the dimensions ``(name, alias)``."""
        v = self.view
        need = need.union(*[v.needed_joins(v.dimensions[n].expr, v.dimensions[n].uses) for n, _ in dims])
        if filter is not None:
            need |= v.needed_joins(filter)
        frame = self._joined(need, source)
        if filter is not None:
            frame = frame.filter(F.expr(filter))
        keys = [F.expr(v.dimensions[n].expr).alias(alias, metadata=_field_metadata(v.dimensions[n])) for n, alias in dims]
        try:
            return frame.groupBy(*keys).agg(*aggregates) if aggregates else frame.select(*keys).distinct()
        except AnalysisException as e:
            raise MetricViewError(f"cannot resolve a dimension or measure: {e}") from e

    # ------------------------------------------------------------ query

    def query(self, dims: Sequence[str | tuple[str, str]] = (),
              measures: Sequence[str | tuple[str, str]] = (),
              derived: Mapping[str, Column | str | Callable] | None = None,
              where: Column | str | None = None, filter: str | None = None,
              having: Column | str | None = None, rank: Ranking | None = None,
              order_by: Sequence[Column | str] = (), limit: int | None = None) -> DataFrame:
        """Aggregate the requested measures by the requested dimensions.

        ``dims`` / ``measures``: names or ``(name, alias)``.  ``derived``: new
        columns over measure/dimension output names, computed after the
        aggregate.  ``where``: predicate over dimension output names (Catalyst
        pushes it below the aggregate).  ``filter``: raw predicate over source or
        join columns, applied before aggregation.  No dimensions -> one grand
        total row.
        """
        v = self.view
        dims, measures = requested(v, dims, measures)
        need = frozenset().union(*[v.joins_of_measure(n) for n, _ in measures])
        aggs = [F.expr(v.expand_measure(n)).alias(alias, metadata=_field_metadata(v.measures[n])) for n, alias in measures]
        out = self._grouped(dims, aggs, need, filter)
        if where is not None:
            out = out.filter(F.expr(where) if isinstance(where, str) else where)
        return finish(out, derived, rank, having, order_by, limit)


def requested(view: MetricView, dims, measures) -> tuple[list[tuple[str, str]], list[tuple[str, str]]]:
    """``(name, alias)`` of the asked dimensions and measures, checked against the definition."""
    dims = [(d, d) if isinstance(d, str) else tuple(d) for d in dims]
    measures = [(m, m) if isinstance(m, str) else tuple(m) for m in measures]
    for kind, asked, own, other in (("dimension", dims, view.dimensions, view.measures), ("measure", measures, view.measures, view.dimensions)):
        for name, _ in asked:
            if name == "*":
                raise MetricViewError("SELECT * is not allowed on a metric view; list fields")
            if name in other:
                raise MetricViewError(f"{name!r} is not a {kind}; ask for it under the other kind")
            if name not in own:
                raise MetricViewError(f"unknown {kind} {name!r}")
    if not measures and not dims:
        raise MetricViewError("ask for at least one dimension or measure")
    return dims, measures


def finish(out: DataFrame, derived=None, rank: Ranking | None = None, having=None,
           order_by: Sequence = (), limit: int | None = None) -> DataFrame:
    """Post-aggregate steps shared by direct and materialised answers."""
    for name, spec in (derived or {}).items():
        col = spec(out) if callable(spec) else (F.expr(spec) if isinstance(spec, str) else spec)
        try:
            out = out.withColumn(name, col)
        except AnalysisException as e:
            if re.search(r"AGGREGAT|GROUP_BY", str(e.getCondition() or "")):
                raise MetricViewError(f"derived {name!r}: aggregates over measures are not allowed") from e
            raise MetricViewError(f"derived {name!r}: {e}") from e
    if rank is not None:
        if rank.k is None and not rank.partition_by:
            # An un-partitioned, unlimited rank would move every group into one task.
            raise MetricViewError("a global rank needs k (rank <= k) or a partition_by")
        w = Window.partitionBy(*rank.partition_by).orderBy(*rank.order_by) if rank.partition_by \
            else Window.orderBy(*rank.order_by)
        out = out.withColumn(rank.name, F.row_number().over(w))
        if rank.k is not None:
            out = out.filter(F.col(rank.name) <= rank.k)
    if having is not None:
        out = out.filter(F.expr(having) if isinstance(having, str) else having)
    if order_by:
        out = out.orderBy(*order_by)
    if limit is not None:
        out = out.limit(limit)
    return out


