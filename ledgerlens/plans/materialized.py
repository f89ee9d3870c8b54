"""Materialised metric views that are kept up to date by the files that came since.

A materialisation stores the partial values of declared measures (sums, counts,
minima, maxima; unrounded) by some dimensions, together with the files of the
source that they cover.  A refresh lists the source's files, aggregates only
those that are not covered yet, merges the result into the stored values by
key, and writes values and covered files as a new version; the pointer to it is
the last thing written, so readers and a refresh that died keep the version
before.  If a covered file is gone or was changed, everything is aggregated anew.

A query merges the stored values to its own dimensions, rounds last, and then
evaluates composed measures, so it equals the direct answer.  Of several
materialisations the one with the fewest rows that covers the query answers it
(:func:`answer`); a query that none covers goes to the source.

Joined tables are read at refresh time: a dimension row that changes later shows
in new files only, until :meth:`Materialized.refresh` is asked to rebuild.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .metricview import AGGREGATES, MERGED_BY, _MEASURE_REF, BoundMetricView, _field_metadata, _quote, finish, requested

FILES_SCHEMA = "path string, length long, modificationTime timestamp"
POINTER_SCHEMA = "version long, rows long, files long"


def _literal(path: str) -> str:
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


@dataclass(frozen=True)
class FileSource:
    """A table of files below ``path`` that are added and never changed; ``transform`` makes the view's source of their rows."""

    path: str
    fmt: str = "parquet"
    transform: Callable[[DataFrame], DataFrame] = lambda df: df

    def files(self, spark: SparkSession) -> DataFrame:
        """``path``, ``length`` and ``modificationTime`` of the files that are there now; no content is read."""
        listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(self.path)
        return listing.select("path", "length", "modificationTime")

    def rows(self, spark: SparkSession, files: Sequence[str] | None = None) -> DataFrame:
        """The rows of ``files`` (default: of all)."""
        reader = spark.read.format(self.fmt)
        if files is None:
            return self.transform(reader.load(self.path))
        return self.transform(reader.option("basePath", self.path).load([_literal(f) for f in files]))


def _safe(name: str) -> str:
    """``name`` with every character but letters and digits as ``_<code point>_``, so different names stay different."""
    return re.sub(r"[^A-Za-z0-9]", lambda m: f"_{ord(m.group())}_", name)


def _state_col(measure: str) -> str:
    return "m__" + _safe(measure)


def _value_col(measure: str) -> str:
    return "v__" + _safe(measure)


def _dim_col(dim: str) -> str:
    return "d__" + _safe(dim)


@dataclass
class Materialized:
    """Partial values of ``measures`` by ``dims`` below ``path``, over the files of ``source``."""

    bound: BoundMetricView
    source: FileSource
    path: str
    dims: tuple[str, ...]
    measures: tuple[str, ...]

    @cached_property
    def states(self) -> tuple[str, ...]:
        """Declared measures behind ``measures``; a composition of something undeclared is not among them."""
        found: dict[str, None] = {}
        for m in self.measures:
            found.update(dict.fromkeys(self._parts(m) or ()))
        return tuple(found)

    def _parts(self, name: str) -> list[str] | None:
        """Declared measures that ``name`` is made of; None if it can't be re-aggregated."""
        view = self.bound.view
        if view.measures[name].aggregate:
            return [name]
        refs = view.composed_of(name)
        parts = [self._parts(r) for r in refs or ()]
        # A composition may hold nothing but measures: an aggregate beside them can't be taken from their values.
        return [p for some in parts for p in some] if refs and all(parts) and not view.measures[name].uses else None

    # ------------------------------------------------------------ versions

    def pointer(self) -> tuple[int, int]:
        """(version, rows) of the current version; (0, 0) before the first refresh."""
        try:
            found = self.bound.spark.read.schema(POINTER_SCHEMA).json(f"{self.path}/_current")
        except AnalysisException:
            return 0, 0
        last = found.agg(F.max(F.struct("version", "rows")).alias("p")).first()["p"]
        return (last["version"], last["rows"]) if last else (0, 0)

    def covered(self) -> DataFrame:
        version, _ = self.pointer()
        spark = self.bound.spark
        return spark.read.schema(FILES_SCHEMA).parquet(f"{self.path}/v{version}/files") if version else spark.createDataFrame([], FILES_SCHEMA)

    def _state(self, version: int) -> DataFrame:
        return self.bound.spark.read.parquet(f"{self.path}/v{version}/state")

    def partial(self, files: Sequence[str] | None = None) -> DataFrame:
        """The partial values over some files of the source (default: over all)."""
        view = self.bound.view
        need = frozenset().union(*[view.joins_of_measure(m) for m in self.states])
        values = [AGGREGATES[view.measures[m].aggregate](F.expr(view.measures[m].of)).alias(_state_col(m)) for m in self.states]
        return self.bound._grouped([(d, _dim_col(d)) for d in self.dims], [*values, F.count(F.lit(1)).alias("m____rows")], need,
                                   source=self.source.rows(self.bound.spark, files))

    def refresh(self, rebuild: bool = False) -> int:
        """Bring the stored values up to date; the number of files that were read."""
        spark, (version, _) = self.bound.spark, self.pointer()
        key = ["path", "length", "modificationTime"]
        now, done = self.source.files(spark), self.covered()
        rebuild = rebuild or not version or not done.join(now, key, "left_anti").isEmpty()
        fresh = now if rebuild else now.join(done, key, "left_anti")
        paths = [r["path"] for r in fresh.select("path").collect()]      # names of new files only
        if not paths and not rebuild:
            return 0
        state = self.partial(paths or None)
        if not rebuild:
            merged = [MERGED_BY[self.bound.view.measures[m].aggregate](_state_col(m)).alias(_state_col(m)) for m in self.states]
            state = self._state(version).unionByName(state).groupBy(*[_dim_col(d) for d in self.dims]).agg(
                *merged, F.sum("m____rows").alias("m____rows"))
        at = f"{self.path}/v{version + 1}"
        state.write.mode("overwrite").parquet(f"{at}/state")
        # What was aggregated is what the listing above named, not what is there by now.
        listed = fresh.join(spark.createDataFrame([(p,) for p in paths], "path string"), "path", "left_semi") if paths else fresh.limit(0)
        (listed if rebuild else done.unionByName(listed)).write.mode("overwrite").parquet(f"{at}/files")
        rows = self._state(version + 1).count()
        spark.createDataFrame([(version + 1, rows, len(paths))], POINTER_SCHEMA).coalesce(1).write.mode("append").json(f"{self.path}/_current")
        return len(paths)

    # ------------------------------------------------------------ queries

    def covers(self, dims, measures, filter=None) -> bool:
        """Whether a query can be answered from the stored values."""
        names = [m if isinstance(m, str) else m[0] for m in measures]
        parts = [self._parts(n) for n in names if n in self.bound.view.measures]
        return (filter is None and self.pointer()[0] > 0 and {d if isinstance(d, str) else d[0] for d in dims} <= set(self.dims)
                and len(parts) == len(names) and all(p is not None and set(p) <= set(self.states) for p in parts))

    def query(self, dims=(), measures=(), derived: Mapping | None = None, where=None, filter=None, having=None,
              rank=None, order_by=(), limit=None) -> DataFrame:
        """As :meth:`BoundMetricView.query`; what is not covered goes to the source."""
        if not self.covers(dims, measures, filter):
            return self.bound.query(dims, measures, derived, where, filter, having, rank, order_by, limit)
        view = self.bound.view
        dims, measures = requested(view, dims, measures)
        needed = dict.fromkeys(p for n, _ in measures for p in self._parts(n))
        values = []
        for m in needed:
            f = view.measures[m]
            c = MERGED_BY[f.aggregate](_state_col(m))
            if f.aggregate == "count":
                c = F.coalesce(c, F.lit(0)).cast("bigint")
            values.append((F.round(c, f.places) if f.places is not None else c).alias(_value_col(m)))
        keys = [F.col(_dim_col(n)).alias(a, metadata=_field_metadata(view.dimensions[n])) for n, a in dims]
        stored = self._state(self.pointer()[0])
        out = stored.groupBy(*keys).agg(*values) if values else stored.select(*keys).distinct()

        def value(name: str) -> str:
            if name in needed:
                return _quote(_value_col(name))
            return "(" + _MEASURE_REF.sub(lambda r: value(r.group(1).strip()), view.measures[name].expr) + ")"

        out = out.select(*[F.col(_quote(a)) for _, a in dims],
                         *[F.expr(value(n)).alias(a, metadata=_field_metadata(view.measures[n])) for n, a in measures])
        if where is not None:
            out = out.filter(F.expr(where) if isinstance(where, str) else where)
        return finish(out, derived, rank, having, order_by, limit)


def materialize(bound: BoundMetricView, source: FileSource, dims: Sequence[str], measures: Sequence[str], path: str) -> Materialized:
    """A materialisation over the files that are there now."""
    made = Materialized(bound, source, path.rstrip("/"), tuple(dims), tuple(measures))
    made.refresh()
    return made


def answer(bound: BoundMetricView, stored: Sequence[Materialized], dims=(), measures=(), **options) -> DataFrame:
    """The query's answer from the smallest materialisation that covers it, else from the source."""
    covering = [m for m in stored if m.covers(dims, measures, options.get("filter"))]
    if not covering:
        return bound.query(dims, measures, **options)
    return min(covering, key=lambda m: m.pointer()[1]).query(dims, measures, **options)
