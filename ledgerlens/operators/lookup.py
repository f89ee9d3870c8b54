"""Row-preserving dimension lookups and aggregation over them.

Every join of a star query is a fact-to-dimension LEFT join on the dimension's
key.  It must neither lose nor repeat a fact row, so the caller declares what
is known about the key:

* ``trust`` -- the key is unique (a primary key); nothing is added to the plan;
* ``error`` -- it should be unique: the plan itself counts the rows of each key
  and a repeated key fails the query when it runs, with the dimension's name;
* ``first`` -- it may repeat, and the smallest row of each key is taken.

``error`` and ``first`` aggregate the dimension by its key, which leaves it
distributed as a shuffle join needs it.  No join carries a hint and nothing is
counted while a query is built: Spark's planner and AQE choose broadcast or
shuffle from sizes, convert at runtime, and split skewed keys.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ON_DUPLICATE = ("trust", "error", "first")


def _others(dim: DataFrame, keys: Sequence[str]) -> list[str]:
    folded = {k.lower() for k in keys}
    return [c for c in dim.columns if c.lower() not in folded]


def first_per_key(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep one row per key: the smallest by the remaining columns in declared order.

    ``min(struct(...))`` is an ordinary aggregate, so it runs with map-side
    partial aggregation instead of a window sort of the whole dimension.
    """
    others = _others(dim, keys)
    if not others:
        return dim.select(*keys).distinct()
    picked = dim.groupBy(*keys).agg(F.min(F.struct(*others)).alias("__first"))
    return picked.select(*keys, *[F.col(f"__first.{c}").alias(c) for c in others])


def checked_unique(dim: DataFrame, keys: Sequence[str], name: str = "dimension") -> DataFrame:
    """``dim``, as a plan that fails when it runs if a key (without nulls) has several rows.

    The check is part of every other column's value, so no optimizer rule can
    drop it from a query that reads one.
    """
    others = _others(dim, keys)
    if not others:
        return dim.select(*keys).distinct()
    whole = dim.groupBy(*keys).agg(F.min(F.struct(*others)).alias("__row"), F.count(F.lit(1)).alias("__n"))
    repeated = F.lit(True)
    for k in keys:
        repeated = repeated & F.col(k).isNotNull()
    text = f"{name}: key {list(keys)} is not unique; a join would repeat fact rows and inflate every sum"
    row = F.when((F.col("__n") > 1) & repeated, F.raise_error(F.lit(text)).cast(whole.schema["__row"].dataType)).otherwise(F.col("__row"))
    return whole.select(*keys, row.alias("__row")).select(*keys, *[F.col(f"__row.{c}").alias(c) for c in others])


def one_row_per_key(dim: DataFrame, keys: Sequence[str], on_duplicate: str, name: str = "dimension") -> DataFrame:
    """``dim`` with what its caller knows about ``keys`` (see the module's text)."""
    if on_duplicate not in ON_DUPLICATE:
        raise ValueError(f"{name}: on_duplicate must be one of {ON_DUPLICATE}")
    if on_duplicate == "trust":
        return dim
    return first_per_key(dim, keys) if on_duplicate == "first" else checked_unique(dim, keys, name)


@dataclass(frozen=True)
class Lookup:
    """``fact.<fact_key> = dim.<dim_key>``; ``on_duplicate`` says what is known about the dimension's key."""

    dim: DataFrame
    fact_key: str
    dim_key: str | None = None
    name: str = "dimension"
    on_duplicate: str = "error"

    @property
    def right_key(self) -> str:
        return self.dim_key or self.fact_key

    def attributes(self) -> list[str]:
        return [c for c in self.dim.columns if c != self.right_key]


def lookup(fact: DataFrame, lk: Lookup, how: str = "left", columns: Iterable[str] | None = None) -> DataFrame:
    """Join ``fact`` to one dimension, with the attributes ``columns`` (default: all)."""
    dim = one_row_per_key(lk.dim, [lk.right_key], lk.on_duplicate, lk.name)
    if columns is not None:
        dim = dim.select(lk.right_key, *[c for c in columns if c != lk.right_key])
    if lk.right_key == lk.fact_key:
        return fact.join(dim, lk.fact_key, how)
    renamed = dim.withColumnRenamed(lk.right_key, "__lk_key")
    return fact.join(renamed, fact[lk.fact_key] == renamed["__lk_key"], how).drop("__lk_key")


# ------------------------------------------------------------------ aggregation

KINDS = {
    "sum": F.sum,
    "count": F.count,
    "count_if": F.count_if,
    "min": F.min,
    "max": F.max,
}


@dataclass(frozen=True)
class Additive:
    """A measure over fact columns: ``kind(expr)``."""

    name: str
    kind: str
    expr: Column = field(compare=False)

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"measure {self.name}: kind {self.kind!r} is not one of {sorted(KINDS)}")

    def column(self) -> Column:
        return KINDS[self.kind](self.expr).alias(self.name)


def aggregate_over_lookups(fact: DataFrame, lookups: Sequence[Lookup], group_by: Sequence[str],
                           measures: Sequence[Additive]) -> DataFrame:
    """``SELECT group_by, measures FROM fact LEFT JOIN dims ... GROUP BY group_by``.

    ``group_by`` names columns of the fact or of a dimension.  Lookups that
    supply no grouping column are not joined at all (they are row-preserving,
    so leaving them out cannot change a result).
    """
    fact_cols = set(fact.columns)
    missing = [g for g in group_by if g not in fact_cols and not any(g in lk.attributes() for lk in lookups)]
    if missing:
        raise ValueError(f"unknown grouping columns: {missing}")
    joined = fact
    for lk in lookups:
        attrs = [g for g in group_by if g not in fact_cols and g in lk.attributes()]
        if attrs:
            joined = lookup(joined, lk, columns=attrs)
    return joined.groupBy(*group_by).agg(*[m.column() for m in measures])
