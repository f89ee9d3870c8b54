"""Declared table relationships and join paths over them.

A relationship says ``left.left_col`` references ``right.right_col`` (the
right side is a dimension, unique on its column).  :meth:`Relationships.join_path`
finds, for each requested table, the chain of relationships from the fact
(breadth-first, shortest chain) and builds LEFT lookups along it, so a
multi-table question never has to spell its joins -- and never fans out,
because every hop is a row-preserving lookup: a right side declared
``unique`` is trusted, any other is checked by the plan when it runs.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass
from typing import Mapping, Sequence

from pyspark.sql import DataFrame

from .lookup import Lookup, lookup


@dataclass(frozen=True)
class Relationship:
    left: str
    left_col: str
    right: str
    right_col: str
    unique: bool = False


class Relationships:
    def __init__(self, rels: Sequence[Relationship], tables: Mapping[str, DataFrame]):
        self.rels = list(rels)
        self.tables = dict(tables)

    def path(self, start: str, goal: str) -> list[Relationship]:
        """Shortest chain of relationships from ``start`` to ``goal``."""
        seen = {start}
        queue: deque = deque([(start, [])])
        while queue:
            node, chain = queue.popleft()
            if node == goal:
                return chain
            for r in self.rels:
                if r.left == node and r.right not in seen:
                    seen.add(r.right)
                    queue.append((r.right, chain + [r]))
        raise ValueError(f"no relationship path from {start} to {goal}")

    def join_path(self, fact: str, dims: Sequence[str], columns: Mapping[str, Sequence[str]] | None = None
                  ) -> DataFrame:
        """``fact`` LEFT JOIN every table of ``dims`` along declared relationships.

        ``columns`` optionally limits the attributes each dimension brings
        (default: all but its key).  Attribute names must not collide.
        """
        out = self.tables[fact]
        joined = {fact}
        for goal in dims:
            for r in self.path(fact, goal):
                if r.right in joined:
                    continue
                dim = self.tables[r.right]
                cols = list((columns or {}).get(r.right, [c for c in dim.columns if c != r.right_col]))
                if r.right_col != r.left_col:
                    dim = dim.withColumnRenamed(r.right_col, r.left_col)
                keep = [c for c in cols if c != r.right_col and c not in out.columns]
                out = lookup(out, Lookup(dim.select(r.left_col, *keep), r.left_col, name=f"relationship {r.left}->{r.right}",
                                         on_duplicate="trust" if r.unique else "error"))
                joined.add(r.right)
        return out


# The three relationships of the star (fact -> store, fact -> product, reviews -> store).
def star_relationships(star) -> Relationships:
    return Relationships(
        [Relationship("transactions", "store_id", "stores", "store_id", unique=True),
         Relationship("transactions", "product_id", "products", "product_id", unique=True),
         Relationship("reviews", "store_id", "stores", "store_id", unique=True)],
        {"transactions": star.fct, "stores": star.stores, "products": star.products,
         "reviews": star.reviews_sentiment})
