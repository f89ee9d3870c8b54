"""Every registered query against its DuckDB oracle on sf0.001, and the
generated-text queries against a brute-force pandas recomputation."""

import datetime as dt
import decimal
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from ledgerlens import oracles, registry
from ledgerlens.sources.tables import TABLE_NAMES, table_path

from conftest import SF_SMALL

QUERIES = {k: q for k, q in E.queries().items() if k in registry.queries()}
SQL = oracles.all_sql()


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _bag(cols, rs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], Counter(tuple(_norm(r[i]) for i in order) for r in rs)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return con


def test_every_query_is_registered_with_an_oracle():
    """Of the library itself; the optional operators' registration is tested beside them."""
    assert set(registry.queries()) == set(oracles.all_sql()) <= set(E.queries())
    assert set(oracles.all_sql()) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    got_cols, got = _bag(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(SQL[name])
    exp_cols, exp = _bag([d[0] for d in cur.description], cur.fetchall())
    assert got_cols == exp_cols
    assert got == exp


# Queries that land, ingest or write before they read: their result is a plain read of what they wrote.
WRITES = {"ingest_csv_stream", "ingest_csv_sep", "ingest_typed_layer", "read_partitioned", "mv_materialize", "ingest_table_set",
          "ingest_full_refresh", "stream_incremental_append", "stream_triggered", "replay_load", "agg_batch_count", "sink_append_json",
          "read_json_schema", "clone_table", "sink_ctas", "limit_before_inference"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_limit_returns_a_subset(spark, name):
    """Metamorphic: ``df.limit(2)`` returns rows of ``df`` (guards against
    optimizer rewrites that drop a top-k under an outer join)."""
    df = QUERIES[name](spark, SF_SMALL)
    full = Counter(tuple(_norm(v) for v in r) for r in df.collect())
    part = Counter(tuple(_norm(v) for v in r) for r in df.limit(2).collect())
    assert not (part - full)
