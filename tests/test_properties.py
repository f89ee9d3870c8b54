"""Property tests: lookups of every kind equal a pandas brute force on random inputs."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlens.operators.lookup import Additive, Lookup, aggregate_over_lookups

fact_rows = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 6)),        # store_id (NULL and unmatched allowed)
              st.integers(0, 3),                               # product_id (fact-side group)
              st.integers(-10_000, 10_000)),                   # cents
    min_size=0, max_size=40)
dim_keys = st.sets(st.integers(0, 4), max_size=5)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=fact_rows, keys=dim_keys)
def test_lookup_plans_match_brute_force(spark, rows, keys):
    fact = spark.createDataFrame(rows, "store_id long, product_id long, cents long")
    dim = spark.createDataFrame([(k, f"S{k % 3}") for k in sorted(keys)], "store_id long, store_name string")
    measures = [Additive("total", "sum", F.col("cents")), Additive("n", "count", F.col("cents")),
                Additive("pos", "count_if", F.col("cents") > 0), Additive("hi", "max", F.col("cents"))]
    got = {}
    for known in ("trust", "error", "first"):
        out = aggregate_over_lookups(fact, [Lookup(dim, "store_id", on_duplicate=known)], ["store_name", "product_id"], measures)
        got[known] = sorted((tuple(r) for r in out.collect()), key=repr)
    names = {k: f"S{k % 3}" for k in keys}
    pdf = pd.DataFrame(rows, columns=["store_id", "product_id", "cents"])
    pdf["store_name"] = [names.get(k) if k is not None and k == k else None for k in pdf["store_id"]]
    expected = []
    for (name, pid), g in pdf.groupby(["store_name", "product_id"], dropna=False):
        name = None if isinstance(name, float) else name
        expected.append((name, int(pid), int(g["cents"].sum()), len(g), int((g["cents"] > 0).sum()),
                         int(g["cents"].max())))
    expected = sorted(expected, key=repr)
    assert got["trust"] == got["error"] == got["first"] == expected
