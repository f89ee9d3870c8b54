import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ledgerlens.session import local_session
    s = local_session(cpus=8, shuffle_partitions=8, app="ledgerlens-tests")
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="ledgerlens-test-")


@pytest.fixture(scope="session")
def star_small(spark):
    from ledgerlens.sources.fixtures import Star
    return Star.load(spark, SF_SMALL)


def rows(df, *cols):
    """Collected rows as sorted tuples (order-insensitive comparisons)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)


def plan_text(df, mode="formatted"):
    """The text ``df.explain(mode)`` prints."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
