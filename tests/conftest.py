from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from revspark.session import get_spark
    # spark.checkpoint.dir comes from the environment when set; otherwise the
    # library falls back to a temporary folder for local sessions
    s = get_spark("local[4]", app="revspark-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="revspark-test-")


def rows(df, order=None):
    """Collected rows as sorted tuples (None-safe)."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((v is None, str(v)) for v in t))
