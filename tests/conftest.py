import os
import sys
import tempfile
from contextlib import contextmanager

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marketlake.session import local_session  # noqa: E402
from marketlake.sources.catalog import SOURCES, bronze_schema  # noqa: E402

SF_SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app_name="marketlake-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="marketlake-test-")


def bronze(spark, name, rows):
    """A bronze (all-string) frame of one source from dicts (missing keys -> null)."""
    cols = SOURCES[name].columns
    data = [tuple(None if r.get(c) is None else str(r.get(c)) for c in cols) for r in rows]
    return spark.createDataFrame(data, bronze_schema(name))


@contextmanager
def settings(spark, values):
    """Session settings for a while; keys that had no value have none afterwards."""
    old = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
