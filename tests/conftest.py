import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sessionlens.config import ensure_checkpoint_dir, local_session  # noqa: E402
from sessionlens.schema import SESSION_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8, driver_memory="6g")
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="sessionlens-test-")


def ts(day: int, hour: int = 12, month: int = 1, year: int = 2024) -> dt.datetime:
    return dt.datetime(year, month, day, hour, 0, 0)


def sessions(spark, rows, with_id=True):
    """Session-schema DataFrame from dicts (missing keys -> null)."""
    names = [f.name for f in SESSION_SCHEMA.fields]
    data = []
    for i, r in enumerate(rows):
        data.append(tuple([i] if with_id else []) + tuple(r.get(n) for n in names))
    schema = ("session_id long, " if with_id else "") + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in SESSION_SCHEMA.fields)
    return spark.createDataFrame(data, schema)
