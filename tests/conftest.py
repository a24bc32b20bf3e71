import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starweave.schemas import RAW_SCHEMAS  # noqa: E402
from starweave.session import build_session  # noqa: E402
from starweave.sources.raw import RawSources  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
RUN_TS = dt.datetime(2024, 1, 31, 6)


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", "starweave-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="sw-test-ckpt-")})
    yield s
    s.stop()


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def raw_frames(spark, **tables) -> RawSources:
    """RawSources from small row lists; missing tables are empty. Rows give
    the declared columns in order, without the two audit columns."""
    frames = {}
    for name, schema in RAW_SCHEMAS.items():
        rows = tables.get(name, [])
        full = [tuple(r) + (None, name) for r in rows]
        frames[name] = spark.createDataFrame(full, schema)
    return RawSources.from_frames(frames)
