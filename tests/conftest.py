import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from freshcat.session import checkpoint_dir, get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        app="freshcat-tests",
        master="local[*]",
        shuffle_partitions=8,
        extra={"spark.driver.memory": "8g", "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="fc-warehouse-")},
    )
    checkpoint_dir(session)
    yield session
    session.stop()


def rows(df):
    return [tuple(r) for r in df.collect()]
