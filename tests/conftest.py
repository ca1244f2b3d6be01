import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from trajtable.session import local_session  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", shuffle_partitions=4)
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="trajtable-tests-"))
    yield session
    session.stop()


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]
