import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from wavelake.session import get_spark
    s = get_spark("local[4]", shuffle_partitions=8, extra={"spark.ui.showConsoleProgress": "false"})
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="wavelake-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def sf():
    if not os.path.exists(SF001):
        pytest.skip("driver test data not present")
    return SF001


@pytest.fixture
def stored_frames(monkeypatch):
    """The frames that are written as scratch copies during a test."""
    from wavelake import scratch
    frames, store = [], scratch.store

    def seen(df, name):
        frames.append(df)
        return store(df, name)
    monkeypatch.setattr(scratch, "store", seen)
    return frames
