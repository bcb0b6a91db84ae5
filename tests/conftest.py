import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from vecforge.session import build_session
    session = build_session(master="local[4]", shuffle_partitions=8, driver_memory="6g")
    if not session.sparkContext.getCheckpointDir():
        # tests only: the cluster names its own shared folder in spark.checkpoint.dir
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="vecforge-test-ckpt-"))
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="vecforge-test-")
