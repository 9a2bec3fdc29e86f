import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
# executors (python workers) import the package too
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

from fleetsight.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "fleetsight-tests",
        master="local[2]",
        **{"spark.sql.shuffle.partitions": "2", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getCheckpointDir() and not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="fleetsight-test-ckpt-"))
    yield session
    session.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="fleetsight-test-")
