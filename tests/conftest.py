import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tierone.session import build_session
    s = build_session("local[8]", app="tierone-tests", shuffle_partitions=8,
                      extra={"spark.driver.memory": "4g"})
    # Tests set their own shared folder; a cluster session names one itself.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tierone-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL
