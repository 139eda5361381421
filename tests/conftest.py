import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from strata.session import build_session
    scratch = tempfile.mkdtemp(prefix="strata-test-")
    s = build_session("local[*]", 8, app_name="strata-tests",
                      extra={"spark.checkpoint.dir": scratch + "/ckpt",
                             "spark.local.dir": scratch + "/local"})
    s.sparkContext.setCheckpointDir(scratch + "/ckpt")
    yield s
    s.stop()


@pytest.fixture()
def workdir(tmp_path):
    return str(tmp_path)
