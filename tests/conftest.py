import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from riverbend.session import build_session
    scratch = tempfile.mkdtemp(prefix="riverbend-tests-")
    s = build_session("local[*]", app_name="riverbend-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": scratch, "spark.eventLog.enabled": "true",
                             "spark.eventLog.dir": tempfile.mkdtemp(prefix="riverbend-events-"),
                             "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
