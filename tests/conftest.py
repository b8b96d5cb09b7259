import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from limelight.session import build_session

    shared = {"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.cleaner.referenceTracking.cleanCheckpoints": "true"}
    session = build_session("local[4]", app_name="limelight-tests", shuffle_partitions=8, extra_conf=shared)
    yield session
    session.stop()
