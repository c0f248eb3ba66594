import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from siltstone.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session("local[4]", 4, **{"spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


DATA = os.environ.get("SILTSTONE_TESTDATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip("no test tables")
    return DATA
