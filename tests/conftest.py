import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marlstone.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def scratch():
    return tempfile.mkdtemp(prefix="marlstone-tests-", dir="/tmp")


@pytest.fixture(scope="session")
def spark(scratch):
    s = build_session("local[4]", "marlstone-tests", conf={
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        "spark.driver.memory": "4g",
    })
    yield s
    s.stop()
