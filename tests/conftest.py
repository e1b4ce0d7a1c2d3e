import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    # The tests of plans count the executions before theirs, so none may be dropped (by default all but the last 1,000 are).
    settings = {"spark.sql.shuffle.partitions": "8", "spark.checkpoint.dir": shared, "spark.sql.ui.retainedExecutions": "100000"}
    session = build_session("tests", "local[8]", **settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
