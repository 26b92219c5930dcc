import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from mallsight.session import build_session
    ckpt = tempfile.mkdtemp(prefix="mallsight-test-ckpt-")
    s = build_session(master="local[4]", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g",
                             "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="mallsight-wh-")})
    yield s
    s.stop()
