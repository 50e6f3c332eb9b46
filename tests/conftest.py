import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from starloom.session import build_session
    s = build_session("local[4]", 4, app_name="starloom-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="starloom-test-ckpt-"),
                             "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="starloom-test-wh-")})
    yield s
    s.stop()
