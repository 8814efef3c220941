import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from eventide.session import get_session
    ckpt = tempfile.mkdtemp(prefix="eventide-test-ckpt-")
    s = get_session("local[4]", 4, app_name="eventide-tests", extra={"spark.checkpoint.dir": ckpt})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
