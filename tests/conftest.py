import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from shelfcast.session import get_session
    s = get_session("local[4]", 8, app_name="shelfcast-tests",
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="shelfcast-test-ckpt-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
