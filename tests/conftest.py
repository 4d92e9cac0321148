import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from zonepulse.session import get_session
    s = get_session("local[4]", 4, app_name="zonepulse-tests",
                    extra={"spark.driver.memory": "8g",
                           "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="zp-wh-")})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="zp-test-")
