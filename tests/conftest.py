import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from carelake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=8, app_name="carelake-tests",
                      extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="carelake-test-")


SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = os.environ.get("CARELAKE_ORACLE_SF", "/root/testdata/sf0.001")
