import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from abacus.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session(master="local[8]", shuffle_partitions=8, app_name="abacus-tests",
                    extra={"spark.driver.memory": "8g"})
    yield s


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)
