import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from snapfeed.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="snapfeed-wh-")
    s = get_session("local[4]", app="snapfeed-tests", shuffle_partitions=8,
                    conf={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="snapfeed-test-")


SF_SMALL = "/root/testdata/sf0.001"
