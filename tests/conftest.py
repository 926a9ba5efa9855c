import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from courtline.session import get_session
    s = get_session("local[4]", app="courtline-tests", shuffle_partitions=4,
                    extra={"spark.checkpoint.dir": os.environ.get("TEST_CHECKPOINT_DIR")
                           or tempfile.mkdtemp(prefix="courtline-test-cp-")})
    yield s


@pytest.fixture(scope="session")
def sf_dir():
    return SF
