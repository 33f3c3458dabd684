import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from rosterline.session import get_spark
    s = get_spark("local[8]", app="rosterline-tests", shuffle_partitions=8)
    from rosterline.session import checkpoint_dir
    checkpoint_dir(s)     # the session's folder, or (tests only) one made when unset
    yield s


@pytest.fixture(scope="session")
def sf_small():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
