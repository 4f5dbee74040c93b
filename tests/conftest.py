import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerlens.session import get_session
    ckpt = tempfile.mkdtemp(prefix="ledgerlens-test-")
    s = get_session("local[4]", shuffle_partitions=4,
                    extra={"spark.checkpoint.dir": ckpt, "spark.sql.warehouse.dir": ckpt + "/warehouse"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(autouse=True)
def nothing_kept(request):
    """What a test persists is not in the plans of the next one."""
    yield
    if "spark" in request.fixturenames:
        request.getfixturevalue("spark").catalog.clearCache()
