import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from caliper.session import get_session
    ckpt = tempfile.mkdtemp(prefix="caliper-test-ckpt-")
    s = get_session("local[4]", shuffle_partitions=4, app_name="caliper-tests", driver_memory="4g",
                    extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()
