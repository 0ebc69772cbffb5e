import os
import sys
import tempfile

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

@pytest.fixture(scope="session")
def spark():
    from wortlab.session import get_spark
    s = get_spark(master="local[4]", shuffle_partitions=8,
                  extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="wortlab-test-", dir="/tmp")})
    yield s
    s.stop()
