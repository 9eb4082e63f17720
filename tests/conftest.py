import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))   # tests/compare.py helpers


@pytest.fixture(scope="session")
def spark():
    from dirlens.session import get_spark
    s = get_spark("local[4]", app="dirlens-tests", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="dirlens-test-ckpt-"))
    yield s
