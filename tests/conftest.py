import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from kestrel.session import get_spark
    s = get_spark("local[8]", shuffle_partitions=8, app_name="kestrel-tests")
    yield s
    s.stop()
