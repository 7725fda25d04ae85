import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from orgweave.session import local_session

    session = local_session(cores=4, memory="4g", partitions=4)
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    yield session
    session.stop()
