import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from thalweg.session import local_session, ship_package

    session = local_session(4, 4, "3g")
    session.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    ship_package(session)
    return session
