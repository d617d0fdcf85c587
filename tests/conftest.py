import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from tillmark.session import local_session

    return local_session(4, memory="6g", shuffle_partitions=4)


@pytest.fixture(scope="session")
def duck():
    import harness

    return harness.connect(harness.SMALL)


@pytest.fixture(scope="session")
def workspace(spark):
    from harness import SMALL

    from tillmark.plans.workspace import Workspace

    return Workspace.of_test_tables(spark, SMALL)
