import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from riskflow.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="riskflow-tests")
    yield s


@pytest.fixture(scope="session")
def duck_small():
    from harness import duck

    return duck(SMALL)
