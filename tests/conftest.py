import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers import the library too, from whatever folder the tests are run in
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])


@pytest.fixture(scope="session")
def spark():
    from inforce.session import local_session

    s = local_session("2", shuffle_partitions=4, app="inforce-tests")
    yield s
    s.stop()
