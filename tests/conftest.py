import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from frameloom.session import build_session

    s = build_session(master="local[4]", shuffle_partitions=4, spark__checkpoint__dir="file://" + str(tmp_path_factory.mktemp("shared")), spark__driver__memory="3g")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(DATA):
        pytest.skip("no test tables here")
    return DATA
