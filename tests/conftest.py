"""One Spark session for all tests."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from skein.session import session

    os.environ.setdefault("OMP_NUM_THREADS", "1")
    shared = tmp_path_factory.mktemp("shared")
    s = session("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="4g", spark__checkpoint__dir=f"file://{shared}", spark__driver__host="127.0.0.1")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
