import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from effdated.session import get_session
    wh = tempfile.mkdtemp(prefix="effdated-wh-")
    s = get_session("local[4]", shuffle_partitions=8,
                    spark__sql__warehouse__dir=wh,
                    spark__ui__showConsoleProgress="false")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="effdated-test-")
