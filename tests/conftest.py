import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from finflow.session import build_session  # noqa: E402

TESTDATA = os.environ.get("FINFLOW_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "finflow-tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return os.path.join(TESTDATA, "sf0.001")
