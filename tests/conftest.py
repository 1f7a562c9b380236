"""One small session for all tests."""

import pytest

from axonframe.plans import clear_cuts
from axonframe.plans.session import build_session


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="4g", spark__sql__autoBroadcastJoinThreshold="1m")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    clear_cuts(s)
    s.stop()
