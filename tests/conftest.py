import pytest

from hammerline.params import Params
from hammerline.session import session


@pytest.fixture(scope="session")
def spark():
    s = session("local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def p():
    from datetime import date
    return Params(as_of=date(2014, 2, 1))
