import pytest

from quire.session import build_session


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests", 4, **{"spark.sql.shuffle.partitions": "4"})
    yield s
    s.stop()
