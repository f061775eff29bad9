import pytest

from siltstone.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores=8, memory="8g")
    yield session
    session.stop()


@pytest.fixture()
def rows():
    """Compare a frame with literal rows, ignoring order."""

    def check(df, expected):
        got = sorted((tuple(r) for r in df.collect()), key=repr)
        assert got == sorted(expected, key=repr)

    return check
