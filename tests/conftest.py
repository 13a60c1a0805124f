import pytest

from decidra.session import local_session, ship


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, 4, memory="4g", app="tests")
    s.sparkContext.setLogLevel("ERROR")
    ship(s)
    yield s
    s.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""

    def get(df, *columns):
        return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)

    return get
