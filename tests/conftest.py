import pytest

from railyard.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="4", shuffle_partitions=4)
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture
def feed(spark):
    """Raw rows from dictionaries, every column a nullable string."""

    def make(*rows: dict, columns: list[str] | None = None):
        names = columns or list(dict.fromkeys(k for r in rows for k in r))
        schema = ", ".join(f"`{n}` string" for n in names)
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)

    return make
