import pytest

from marlstone.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def hot_events(spark):
    """A thousand rows of which one key holds more than a third; ids are unique, times repeat."""
    import random

    rng = random.Random(7)
    rows = []
    for i in range(1000):
        key = 0 if rng.random() < 0.4 else rng.randrange(1, 30)
        rows.append((i, key, rng.randrange(0, 5000), rng.choice([None, 1.0, 2.5, 7.0, -3.0])))
    return spark.createDataFrame(rows, "id bigint, key bigint, at bigint, value double").repartition(6).cache()
