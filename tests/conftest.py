import pytest

from kotomori.session import local_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(memory="8g", app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def one(spark):
    """Evaluate a Column function on one string."""

    def evaluate(function, text):
        df = spark.createDataFrame([(text,)], "t string")
        return df.select(function(df.t)).first()[0]

    return evaluate
