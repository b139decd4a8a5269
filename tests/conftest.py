import pytest

from playstream.session import build_session
from playstream.sources.star import StarSchema

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    quiet = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"}
    session = build_session("tests", "local[8]", 8, quiet)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def star(spark):
    return StarSchema(spark, SMALL)
