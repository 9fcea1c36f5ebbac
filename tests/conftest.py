import pytest

from strandline.session import session


@pytest.fixture(scope="session")
def spark():
    s = session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false", "spark.sql.autoBroadcastJoinThreshold": "1m"})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
