import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[*]").appName("tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", "8g")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    path = TESTDATA / "sf0.001"
    if not path.exists():
        pytest.skip("no test data")
    return str(path)
