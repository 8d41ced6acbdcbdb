import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerloom.session import configure  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("ledgerloom-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture
def one(spark):
    """Values of an expression over literal inputs: one(function, [inputs])."""
    from pyspark.sql import functions as F

    def values(function, inputs, kind="string"):
        rows = [(i, value) for i, value in enumerate(inputs)]
        frame = spark.createDataFrame(rows, f"i int, value {kind}")
        answer = frame.select("i", function(F.col("value")).alias("answer")).orderBy("i")
        return [row.answer for row in answer.collect()]

    return values
