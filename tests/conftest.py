import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, os.environ.get("PYTHONPATH")) if x)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.driver.memory", "3g").config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture
def column(spark):
    """Values of a Column function over texts, in order."""
    from pyspark.sql import functions as F

    def run(texts, f):
        rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
        return [r[0] for r in rows.orderBy("i").select(f(F.col("x"))).collect()]

    return run
