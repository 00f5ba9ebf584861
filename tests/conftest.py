import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def build_session(zone: str = "UTC") -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("tradeflow-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", zone)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    return build_session()


@pytest.fixture
def root(spark, request):
    from tradeflow.workspace import new_folder

    return new_folder(spark, request.node.name[:40].replace("[", "-").replace("]", ""))
