import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from helixmart.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "helixmart-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def one(spark):
    """Evaluate a column function on single values: ``one(fn, value, ...)`` -> list of results."""

    def run(fn, *values, kind="string"):
        from pyspark.sql import functions as F

        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, v {kind}").select("i", fn(F.col("v")).alias("r"))
        return [r["r"] for r in df.orderBy("i").collect()]

    return run


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
