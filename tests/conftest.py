import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shelfwright.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Values of an expression over a list of inputs."""
    def run(make, inputs, ddl="string"):
        from pyspark.sql import functions as F

        df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {ddl}")
        return [r[0] for r in df.select(make(F.col("v")).alias("out"), "i").orderBy("i").select("out").collect()]
    return run
