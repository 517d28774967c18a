import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tally-tests")
        # The tables are tiny: few tasks, and no time spent on compiling each plan.
        .config("spark.default.parallelism", "2")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data_dir():
    return Path(__file__).parent / "data"


@pytest.fixture(scope="session")
def frame(spark):
    """Build a wide string frame from columns given as lists, with a row id."""

    def build(**columns):
        names = list(columns)
        rows = [(i, *values) for i, values in enumerate(zip(*columns.values()))]
        schema = "id bigint, " + ", ".join(f"`{n}` string" for n in names)
        return spark.createDataFrame(rows, schema)

    return build
