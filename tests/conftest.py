import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from noticeworks.session import local_session

    session = local_session(4, "tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate a column over single-column text inputs, in order."""
    from pyspark.sql import functions as F

    def run(values, make):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, "i int, v string")
        return [r[0] for r in df.select(make(F.col("v")), "i").orderBy("i").collect()]

    return run
