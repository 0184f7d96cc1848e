import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from glazework.session import local_session

    s = local_session("local[*]", shuffle_partitions=8, app="glazework-tests")
    yield s
    s.stop()


def column_values(spark, values, fn, dtype="string"):
    """Apply ``fn`` (Column → Column) to each value; returns the outputs in order."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    rows = df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()
    return [r["out"] for r in rows]
