import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from sitegraph.session import get_spark
    s = get_spark("local[4]", app="sitegraph-tests", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def sf():
    return SMALL


def one(spark, expr_fn, *values, schema=None):
    """Evaluate a Column function on literal inputs; return the Python value."""
    from pyspark.sql import functions as F
    cols = [F.lit(v) for v in values]
    return spark.range(1).select(expr_fn(*cols).alias("x")).first()["x"]
