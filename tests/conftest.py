import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tillstack.session import local_session
    s = local_session("*", shuffle_partitions=8, app="tillstack-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def run(spark):
    from tillstack.plans.queries import Run
    return Run(spark, SF_SMALL)


@pytest.fixture(scope="session")
def tiny_dir(spark, tmp_path_factory):
    """A test-data folder of some fifty orders: the flows write files for every day."""
    import pyspark.sql.functions as F
    base = str(tmp_path_factory.mktemp("tiny"))
    keys = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey").orderBy("o_orderkey").limit(50)
    last = keys.agg(F.max("o_orderkey")).first()[0]
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").filter(F.col("o_orderkey") <= last).write.parquet(f"{base}/orders.parquet")
    spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").filter(F.col("l_orderkey") <= last).write.parquet(f"{base}/lineitem.parquet")
    return base
