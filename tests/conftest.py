import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

FIXTURES = os.path.join(ROOT, "tests", "fixtures")
SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ledgerflow.session import checkpoint_root, get_session
    s = get_session("local[4]", app="ledgerflow-tests", shuffle_partitions=8)
    checkpoint_root(s)  # tests run without a cluster-provided folder: a temp one is registered
    yield s


@pytest.fixture()
def scratch():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="ledgerflow-test-")


@pytest.fixture(scope="session")
def order_log(spark):
    from ledgerflow.functions.parse import epoch_to_ts
    from ledgerflow.schemas import ORDER_EVENT
    from ledgerflow.sources.feeds import read_csv_feed
    from pyspark.sql import functions as F
    df = read_csv_feed(spark, os.path.join(FIXTURES, "order_log.csv"), ORDER_EVENT)
    # arrival order = line order of the file (one small file -> one partition, read in order)
    df = df.withColumn("seq", F.monotonically_increasing_id())
    return df.withColumn("ts", epoch_to_ts("event_time", "s")).cache()
