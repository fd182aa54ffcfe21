import os
import sys
import tempfile
import warnings

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
warnings.filterwarnings("ignore", category=FutureWarning)
warnings.filterwarnings("ignore", category=DeprecationWarning)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .appName("queuelake-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ql-test-ckpt-"))
    yield s


@pytest.fixture
def tmp(tmp_path):
    return str(tmp_path)


def messages(spark, payloads, extra=None):
    """DataFrame(msg_id, payload) from python payloads (str or bytes)."""
    rows = [(str(i), p.encode("utf-8") if isinstance(p, str) else p) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "msg_id string, payload binary")


def records(df):
    """[(msg_id, pos, value-as-str, error)] sorted."""
    from pyspark.sql import functions as F

    rows = df.select("msg_id", "pos", F.col("value").cast("string").alias("v"), "error").collect()
    return sorted((r.msg_id, r.pos if r.pos is not None else -1, r.v, r.error) for r in rows)
