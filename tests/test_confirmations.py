"""Reports matched to dead letters, in batch and on streams."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql.types import StructType

from queuelake.plans import catalog
from queuelake.streaming.confirmations import MQFB_COA, MQFB_COD, confirmations
from queuelake.streaming.drain import drain

DEAD = "msg_id string, put_ts timestamp_ntz, report array<string>"
REPORTS = "msg_id string, msg_type int, correl_id binary, feedback int, put_ts timestamp_ntz"


def day(n, hour=0):
    return dt.datetime(2024, 3, 1) + dt.timedelta(days=n, hours=hour)


LETTERS = [
    ("a", day(0), ["COA", "COD"]), ("b", day(0), ["COD", "COD"]), ("c", day(1), []), ("d", day(1), None),
    ("e", None, ["COA"]), (None, day(1), ["COA"]), ("f", day(30), ["COA"]),
]
CAME = [
    ("1", 4, b"a", MQFB_COA, day(0)), ("1", 4, b"a", MQFB_COA, day(0)), ("2", 4, b"a", MQFB_COD, day(7)), ("3", 4, b"b", MQFB_COD, day(7, 1)),
    ("4", 8, b"b", MQFB_COD, day(1)), ("5", 4, b"b", 1, day(1)), ("6", 4, b"e", MQFB_COA, day(1)), ("7", 4, None, MQFB_COA, day(1)),
    ("8", 4, b"a", MQFB_COA, day(-1)), ("9", 4, b"a", MQFB_COA, None), ("10", 4, b"nobody", MQFB_COA, day(30)),
]
WANT = [("a", "COA", day(0), day(0)), ("a", "COD", day(0), day(7)), ("b", "COD", day(0), None), ("e", "COA", None, None), (None, "COA", day(1), None)]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_batch(spark):
    dead, reports = spark.createDataFrame(LETTERS, DEAD), spark.createDataFrame(CAME, REPORTS)
    assert rows(confirmations(dead, reports)) == sorted([*WANT, ("f", "COA", day(30), None)], key=str)
    assert rows(confirmations(dead.limit(0), reports)) == []
    assert len(rows(confirmations(dead, reports.limit(0)))) == 6


def test_stream_gives_what_is_not_confirmed_after_the_bound(spark, tmp):
    def write(name, data, schema):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{tmp}/{name}")

    def read(name, schema):
        return spark.readStream.schema(StructType.fromDDL(schema)).parquet(f"{tmp}/{name}")

    def run():
        drain(confirmations(read("dead", DEAD), read("reports", REPORTS)), f"{tmp}/sink", f"{tmp}/ckpt")
        return rows(spark.read.parquet(f"{tmp}/sink"))

    write("dead", LETTERS[:-1], DEAD)
    write("reports", CAME[:1], REPORTS)
    first = run()  # nothing is given up before both inputs have passed the bound
    assert first == sorted([WANT[0], WANT[3]], key=str)
    write("reports", CAME[1:4], REPORTS)  # one again, one on its last day, one late
    assert run() == sorted([WANT[0], WANT[1], WANT[3]], key=str)
    write("dead", LETTERS[-1:], DEAD)
    write("reports", CAME[-1:], REPORTS)
    assert run() == sorted(WANT, key=str)  # the newest letter still waits
    with pytest.raises(ValueError, match="both"):
        confirmations(read("dead", DEAD), spark.createDataFrame(CAME, REPORTS))


def test_the_query_keeps_its_state_on_disk(spark, tmp, monkeypatch):
    monkeypatch.setattr(catalog, "shared_dir", lambda *_, **__: tmp)
    assert catalog.q_stream_confirmations(spark, "/root/testdata/sf0.001").count() > 0
    stores = glob.glob(f"{tmp}/checkpoint/state/*/[0-9]*")
    assert len({os.path.basename(s) for s in stores}) == spark.sparkContext.defaultParallelism
    assert glob.glob(f"{tmp}/checkpoint/state/**/*.changelog", recursive=True)
    assert not glob.glob(f"{tmp}/checkpoint/state/**/*.delta", recursive=True)
