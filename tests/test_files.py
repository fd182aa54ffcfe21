"""A message per file."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from queuelake.operators.splitters import split_lines
from queuelake.plans import catalog
from queuelake.plans import fixtures as fx
from queuelake.session import listing_session
from queuelake.sources.files import FILE_TOO_LARGE, read_files, read_files_stream
from queuelake.streaming.drain import drain


def put(folder, name, data, when=1_700_000_000):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)
    os.utime(path, (when, when))
    return path


def rows(df):
    return sorted((os.path.basename(r.msg_id), r.payload and bytes(r.payload), r.n_bytes, r.error) for r in df.collect())


def test_files_are_messages(spark, tmp):
    put(tmp, "a.txt", b"one\ntwo\n")
    put(tmp, "sub/b c.txt", b"3")
    put(tmp, "empty.txt", b"")
    put(tmp, "big.txt", b"x" * 101)
    put(tmp, "_hidden", b"no")
    put(tmp, "other.bin", b"\x00\xff")
    files = read_files(spark, tmp, glob="*.txt", max_file_bytes=100)
    assert rows(files) == [("a.txt", b"one\ntwo\n", 8, None), ("b c.txt", b"3", 1, None), ("big.txt", None, 101, FILE_TOO_LARGE)]
    assert {r.put_ts for r in files.collect()} == {dt.datetime(2023, 11, 14, 22, 13, 20)}
    lines = split_lines(files.where("error is null").drop("error"))
    assert sorted(bytes(r.value) for r in lines.collect()) == [b"3", b"one", b"two"]
    assert len(rows(read_files(spark, tmp))) == 4


def test_the_content_of_large_files_is_not_read(spark, tmp):
    put(tmp, "big", b"x" * 1000)
    before = spark.conf.get("spark.sql.sources.binaryFile.maxLength")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "100")  # the source raises on what it reads beyond
    try:
        assert rows(read_files(spark, tmp, max_file_bytes=100)) == [("big", None, 1000, FILE_TOO_LARGE)]
    finally:
        spark.conf.set("spark.sql.sources.binaryFile.maxLength", before)


def test_a_stream_takes_each_file_once(spark, tmp):
    inbox, sink, ckpt = f"{tmp}/in", f"{tmp}/sink", f"{tmp}/ckpt"
    put(inbox, "a", b"1")
    for name, data in (("b", b"2"), ("c", b"x" * 50)):
        drain(read_files_stream(spark, inbox, max_file_bytes=10, max_files_per_trigger=1), sink, ckpt)
        put(inbox, name, data)
    drain(read_files_stream(spark, inbox, max_file_bytes=10), sink, ckpt)
    drain(read_files_stream(spark, inbox, max_file_bytes=10), sink, ckpt)
    assert rows(spark.read.parquet(sink)) == [("a", b"1", 1, None), ("b", b"2", 1, None), ("c", None, 50, FILE_TOO_LARGE)]


def test_put_time_is_utc_in_any_zone(spark, tmp):
    put(tmp, "a", b"1")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert read_files(spark, tmp).select(F.col("put_ts").cast("string")).first()[0] == "2023-11-14 22:13:20"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_small_files_are_written_by_many_tasks(spark, tmp):
    fx.write_supplier_files(spark, "/root/testdata/sf0.001", f"{tmp}/files")
    tasks = {os.path.basename(r.msg_id).split("-")[1] for r in read_files(spark, f"{tmp}/files", glob="part-*").collect()}
    assert len(tasks) > 1  # few bytes, but a cost per file


def test_many_folders_are_listed_in_few_tasks(spark, tmp):
    for i in range(40):
        put(tmp, f"d{i}/a", b"1")
    beside = listing_session(spark, tasks=4)
    sc = spark.sparkContext
    sc.setJobGroup("listing", "listing")
    try:
        files = read_files(beside, tmp)
        tracker = sc.statusTracker()
        listed = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert listed and max(listed) <= 4
    assert files.count() == 40


def test_files_on_a_disk_are_what_spark_would_write(spark, tmp):
    names = [(1, "a"), (2, None), (50, "b"), (51, "é"), (51, "x"), (None, "c")]
    spark.createDataFrame(names, "s_suppkey long, s_name string").write.parquet(f"{tmp}/in/supplier.parquet")
    text = F.repeat("s_name", (F.col("s_suppkey") % 50).cast("int")).alias("value")
    spark.read.parquet(f"{tmp}/in/supplier.parquet").select("s_suppkey", text).repartition(4, "s_suppkey").write.partitionBy("s_suppkey").text(f"{tmp}/spark")
    fx.write_supplier_files(spark, f"{tmp}/in", f"{tmp}/files")

    def lines(folder):
        return sorted((r.msg_id.split("/")[-2], sorted(bytes(r.payload).split(b"\n"))) for r in read_files(spark, folder, glob="part-*").collect())

    assert lines(f"{tmp}/files") == lines(f"{tmp}/spark")
    beside = [f for _, _, fs in os.walk(f"{tmp}/files") for f in fs if not f.startswith("part-")]
    assert beside == []  # neither checksums, each with processes for its mode, nor parts of files
    with pytest.raises(FileExistsError):
        fx.write_supplier_files(spark, f"{tmp}/in", f"{tmp}/files")
    spark.createDataFrame([], "s_suppkey long, s_name string").write.parquet(f"{tmp}/none/supplier.parquet")
    fx.write_supplier_files(spark, f"{tmp}/none", f"{tmp}/empty")
    assert lines(f"{tmp}/empty") == []


def test_many_small_files_are_read_in_few_tasks(spark, tmp):
    for i in range(100):
        put(tmp, f"d{i}/a", b"1")
    beside = listing_session(spark)
    beside.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    files = read_files(beside, tmp)
    assert files.rdd.getNumPartitions() <= 2 * max(spark.sparkContext.defaultParallelism, 10)  # two scans, by length
    assert files.count() == 100


def test_files_are_drained_in_bounded_batches(spark, tmp, monkeypatch):
    monkeypatch.setattr(catalog, "FILES_A_BATCH", 4)
    monkeypatch.setattr(catalog, "_stream_dirs", lambda *_: (f"{tmp}/log", f"{tmp}/sink", f"{tmp}/checkpoint"))
    out = catalog.q_stream_file_messages(spark, "/root/testdata/sf0.001")
    keys = [r.s_suppkey for r in out.collect()]
    expected = [r.s_suppkey for r in fx.table(spark, "/root/testdata/sf0.001", "supplier").collect()]
    assert sorted(keys) == sorted(expected)
    assert len([f for f in os.listdir(f"{tmp}/checkpoint/commits") if f.isdigit()]) == -(-len(expected) // 4)
