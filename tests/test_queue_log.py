import pytest
from pyspark.sql import functions as F

from queuelake.sources.fs import write_once
from queuelake.sources.queue_log import read_queue, seq_dir, write_queue


def _msgs(spark, n, start=0, msg_type=8):
    return spark.range(start, start + n).select(
        F.col("id").cast("string").alias("msg_id"),
        F.lit(msg_type).alias("msg_type"),
        F.col("id").cast("string").cast("binary").alias("correl_id"),
        F.concat(F.lit("m"), F.col("id").cast("string")).cast("binary").alias("payload"),
    )


def test_roundtrip_idempotent_and_partitions(spark, tmp):
    write_queue(_msgs(spark, 10), tmp, "QM", "Q", producer="a", seq=1)
    write_queue(_msgs(spark, 10), tmp, "QM", "Q", producer="a", seq=1)  # retry: skipped
    write_queue(_msgs(spark, 5, 10), tmp, "QM", "Q", producer="b", seq=7)
    df = read_queue(spark, tmp, "QM", "Q")
    assert df.count() == 15
    assert sorted(r.seq for r in df.select("seq").distinct().collect()) == [1, 7]
    one = read_queue(spark, tmp, "QM", "Q", num_partitions=1)
    many = read_queue(spark, tmp, "QM", "Q", num_partitions=7)
    assert one.rdd.getNumPartitions() == 1 and many.rdd.getNumPartitions() == 7
    assert sorted(map(tuple, one.select("msg_id", "payload").collect())) == sorted(
        map(tuple, many.select("msg_id", "payload").collect())
    )
    assert read_queue(spark, tmp, "QM", "EMPTY").count() == 0


def test_write_once_skips_finished_and_refuses_foreign_folders(spark, tmp):
    import os

    assert write_once(_msgs(spark, 3), f"{tmp}/x")
    assert not write_once(_msgs(spark, 9), f"{tmp}/x")
    assert spark.read.parquet(f"{tmp}/x").count() == 3
    os.makedirs(f"{tmp}/y")
    open(f"{tmp}/y/junk.parquet", "w").write("not ours")
    with pytest.raises(RuntimeError):
        write_once(_msgs(spark, 3), f"{tmp}/y")


def test_unfinished_appends_stay_hidden(spark, tmp, monkeypatch):
    """A crash before the rename: neither batch nor stream sees the rows."""
    import queuelake.sources.fs as fs
    from queuelake.sources.queue_log import read_queue_stream
    from queuelake.streaming.drain import drain

    write_queue(_msgs(spark, 3), tmp, "QM", "Q", producer="a", seq=1)
    with monkeypatch.context() as m:
        m.setattr(fs, "_write_text", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
        with pytest.raises(RuntimeError):
            write_once(_msgs(spark, 5, 10), seq_dir(tmp, "QM", "Q", "a", 2), owner="x")
    assert read_queue(spark, tmp, "QM", "Q").count() == 3
    drain(read_queue_stream(spark, tmp, "QM", "Q").select("msg_id"), f"{tmp}/sink", f"{tmp}/ckpt")
    assert spark.read.parquet(f"{tmp}/sink").count() == 3
    write_queue(_msgs(spark, 5, 10), tmp, "QM", "Q", producer="a", seq=2)  # the retry
    drain(read_queue_stream(spark, tmp, "QM", "Q").select("msg_id"), f"{tmp}/sink", f"{tmp}/ckpt")
    assert read_queue(spark, tmp, "QM", "Q").count() == spark.read.parquet(f"{tmp}/sink").count() == 8


def test_unreachable_file_system_raises(spark):
    with pytest.raises(Exception):
        read_queue(spark, "nosuchscheme://host/logs", "QM", "Q")


def test_owner_of_a_target(spark, tmp):
    from queuelake.sources.fs import OwnershipError

    assert write_once(_msgs(spark, 3), f"{tmp}/t", owner="one")
    assert not write_once(_msgs(spark, 3), f"{tmp}/t", owner="one")
    with pytest.raises(OwnershipError):
        write_once(_msgs(spark, 3), f"{tmp}/t", owner="two")


def test_a_file_of_the_queue_is_read_by_several_tasks(spark, tmp):
    """A row group is read by one task: a file has one for every few megabytes."""
    import pyarrow.parquet as pq

    noise = F.unhex(F.array_join(F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: F.sha2(F.concat_ws("-", "id", i), 256)), ""))
    write_queue(spark.range(6000).coalesce(1).select(noise.alias("payload")), tmp, "QM", "Q", "p", 1)
    [path] = read_queue(spark, tmp, "QM", "Q").inputFiles()
    file = pq.ParquetFile(path.removeprefix("file://"))
    assert file.metadata.num_rows == 6000 and file.num_row_groups >= 3
    rows = spark.read.option("basePath", f"{tmp}/QM/Q").parquet(path)
    assert rows.select("payload").distinct().count() == 6000
