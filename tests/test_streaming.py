import pytest
from pyspark.sql import functions as F

from queuelake.functions.message import message_value
from queuelake.operators.splitters import split_xml
from queuelake.schema import DEAD_LETTER_LOG_SCHEMA
from queuelake.session import stateful_session
from queuelake.sources.queue_log import read_queue, read_queue_stream, write_queue
from queuelake.streaming.drain import drain, read_mq, run_foreach_batch
from queuelake.streaming.segments import assemble_segments_stream
from queuelake.streaming.writer import QueueBatchWriter


def _xml_msgs(spark, start, n, bad_every=0):
    ids = spark.range(start, start + n)
    payload = F.concat(
        F.lit("<o><h><k>"),
        F.col("id").cast("string"),
        F.lit("</k></h><i><v>1</v></i><i><v>2</v></i>"),
        F.when((F.lit(bad_every) > 0) & (F.col("id") % F.lit(max(bad_every, 1)) == 0), F.lit("<i>")).otherwise(
            F.lit("")
        ),
        F.lit("</o>"),
    )
    return ids.select(F.col("id").cast("string").alias("msg_id"), payload.cast("binary").alias("payload"))


def test_available_now_twice_then_new_files(spark, tmp):
    write_queue(_xml_msgs(spark, 0, 20).repartition(3), tmp, "QM", "Q", "p", 1)
    stream = read_queue_stream(spark, tmp, "QM", "Q", max_files_per_trigger=1)
    recs = split_xml(stream.select("msg_id", message_value().alias("payload")), split="i")
    out = recs.select("msg_id", "pos", F.col("value").cast("string").alias("v"))
    sink, ckpt = f"{tmp}/sink", f"{tmp}/ckpt"
    drain(out, sink, ckpt)
    assert spark.read.parquet(sink).count() == 40
    drain(out, sink, ckpt)
    assert spark.read.parquet(sink).count() == 40
    write_queue(_xml_msgs(spark, 20, 5), tmp, "QM", "Q", "p", 2)
    drain(out, sink, ckpt)
    assert spark.read.parquet(sink).count() == 50
    # batch over the same log gives the same records
    batch = split_xml(read_queue(spark, tmp, "QM", "Q").select("msg_id", message_value().alias("payload")), split="i")
    assert sorted(map(tuple, batch.select("msg_id", "pos", F.col("value").cast("string")).collect())) == sorted(
        map(tuple, spark.read.parquet(sink).collect())
    )


def test_batch_writer_failure_replay_no_loss_no_dup(spark, tmp):
    log, out, ckpt = f"{tmp}/log", f"{tmp}/out", f"{tmp}/ckpt"
    write_queue(_xml_msgs(spark, 0, 30, bad_every=7).repartition(2), log, "QM", "Q", "p", 1)
    opts = {"queue": "Q", "queueManager": "QM", "path": log, "split": "i", "movePath": f"{tmp}/arch1,{tmp}/arch2"}
    writer = QueueBatchWriter(opts, out, producer="reader")
    calls = {"n": 0}

    def flaky(df, batch_id):
        writer(df, batch_id)
        calls["n"] += 1
        if calls["n"] == 1:
            raise RuntimeError("executor lost after the writes")

    stream = read_queue_stream(spark, log, "QM", "Q", max_files_per_trigger=1)
    with pytest.raises(Exception):
        run_foreach_batch(stream, flaky, ckpt)
    run_foreach_batch(stream, flaky, ckpt)
    good = spark.read.parquet(out)
    bad_ids = [i for i in range(30) if i % 7 == 0]
    assert good.count() == 2 * (30 - len(bad_ids))
    dead = read_queue(spark, log, "QM", "Q.BACKOUT", schema=DEAD_LETTER_LOG_SCHEMA)
    assert sorted(int(r.msg_id) for r in dead.collect()) == bad_ids
    assert {r.error for r in dead.select("error").collect()} == {"UNCLOSED_SPLIT"}
    for a in ("arch1", "arch2"):
        arch = spark.read.parquet(f"{tmp}/{a}")
        assert arch.count() == 30 and arch.select("archive_name").distinct().count() == 30


def test_read_mq_restart_and_rejected_options(spark, tmp):
    log, sink, ckpt = f"{tmp}/log", f"{tmp}/sink", f"{tmp}/ckpt"
    write_queue(_xml_msgs(spark, 0, 10), log, "QM", "Q", "p", 1)
    opts = {"path": log, "queue": "Q", "queueManager": "QM", "split": "i"}
    out = read_mq(spark, **opts).select(F.col("value").cast("string").alias("v"))
    drain(out, sink, ckpt)
    assert spark.read.parquet(sink).count() == 20
    drain(out, sink, ckpt)
    assert spark.read.parquet(sink).count() == 20
    write_queue(_xml_msgs(spark, 10, 3), log, "QM", "Q", "q", 5)
    drain(out, sink, ckpt)
    assert spark.read.parquet(sink).count() == 26
    for extra in ({"movePath": "x"}, {"backoutQueue": "b"}, {"error.queue": "e"}, {"ackQueue": "a"}):
        with pytest.raises(ValueError):
            read_mq(spark, **opts, **extra)


def test_two_readers_and_two_queues_share_targets(spark, tmp):
    """Same output and movePath: every row stays; a new checkpoint under an old
    name fails instead of losing its batches."""
    from queuelake.sources.fs import OwnershipError
    from queuelake.streaming.drain import process_mq

    log, out, arch = f"{tmp}/log", f"{tmp}/out", f"{tmp}/arch"
    write_queue(_xml_msgs(spark, 0, 3), log, "QM", "A", "p", 1)
    write_queue(_xml_msgs(spark, 10, 3), log, "QM", "B", "p", 1)
    opts = {"path": log, "queueManager": "QM", "split": "i", "movePath": arch}
    process_mq(spark, out, f"{tmp}/c1", "one", queue="A", **opts)
    process_mq(spark, out, f"{tmp}/c2", "two", queue="A", **opts)
    process_mq(spark, out, f"{tmp}/c3", "one", queue="B", **opts)
    assert spark.read.parquet(out).count() == 2 * 9
    got = spark.read.parquet(arch).groupBy("reader").count().collect()
    assert {(r.reader, r["count"]) for r in got} == {("QM-A-one", 3), ("QM-A-two", 3), ("QM-B-one", 3)}
    with pytest.raises(Exception, match="OwnershipError"):
        process_mq(spark, out, f"{tmp}/c4", "one", queue="A", **opts)
    assert OwnershipError


def test_dead_letters_keep_the_message(spark, tmp):
    from queuelake.streaming.drain import process_mq

    log = f"{tmp}/log"
    rows = [("a", 1, bytearray(b"corr"), bytearray(b"<r><i>")), ("b", 4, bytearray(b"<i>"), bytearray(b"report body")), ("c", 8, None, None)]
    write_queue(spark.createDataFrame(rows, "msg_id string, msg_type int, correl_id binary, payload binary"), log, "QM", "Q", "p", 1)
    process_mq(spark, f"{tmp}/out", f"{tmp}/ckpt", "r", path=log, queueManager="QM", queue="Q", split="i", movePath=f"{tmp}/arch")
    dead = {r.msg_id: r for r in read_queue(spark, log, "QM", "Q.BACKOUT", schema=DEAD_LETTER_LOG_SCHEMA).collect()}
    assert {k: (r.msg_type, r.correl_id, r.payload, r.error) for k, r in dead.items()} == {
        "a": (1, b"corr", b"<r><i>", "UNCLOSED_SPLIT"),
        "b": (4, b"<i>", b"report body", "UNCLOSED_SPLIT"),
        "c": (8, None, None, "NULL_PAYLOAD"),
    }
    assert {(r.msg_type, r.correl_id) for r in spark.read.parquet(f"{tmp}/arch").collect()} == {(1, b"corr"), (4, b"<i>"), (8, None)}


def test_sinks_refuse_failed_messages(spark, tmp):
    from queuelake.sources.kafka import kafka_shape
    from queuelake.streaming.drain import to_sink

    log = f"{tmp}/log"
    write_queue(_xml_msgs(spark, 0, 4, bad_every=2), log, "QM", "Q", "p", 1)
    opts = {"path": log, "queue": "Q", "queueManager": "QM", "split": "i"}
    with pytest.raises(Exception, match="FAILED_MESSAGE"):
        kafka_shape(read_mq(spark, stream=False, **opts), "t").collect()
    with pytest.raises(Exception, match="FAILED_MESSAGE"):
        to_sink(read_mq(spark, **opts), "queue", f"{tmp}/ckpt", root=log, queue_manager="QM", queue="OUT", producer="c")
    assert kafka_shape(read_mq(spark, stream=False, **opts).where("error is null"), "t").count() == 4


def test_stream_segments_complete_and_pending(spark, tmp):
    rows = [
        ("a0", "A", 0, False, b"ab"),
        ("a1", "A", 2, True, b"cd"),
        ("b0", "B", 0, False, b"xy"),
        ("p", None, None, None, b"plain"),
    ]
    df = spark.createDataFrame(rows, "msg_id string, group_id string, seg_offset int, last_segment boolean, payload binary")
    log, sink, ckpt = f"{tmp}/log", f"{tmp}/sink", f"{tmp}/ckpt"
    write_queue(df, log, "QM", "Q", "p", 1)
    stream = read_queue_stream(stateful_session(spark, 2), log, "QM", "Q").drop("producer", "seq")
    out = assemble_segments_stream(stream).select("group_id", "payload", "error")
    drain(out, sink, ckpt)
    got = sorted((r.group_id or "", bytes(r.payload), r.error) for r in spark.read.parquet(sink).collect())
    assert got == [("", b"plain", None), ("A", b"abcd", None)]
    # the missing segment arrives later: the pending group completes
    write_queue(
        spark.createDataFrame([("b1", "B", 2, True, b"z")], "msg_id string, group_id string, seg_offset int, last_segment boolean, payload binary"),
        log,
        "QM",
        "Q",
        "p",
        2,
    )
    drain(out, sink, ckpt)
    got = sorted((r.group_id, bytes(r.payload), r.error) for r in spark.read.parquet(sink).collect() if r.group_id == "B")
    assert got == [("B", b"xyz", None)]


def test_clean_source_archive_moves_consumed_files(spark, tmp):
    import glob

    log, sink, ckpt, arch = f"{tmp}/log", f"{tmp}/sink", f"{tmp}/ckpt", f"{tmp}/consumed"
    write_queue(_xml_msgs(spark, 0, 30).repartition(3), log, "QM", "Q", "p", 1)
    stream = read_queue_stream(spark, log, "QM", "Q", max_files_per_trigger=1, clean_source="archive", source_archive_dir=arch)
    drain(stream.select("msg_id"), sink, ckpt)
    assert spark.read.parquet(sink).count() == 30
    # files of all but the last batch have been moved (the last one moves with a later batch)
    assert len(glob.glob(f"{arch}/**/*.parquet", recursive=True)) >= 1


def test_read_mq_batch_and_queue_sink(spark, tmp):
    from queuelake.sources.kafka import kafka_shape
    from queuelake.streaming.drain import to_sink

    log = f"{tmp}/log"
    write_queue(_xml_msgs(spark, 0, 6), log, "QM", "IN", "p", 1)
    batch = read_mq(spark, stream=False, path=log, queue="IN", queueManager="QM", fileFormat="xml", split="i")
    assert batch.count() == 12 and batch.where("error is not null").count() == 0
    # records of a stream appended to another queue, one append per batch id
    stream = read_mq(spark, path=log, queue="IN", queueManager="QM", split="i")
    to_sink(stream, "queue", f"{tmp}/ckpt", root=log, queue_manager="QM", queue="OUT", producer="copier", keep=["msg_id"])
    out = read_queue(spark, log, "QM", "OUT")
    assert out.count() == 12 and {r.seq for r in out.select("seq").distinct().collect()} == {0}
    shaped = kafka_shape(batch, "orders", key="msg_id")
    assert shaped.columns == ["topic", "key", "value"] and dict(shaped.dtypes)["key"] == "binary"


@pytest.mark.parametrize(
    "fmt,opts,payloads",
    [
        ("JSON", {"split": "items"}, ['{"items":[1,{"a":2},"x"]}', '{"items":[]}', '{"z":1,"items":[1]}']),
        ("JSON", {}, ['{"k": 1}', "[1, 2]", "bad"]),
        ("FIXED_WIDTH", {}, ["a\nb\n", "", "c\r\nd"]),
        ("XML", {"split": "i", "headers": "h"}, ["<r><h>1</h><i>2</i></r>", "<r><i>2</i></r>"]),
    ],
)
def test_stream_equals_batch_for_every_splitter(spark, tmp, fmt, opts, payloads):
    from queuelake.operators.splitters import split_records

    df = spark.createDataFrame([(str(i), p.encode()) for i, p in enumerate(payloads)], "msg_id string, payload binary")
    log, sink, ckpt = f"{tmp}/log", f"{tmp}/sink", f"{tmp}/ckpt"
    write_queue(df, log, "QM", "Q", "p", 1)
    cols = ["msg_id", "pos", F.col("value").cast("string").alias("v"), "error"]
    batch = split_records(read_queue(spark, log, "QM", "Q").select("msg_id", "payload"), fmt, **opts).select(*cols)
    stream = split_records(read_queue_stream(spark, log, "QM", "Q").select("msg_id", "payload"), fmt, **opts)
    drain(stream.select(*cols), sink, ckpt)
    key = lambda r: (r.msg_id, -1 if r.pos is None else r.pos, r.v or "", r.error or "")
    assert sorted(map(key, batch.collect())) == sorted(map(key, spark.read.parquet(sink).collect()))


SEGMENTS = "msg_id string, group_id string, seg_offset int, last_segment boolean, payload binary, put_ts timestamp_ntz"


def test_stream_segments_oversized_group_released(spark, tmp):
    rows = [("h%d" % i, "HOT", i * 2, False, b"xx", None) for i in range(40)]
    log, sink, ckpt = f"{tmp}/log", f"{tmp}/sink", f"{tmp}/ckpt"
    write_queue(spark.createDataFrame(rows, SEGMENTS), log, "QM", "Q", "p", 1)
    stream = read_queue_stream(stateful_session(spark, 2), log, "QM", "Q").drop("producer", "seq")
    drain(assemble_segments_stream(stream, max_message_bytes=50).select("group_id", "seg_offset", "payload", "error"), sink, ckpt)
    got = spark.read.parquet(sink).collect()
    assert len(got) == 40 and {r.error for r in got} == {"GROUP_TOO_LARGE"}


def test_stream_segments_late_redelivered_and_conflicting(spark, tmp):
    """Put times hours apart, segments again and out of order: every group comes
    out, and as the batch operator has it."""
    import datetime as dt

    from queuelake.operators.segments import assemble_segments

    day = dt.datetime(2024, 5, 1)
    first = [("n", "NEW", 0, True, b"new", day), ("l0", "LATE", 0, False, b"la", day), ("o1", "ORDER", 2, True, b"er", day), ("x0", "CONF", 0, False, b"aa", day)]
    second = [
        ("l1", "LATE", 2, True, b"te", day - dt.timedelta(hours=9)),
        ("old", "OLD", 0, True, b"old", day - dt.timedelta(days=3)),
        ("o0", "ORDER", 0, False, b"or", day - dt.timedelta(days=1)),
        ("x0", "CONF", 0, False, b"bb", day),
        ("i0", "INC", 0, False, b"in", None),
        ("i0 again", "INC", 0, False, b"in", day),
    ]
    log, sink, ckpt = f"{tmp}/log", f"{tmp}/sink", f"{tmp}/ckpt"
    stream = lambda: assemble_segments_stream(read_queue_stream(stateful_session(spark, 2), log, "QM", "Q").drop("producer", "seq"), delay="0 seconds").select("group_id", "payload", "error")
    for seq, rows in enumerate((first, second, [("z", "Z", 0, True, b"z", day)])):
        write_queue(spark.createDataFrame(rows, SEGMENTS), log, "QM", "Q", "p", seq)
        if seq:
            drain(stream(), sink, ckpt)
    got = sorted((r.group_id, bytes(r.payload), r.error) for r in spark.read.parquet(sink).collect() if r.group_id != "Z")
    assert got == [
        ("CONF", b"aa", "CONFLICTING_SEGMENTS"),
        ("CONF", b"bb", "CONFLICTING_SEGMENTS"),
        ("INC", b"in", "INCOMPLETE_GROUP"),
        ("LATE", b"late", None),
        ("NEW", b"new", None),
        ("OLD", b"old", None),
        ("ORDER", b"orer", None),
    ]
    batch = assemble_segments(spark.createDataFrame(first + second, SEGMENTS)).collect()
    assert sorted((r.group_id, bytes(r.payload), r.error) for r in batch) == got


def test_batch_writer_error_queue_with_ack(spark, tmp):
    log, out, ckpt = f"{tmp}/log", f"{tmp}/out", f"{tmp}/ckpt"
    write_queue(_xml_msgs(spark, 0, 10, bad_every=4), log, "QM", "Q", "p", 1)
    opts = {
        "queue": "Q",
        "queueManager": "QM",
        "path": log,
        "split": "i",
        "error.queue": "Q.ERR",
        "error.queueManager": "QE",
        "ackQueue": "Q.ACK",
    }
    run_foreach_batch(read_queue_stream(spark, log, "QM", "Q"), QueueBatchWriter(opts, out, "r"), ckpt)
    dead = read_queue(spark, log, "QE", "Q.ERR", schema=DEAD_LETTER_LOG_SCHEMA).collect()
    assert sorted(int(r.msg_id) for r in dead) == [0, 4, 8]
    assert {(r.reply_to_qmgr, r.reply_to_queue, tuple(r.report)) for r in dead} == {("QM", "Q.ACK", ("COA", "COD"))}
    assert read_queue(spark, log, "QM", "Q.BACKOUT").count() == 0  # the error queue disables the backout queue
    assert spark.read.parquet(out).count() == 2 * 7
