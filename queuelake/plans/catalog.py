"""The registered queries: one per operator, each over the whole tables.

Every query builds its messages from the given tables (``plans.fixtures``),
runs the operator under test and returns plain columns that an SQL oracle
computes straight from the same tables, so a splitter or router error shows
up as a mismatch.  Queries that write (queue logs, archives, streams) use a
fresh folder below the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import json
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.message import archive_name, message_value
from ..functions.parse import fixed_width_columns, json_struct, parse_fixed_width, parse_json, parse_xml, xml_struct
from ..operators.groups import complete_messages
from ..operators.routing import route_failures
from ..operators.segments import assemble_segments
from ..operators.splitters import (
    expression_splitter,
    python_splitter,
    register_splitter,
    split_json,
    split_lines,
    split_records,
    split_xml,
    udtf_splitter,
)
from ..options import dead_letter_target
from ..schema import DEAD_LETTER_LOG_SCHEMA, GROUP_LOG_SCHEMA, LOG_SCHEMA
from ..session import listing_session, shared_dir, stateful_session
from ..sources.archive import archive
from ..sources.files import read_files, read_files_stream
from ..sources.fs import path_exists
from ..sources.kafka import kafka_shape
from ..sources.queue_log import read_queue, read_queue_stream, write_queue
from ..sources.xml_files import read_xml_files
from ..streaming.confirmations import confirmations
from . import fixtures as fx

# The queue names the checks use.
QMGR = "QM1"
QUEUE = "ORDERS"
ERROR_QMGR = "QMERR"
ERROR_QUEUE = "ORDERS.ERR"
ACK_QUEUE = "ORDERS.ACK"

ITEM_XML_SCHEMA = "l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string"
ROOT_XML_SCHEMA = (
    "header struct<o_orderkey: bigint, o_orderstatus: string>, "
    "item struct<l_linenumber: int, l_quantity: double, l_extendedprice: double, l_returnflag: string>"
)
LINE_JSON_SCHEMA = (
    "l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate date"
)


def _str(c: str):
    return F.col(c).cast("string")


def _base_opts(**extra) -> dict:
    return {"queue": QUEUE, "queueManager": QMGR, **extra}


# ---------------------------------------------------------------- XML


def header_enriched_items(msgs: DataFrame, payload: str = "payload") -> DataFrame:
    """split XML on ``item`` with the ``header`` block, parse, flatten."""
    return _header_items(split_xml(msgs, split="item", headers=["header"], payload=payload))


def _header_items(recs: DataFrame) -> DataFrame:
    p = recs.select(xml_struct("value", ROOT_XML_SCHEMA, corrupt=None).alias("r"))
    return p.select(
        F.col("r.header.o_orderkey").alias("o_orderkey"),
        F.col("r.header.o_orderstatus").alias("o_orderstatus"),
        F.col("r.item.l_linenumber").alias("l_linenumber"),
        F.col("r.item.l_quantity").alias("l_quantity"),
        F.col("r.item.l_extendedprice").alias("l_extendedprice"),
        F.col("r.item.l_returnflag").alias("l_returnflag"),
    )


def q_xml_revenue_by_status(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: order messages -> XML items with header -> revenue per status."""
    items = header_enriched_items(fx.order_xml_messages(spark, d))
    return items.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("decimal(38,2)").alias("sum_qty"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(38,2)").alias("revenue"),
    )


def q_xml_header_enrich(spark: SparkSession, d: str) -> DataFrame:
    return header_enriched_items(fx.order_xml_messages(spark, d))


def q_xml_split(spark: SparkSession, d: str) -> DataFrame:
    """Pretty-printed order messages, split on ``item`` (no header)."""
    msgs = fx.order_xml_messages(spark, d, pretty=True)
    recs = split_xml(msgs, split="item")
    p = recs.select("o_orderkey", xml_struct("value", ITEM_XML_SCHEMA, corrupt=None).alias("i"))
    return p.select("o_orderkey", "i.l_linenumber", "i.l_quantity", "i.l_extendedprice", "i.l_returnflag")


def q_xml_whole(spark: SparkSession, d: str) -> DataFrame:
    recs = split_xml(fx.page_messages(spark, d))
    return recs.select("page_id", "pos", _str("value").alias("value"))


def q_xml_split_pages(spark: SparkSession, d: str) -> DataFrame:
    recs = split_xml(fx.page_messages(spark, d), split="li", layout="raw")
    return recs.select("page_id", "pos", _str("value").alias("value"), "error")


# ---------------------------------------------------------------- lines


def q_split_lines(spark: SparkSession, d: str) -> DataFrame:
    recs = split_lines(fx.document_messages(spark, d))
    return recs.select("doc_id", "pos", _str("value").alias("value"))


def q_split_lines_encoding(spark: SparkSession, d: str) -> DataFrame:
    msgs = fx.conversation_messages(spark, d)
    out = None
    for charset in ("ISO-8859-1", "UTF-16BE"):
        recs = split_lines(msgs.where(F.col("charset") == charset), encoding=charset)
        part = recs.select("conv_id", "turn", "pos", F.decode("value", charset).alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


def q_fixed_width_columns(spark: SparkSession, d: str) -> DataFrame:
    recs = split_lines(fx.event_line_messages(spark, d))
    return recs.select(*fixed_width_columns("value", fx.EVENT_LAYOUT))


# ---------------------------------------------------------------- JSON


def q_json_whole(spark: SparkSession, d: str) -> DataFrame:
    recs = split_json(fx.event_props_messages(spark, d))
    return recs.select(
        "event_id",
        "pos",
        _str("value").alias("value"),
        json_struct("value", "k bigint", corrupt=None)["k"].alias("k"),
    )


def q_json_split(spark: SparkSession, d: str) -> DataFrame:
    recs = split_json(fx.order_json_messages(spark, d), split="items")
    p = recs.select("o_orderkey", json_struct("value", LINE_JSON_SCHEMA, corrupt=None).alias("j"))
    return p.select(
        "o_orderkey",
        "j.l_linenumber",
        "j.l_partkey",
        "j.l_suppkey",
        "j.l_quantity",
        "j.l_extendedprice",
        "j.l_discount",
        "j.l_tax",
        "j.l_returnflag",
        "j.l_linestatus",
        F.date_format("j.l_shipdate", "yyyy-MM-dd").alias("l_shipdate"),
    )


def q_json_split_scalars(spark: SparkSession, d: str) -> DataFrame:
    recs = split_json(fx.part_json_messages(spark, d), split="vals")
    return recs.select("p_partkey", "pos", _str("value").alias("value"))


def q_json_exact_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Numbers of 23 digits, as elements and inside of elements."""
    recs = split_json(fx.order_exact_messages(spark, d), split="vals")
    v = _str("value")
    number = F.when(F.col("pos") == 0, v.try_cast("decimal(38,12)")).otherwise(json_struct("value", "x decimal(38,12)", corrupt=None)["x"])
    return recs.select("o_orderkey", "pos", number.alias("number"))


def q_json_lexemes(spark: SparkSession, d: str) -> DataFrame:
    """Elements as written, white space apart; what is no strict JSON whole."""
    recs = split_json(fx.part_lexeme_messages(spark, d), split="vals")
    return recs.select("p_partkey", "pos", _str("value").alias("value"), "error")


def q_xml_spans(spark: SparkSession, d: str) -> DataFrame:
    """Records beside comments, CDATA and instructions that hold the same tag; a
    message whose comment never ends comes out whole."""
    recs = split_xml(fx.document_span_messages(spark, d), split="line", layout="raw")
    return recs.select("doc_id", "pos", F.when(F.col("error").isNull(), _str("value")).alias("value"), "error")


# ---------------------------------------------------------------- typed views of malformed records


def q_parse_malformed(spark: SparkSession, d: str) -> DataFrame:
    """A record that can not be parsed gives nulls, and its text where the
    schema asks for it; the others are not touched."""
    recs = fx.broken_records(spark, d)
    recs = parse_json(recs, "c bigint, _corrupt_record string", value="json", into="j")
    recs = parse_xml(recs, "c bigint, _corrupt_record string", value="xml", into="x")
    recs = parse_fixed_width(recs, [("fixed_key", 1, 20, "bigint"), ("fixed_cust", 21, 20, "bigint")], value="fixed")
    return recs.select(
        "o_orderkey", F.col("j.c").alias("json_cust"), F.col("j._corrupt_record").alias("json_corrupt"),
        F.col("x.c").alias("xml_cust"), F.col("x._corrupt_record").alias("xml_corrupt"), "fixed_key", "fixed_cust",
    )


# ---------------------------------------------------------------- dispatch / registry


def q_split_dispatch(spark: SparkSession, d: str) -> DataFrame:
    xml = split_records(fx.order_xml_messages(spark, d), "xml", split="item", headers=["header"])
    xml = xml.select(
        F.lit("XML").alias("fmt"),
        "o_orderkey",
        xml_struct("value", ROOT_XML_SCHEMA, corrupt=None)["item"].alias("i"),
    ).select("fmt", "o_orderkey", "i.l_linenumber", "i.l_quantity")
    js = split_records(fx.order_json_messages(spark, d), "json", split="items")
    js = js.select(
        F.lit("JSON").alias("fmt"), "o_orderkey", json_struct("value", LINE_JSON_SCHEMA, corrupt=None).alias("i")
    ).select("fmt", "o_orderkey", "i.l_linenumber", "i.l_quantity")
    fw = split_records(fx.order_fixed_width_messages(spark, d), "fixed_width")
    fw = fw.select(F.lit("FIXED_WIDTH").alias("fmt"), "o_orderkey", *fixed_width_columns("value", fx.ITEM_LINE_LAYOUT))
    return xml.unionByName(js).unionByName(fw)


def _words(payload: bytes):
    return payload.split(b" ")


def _part_words(spark: SparkSession, d: str, name: str) -> DataFrame:
    recs = split_records(fx.part_name_messages(spark, d), name)
    return recs.select("p_partkey", "pos", _str("value").alias("value"))


def q_custom_splitter(spark: SparkSession, d: str) -> DataFrame:
    register_splitter("WORDS", expression_splitter(lambda p: F.split(p.cast("string"), " ")))
    return _part_words(spark, d, "words")


def q_custom_splitter_python(spark: SparkSession, d: str) -> DataFrame:
    register_splitter("PYWORDS", python_splitter(_words))
    return _part_words(spark, d, "pywords")


def q_custom_splitter_udtf(spark: SparkSession, d: str) -> DataFrame:
    @F.udtf(returnType="pos int, value binary")
    class Words:
        def eval(self, payload: bytes):
            yield from enumerate(bytes(payload).split(b" "))

    register_splitter("TVFWORDS", udtf_splitter(Words))
    return _part_words(spark, d, "tvfwords")


def _json_words(payload: bytes):
    try:
        words = json.loads(payload)
    except ValueError:
        return None
    return [w if w is None else w.encode() for w in words]


def q_custom_splitter_faults(spark: SparkSession, d: str) -> DataFrame:
    """The same faults through the three routes: each is one row of the whole
    message, nothing else of it comes out."""

    @F.udtf(returnType="pos int, value binary")
    class Words:
        def eval(self, payload: bytes):
            words = _json_words(payload)
            return None if words is None else list(enumerate(words))

    register_splitter("JSONWORDS_EXPRESSION", expression_splitter(lambda p: F.from_json(p.cast("string"), "array<string>")))
    register_splitter("JSONWORDS_PYTHON", python_splitter(_json_words))
    register_splitter("JSONWORDS_UDTF", udtf_splitter(Words))
    out = None
    for route in ("expression", "python", "udtf"):
        recs = split_records(fx.part_faulty_messages(spark, d), f"jsonwords_{route}")
        part = recs.select(F.lit(route).alias("route"), "p_partkey", "pos", _str("value").alias("value"), "error")
        out = part if out is None else out.unionByName(part)
    return out


# ---------------------------------------------------------------- messages


def q_assemble_segments(spark: SparkSession, d: str) -> DataFrame:
    msgs = assemble_segments(fx.segmented_document_messages(spark, d).drop("doc_id"))
    return msgs.select(F.col("group_id").cast("bigint").alias("doc_id"), _str("payload").alias("text"), "error")


def q_report_correlation_value(spark: SparkSession, d: str) -> DataFrame:
    msgs = fx.order_report_messages(spark, d)
    return msgs.select("o_orderkey", message_value().cast("string").alias("value"))


# ---------------------------------------------------------------- routing


def _dead_orders(spark: SparkSession, d: str, options: dict) -> DataFrame:
    recs = split_xml(fx.truncated_order_messages(spark, d), split="item")
    _, dead = route_failures(recs, options)
    return dead


def _process_truncated(spark: SparkSession, d: str, name: str, **extra: str) -> DataFrame:
    """F7 through ``process_mq``: good records, dead letters and the archive,
    read back from where they were written."""
    from ..streaming.drain import process_mq

    log, sink, ckpt = _stream_dirs(spark, name)
    archive_dir = log.rsplit("/", 1)[0] + "/archive"
    append = write_queue(fx.truncated_order_messages(spark, d).drop("o_orderkey"), log, QMGR, QUEUE, "orders", 1)
    opts = _base_opts(path=log, fileFormat="XML", split="item", movePath=archive_dir, ackQueue=ACK_QUEUE, **extra)
    process_mq(spark, sink, ckpt, "checker", max_files_per_trigger=_two_batches(spark, append), **opts)
    t = dead_letter_target(opts)
    none = lambda kind: F.lit(None).cast(kind)
    cols = ["kind", "o_orderkey", "l_linenumber", "l_quantity", "payload", "error", "reply_to"]
    key = F.col("msg_id").cast("bigint").alias("o_orderkey")
    item = xml_struct("value", ITEM_XML_SCHEMA, corrupt=None)
    good = spark.read.parquet(sink).select("msg_id", item.alias("i")).select(
        F.lit("good").alias("kind"), key, "i.l_linenumber", "i.l_quantity", none("string").alias("payload"), none("string").alias("error"), none("string").alias("reply_to"))
    dead = read_queue(spark, log, t.queue_manager, t.queue, schema=DEAD_LETTER_LOG_SCHEMA).select(
        F.lit(f"{t.queue_manager}/{t.queue}").alias("kind"), key, none("int").alias("l_linenumber"), none("double").alias("l_quantity"),
        _str("payload").alias("payload"), "error", F.concat_ws("/", "reply_to_qmgr", "reply_to_queue", F.array_join("report", "+")).alias("reply_to"))
    kept = spark.read.parquet(archive_dir).select(
        F.lit("archive").alias("kind"), key, none("int").alias("l_linenumber"), none("double").alias("l_quantity"),
        _str("payload").alias("payload"), none("string").alias("error"), none("string").alias("reply_to"))
    return good.select(*cols).union(dead.select(*cols)).union(kept.select(*cols))


def q_dead_letter_backout(spark: SparkSession, d: str) -> DataFrame:
    return _process_truncated(spark, d, "dead_letter_backout")


def q_dead_letter_error_queue(spark: SparkSession, d: str) -> DataFrame:
    return _process_truncated(spark, d, "dead_letter_error", **{"error.queue": ERROR_QUEUE, "error.queueManager": ERROR_QMGR})


# Option sets of the dead-letter target check.
TARGET_CONFIGS = [
    ("default", {}),
    ("backout", {"backoutQueue": "ORDERS.BO"}),
    ("error", {"error.queue": ERROR_QUEUE}),
    ("error_qmgr", {"error.queue": ERROR_QUEUE, "error.queueManager": ERROR_QMGR, "backoutQueue": "ORDERS.BO"}),
]


def q_dead_letter_target(spark: SparkSession, d: str) -> DataFrame:
    recs = split_xml(fx.truncated_order_messages(spark, d), split="item")
    failed = recs.where(F.col("error").isNotNull()).select("o_orderkey")
    targets = [(name, dead_letter_target(_base_opts(**extra))) for name, extra in TARGET_CONFIGS]
    rows = F.array(*[
        F.struct(F.lit(name).alias("config"), F.lit(t.queue_manager).alias("target_qmgr"), F.lit(t.queue).alias("target_queue"))
        for name, t in targets
    ])
    return failed.select("o_orderkey", F.inline(rows))


def q_ack_request(spark: SparkSession, d: str) -> DataFrame:
    dead = _dead_orders(spark, d, _base_opts(ackQueue=ACK_QUEUE))
    return dead.select(
        "o_orderkey", "reply_to_qmgr", "reply_to_queue", F.array_join("report", ",").alias("report")
    )


# ---------------------------------------------------------------- queue log, archive, sinks


def _plain_value(df: DataFrame) -> DataFrame:
    return df.select(F.col("msg_id").cast("bigint").alias("o_orderkey"), _str("payload").alias("value"))


def q_queue_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    root = shared_dir(spark, "queue_roundtrip", unique=True)
    msgs = fx.order_plain_messages(spark, d).drop("o_orderkey")
    write_queue(msgs, root, QMGR, QUEUE, producer="orders", seq=1)
    write_queue(msgs, root, QMGR, QUEUE, producer="orders", seq=1)  # retried append: skipped
    return _plain_value(read_queue(spark, root, QMGR, QUEUE))


def q_parallel_scan(spark: SparkSession, d: str) -> DataFrame:
    root = shared_dir(spark, "parallel_scan", unique=True)
    msgs = fx.order_plain_messages(spark, d).drop("o_orderkey")
    write_queue(msgs, root, QMGR, QUEUE, producer="orders", seq=1)
    return _plain_value(read_queue(spark, root, QMGR, QUEUE, num_partitions=16))


def q_archive_fanout(spark: SparkSession, d: str) -> DataFrame:
    base = shared_dir(spark, "archive_fanout", unique=True)
    paths = [f"{base}/a1", f"{base}/a2"]
    msgs = fx.order_plain_messages(spark, d)
    archive(msgs, paths, batch_id=0, data_source=QUEUE)
    out = None
    for label, p in zip(("a1", "a2"), paths):
        part = spark.read.parquet(p).select(F.lit(label).alias("archive"), "archive_name", "msg_id", "msg_type", _str("payload").alias("payload"))
        out = part if out is None else out.unionByName(part)
    return out


def q_archive_name(spark: SparkSession, d: str) -> DataFrame:
    msgs = fx.order_plain_messages(spark, d)
    return msgs.select("o_orderkey", archive_name(QUEUE).alias("archive_name"))


def q_kafka_shape(spark: SparkSession, d: str) -> DataFrame:
    recs = split_lines(fx.order_plain_messages(spark, d))
    k = kafka_shape(recs, "orders", key="msg_id", value="value")
    return k.select("topic", _str("key").alias("key"), _str("value").alias("value"))


#: Files beyond it are error rows in the checks.
SMALL_FILE = 400

#: Files of a micro-batch: the driver holds their names and states several times.
FILES_A_BATCH = 50_000


def _file_rows(files: DataFrame) -> DataFrame:
    key = F.regexp_extract("msg_id", "s_suppkey=([0-9]+)/", 1).cast("bigint")
    return files.select(key.alias("s_suppkey"), _str("payload").alias("value"), "n_bytes", "error")


def q_file_messages(spark: SparkSession, d: str) -> DataFrame:
    """A file per supplier, read as messages; the longer ones as error rows."""
    path = shared_dir(spark, "file_messages", unique=True)
    fx.write_supplier_files(spark, d, path)
    return _file_rows(read_files(listing_session(spark), path, glob="part-*", max_file_bytes=SMALL_FILE))


def q_xml_file_records(spark: SparkSession, d: str) -> DataFrame:
    """A document per nation in a file, read in pieces: a record per customer with
    the file's header; a file without one is an error."""
    path = shared_dir(spark, "xml_files", unique=True)
    fx.write_nation_documents(spark, d, path)
    recs = read_xml_files(spark, path, "customer", headers="header", glob="part-*")
    return recs.select(F.regexp_extract("file", "c_nationkey=(\\d+)", 1).cast("long").alias("c_nationkey"), _str("value").alias("value"), "error")


# ---------------------------------------------------------------- streams


def q_stream_file_messages(spark: SparkSession, d: str) -> DataFrame:
    """The same files as a stream, drained twice: every file comes once."""
    from ..streaming.drain import drain

    path, sink, ckpt = _stream_dirs(spark, "stream_files")
    fx.write_supplier_files(spark, d, path)
    spark = listing_session(spark)
    for _ in range(2):
        files = read_files_stream(spark, path, glob="part-*", max_file_bytes=SMALL_FILE, max_files_per_trigger=FILES_A_BATCH)
        drain(_file_rows(files), sink, ckpt)
    return spark.read.parquet(sink)


def _confirmed(df: DataFrame) -> DataFrame:
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return df.select(F.col("msg_id").cast("long").alias("o_orderkey"), "kind", day("put_ts").alias("put"), day("confirmed_ts").alias("confirmed"))


def q_confirmations(spark: SparkSession, d: str) -> DataFrame:
    """Reports matched to the dead letters of the orders, as a batch."""
    return _confirmed(confirmations(*fx.order_letters_and_reports(spark, d)))


def q_stream_confirmations(spark: SparkSession, d: str) -> DataFrame:
    """The same from two streams: what is not confirmed comes out once the
    watermarks have passed the bound."""
    from ..streaming.drain import drain

    path, sink, ckpt = _stream_dirs(spark, "stream_confirmations")
    # the rows within the bound are state: on disk, in a store per core
    spark = stateful_session(spark, spark.sparkContext.defaultParallelism)
    inputs = []
    for name, df in zip(("dead", "reports"), fx.order_letters_and_reports(spark, d)):
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        inputs.append(spark.readStream.schema(df.schema).parquet(f"{path}/{name}"))
    drain(confirmations(*inputs, delay="12 hours"), sink, ckpt)
    return _confirmed(spark.read.parquet(sink))


def _stream_dirs(spark: SparkSession, name: str) -> tuple[str, str, str]:
    base = shared_dir(spark, name, unique=True)
    return f"{base}/log", f"{base}/sink", f"{base}/checkpoint"


def _two_batches(spark: SparkSession, append_path: str) -> int:
    """``maxFilesPerTrigger`` that drains an append in two micro-batches,
    whatever number of files the producer wrote (its partition count)."""
    n = len(spark.read.parquet(append_path).inputFiles())
    return max(1, -(-n // 2))


def q_stream_queue_scan(spark: SparkSession, d: str) -> DataFrame:
    from ..streaming.drain import drain

    log, sink, ckpt = _stream_dirs(spark, "stream_queue_scan")
    append = write_queue(fx.order_xml_messages(spark, d).drop("o_orderkey"), log, QMGR, QUEUE, "orders", 1)
    stream = read_queue_stream(spark, log, QMGR, QUEUE, max_files_per_trigger=_two_batches(spark, append))
    msgs = stream.select("msg_id", message_value().alias("payload"))
    drain(header_enriched_items(msgs), sink, ckpt)
    return spark.read.parquet(sink)


def q_stream_drain_available_now(spark: SparkSession, d: str) -> DataFrame:
    from ..streaming.drain import drain

    log, sink, ckpt = _stream_dirs(spark, "stream_drain")
    append = write_queue(fx.order_plain_messages(spark, d).drop("o_orderkey"), log, QMGR, QUEUE, "orders", 1)
    stream = _plain_value(read_queue_stream(spark, log, QMGR, QUEUE, max_files_per_trigger=_two_batches(spark, append)))
    drain(stream, sink, ckpt)
    drain(stream, sink, ckpt)  # nothing new: adds no rows
    return spark.read.parquet(sink)


def q_stream_mq_source(spark: SparkSession, d: str) -> DataFrame:
    """The documented options in one call: split with a header, to records."""
    from ..streaming.drain import process_mq

    log, sink, ckpt = _stream_dirs(spark, "stream_mq_source")
    append = write_queue(fx.order_xml_messages(spark, d).drop("o_orderkey"), log, QMGR, QUEUE, "orders", 1)
    opts = _base_opts(path=log, fileFormat="XML", split="item", headers="header", backoutQueue="ORDERS.BO")
    process_mq(spark, sink, ckpt, "reader", max_files_per_trigger=_two_batches(spark, append), **opts)
    return _header_items(spark.read.parquet(sink))


def q_stream_commit_replay(spark: SparkSession, d: str) -> DataFrame:
    """A failure after a batch's writes and before its commit: the batch runs
    again, nothing is lost and nothing twice."""
    from ..streaming.drain import run_foreach_batch
    from ..streaming.writer import QueueBatchWriter

    log, sink, ckpt = _stream_dirs(spark, "stream_commit_replay")
    append = write_queue(fx.order_xml_messages(spark, d).drop("o_orderkey"), log, QMGR, QUEUE, "orders", 1)
    writer = QueueBatchWriter(_base_opts(path=log, split="item", headers="header"), sink, producer="reader")
    ran: list[int] = []

    def fails_first(batch: DataFrame, batch_id: int) -> None:
        writer(batch, batch_id)
        ran.append(batch_id)
        if len(ran) == 1:
            raise RuntimeError("lost after the writes")

    stream = read_queue_stream(spark, log, QMGR, QUEUE, max_files_per_trigger=_two_batches(spark, append))
    try:
        run_foreach_batch(stream, fails_first, ckpt)
    except Exception as e:  # the failure above, wrapped by the stream
        if "lost after the writes" not in str(e):
            raise
    run_foreach_batch(stream, fails_first, ckpt)
    if ran[:2] != [0, 0]:
        raise AssertionError(f"the first batch was not replayed: {ran}")
    return _header_items(spark.read.parquet(sink))


def q_stream_consume_by_moving(spark: SparkSession, d: str) -> DataFrame:
    """Consumed files move to an archive: every message is seen once, and is
    kept once, in the queue or the archive."""
    from ..streaming.drain import drain

    log, sink, ckpt = _stream_dirs(spark, "stream_consume")
    moved = log.rsplit("/", 1)[0] + "/consumed"
    msgs = fx.order_plain_messages(spark, d)
    half = F.pmod("o_orderkey", F.lit(2))
    for seq in (0, 1):  # two appends, all orders
        write_queue(msgs.where(half == seq).drop("o_orderkey"), log, QMGR, QUEUE, "orders", seq)
        stream = read_queue_stream(spark, log, QMGR, QUEUE, max_files_per_trigger=2, clean_source="archive", source_archive_dir=moved)
        drain(_plain_value(stream), sink, ckpt)
    # the file source mirrors the queue's path below the archive
    left = read_queue(spark, log, QMGR, QUEUE).select("msg_id")
    if path_exists(spark, moved):
        left = left.union(spark.read.option("recursiveFileLookup", "true").schema(LOG_SCHEMA).parquet(moved).select("msg_id"))
    kept = left.groupBy(F.col("msg_id").cast("bigint").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n_kept"))
    seen = spark.read.parquet(sink).groupBy("o_orderkey", "value").agg(F.count(F.lit(1)).alias("n_seen"))
    return seen.join(kept, "o_orderkey", "full")


def q_stream_batch_writer(spark: SparkSession, d: str) -> DataFrame:
    """foreachBatch: archive + dead letters + good records, per batch id."""
    from ..streaming.drain import run_foreach_batch
    from ..streaming.writer import QueueBatchWriter

    log, sink, ckpt = _stream_dirs(spark, "stream_batch_writer")
    append = write_queue(fx.order_xml_messages(spark, d).drop("o_orderkey"), log, QMGR, QUEUE, "orders", 1)
    archive_dir = log.rsplit("/", 1)[0] + "/archive"
    opts = _base_opts(path=log, fileFormat="XML", split="item", headers="header", movePath=archive_dir)
    writer = QueueBatchWriter(opts, sink, producer="orders-reader")
    stream = read_queue_stream(spark, log, QMGR, QUEUE, max_files_per_trigger=_two_batches(spark, append))
    run_foreach_batch(stream, writer, ckpt)
    return _header_items(spark.read.parquet(sink))


def q_stream_assemble_segments(spark: SparkSession, d: str) -> DataFrame:
    from ..streaming.drain import drain
    from ..streaming.segments import assemble_segments_stream

    log, sink, ckpt = _stream_dirs(spark, "stream_segments")
    spark = stateful_session(spark, spark.sparkContext.defaultParallelism)
    segs = fx.segmented_document_messages(spark, d).drop("doc_id")
    append = write_queue(segs, log, QMGR, QUEUE, "docs", 1)
    stream = read_queue_stream(spark, log, QMGR, QUEUE, max_files_per_trigger=_two_batches(spark, append)).drop(
        "producer", "seq"
    )
    # no delay: what the two batches have not completed is given up as soon as
    # anything else arrives, here one message of another group
    out = assemble_segments_stream(stream, delay="0 seconds")
    out = out.select(F.col("group_id").try_cast("bigint").alias("doc_id"), _str("payload").alias("text"), "error")
    drain(out, sink, ckpt)
    later = segs.limit(1).select(F.lit("later").alias("msg_id"), F.lit("later").alias("group_id"), F.lit(0).alias("seg_offset"), F.lit(True).alias("last_segment"), "payload")
    write_queue(later, log, QMGR, QUEUE, "docs", 2)
    drain(out, sink, ckpt)
    return spark.read.parquet(sink).where("doc_id is not null")


def _group_rows(df: DataFrame, key: str = "conv_id") -> DataFrame:
    return df.select(F.col("group_id").try_cast("bigint").alias(key), "msg_seq", "last_in_group", _str("payload").alias("payload"), "error")


def q_message_groups(spark: SparkSession, d: str) -> DataFrame:
    """Conversations as groups of messages, every second one in segments, with
    gaps, repeats, lost last marks and segments, and messages that differ."""
    return _group_rows(complete_messages(fx.grouped_turn_messages(spark, d)))


def q_message_groups_orders(spark: SparkSession, d: str) -> DataFrame:
    """Orders as groups of their lines, with the tables' own gaps and clashes."""
    return _group_rows(complete_messages(fx.order_line_groups(spark, d)), "o_orderkey")


def q_stream_message_groups(spark: SparkSession, d: str) -> DataFrame:
    """The groups of whole messages over three appends: the last ones arrive late,
    and what they do not complete is given up once something else arrives."""
    from ..streaming.drain import drain
    from ..streaming.groups import release_groups_stream

    log, sink, ckpt = _stream_dirs(spark, "stream_groups")
    spark = stateful_session(spark, spark.sparkContext.defaultParallelism)
    msgs = fx.grouped_turn_messages(spark, d, segments=False)
    end = msgs.groupBy(F.col("group_id").alias("of")).agg(F.max("msg_seq").alias("end"))
    msgs = msgs.join(end, F.col("group_id") == F.col("of")).drop("of")
    late = F.col("msg_seq") == F.col("end")
    later = F.struct(F.lit("later").alias("msg_id"), F.lit("later").alias("group_id"), F.lit(1).alias("msg_seq"), F.lit(True).alias("last_in_group"), F.lit(b"").alias("payload"))
    appends = [msgs.where(~late).drop("end"), msgs.where(late).drop("end"), spark.range(1).select(later.alias("m")).select("m.*")]
    for seq, append in enumerate(appends):
        write_queue(append, log, QMGR, QUEUE, "turns", seq)
        stream = read_queue_stream(spark, log, QMGR, QUEUE, schema=GROUP_LOG_SCHEMA).drop("producer", "seq")
        drain(_group_rows(release_groups_stream(stream, delay="0 seconds")), sink, ckpt)
    return spark.read.parquet(sink).where("conv_id is not null")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "xml_revenue_by_status": q_xml_revenue_by_status,
    "xml_split": q_xml_split,
    "xml_header_enrich": q_xml_header_enrich,
    "xml_whole": q_xml_whole,
    "xml_split_pages": q_xml_split_pages,
    "xml_spans": q_xml_spans,
    "split_lines": q_split_lines,
    "split_lines_encoding": q_split_lines_encoding,
    "fixed_width_columns": q_fixed_width_columns,
    "json_whole": q_json_whole,
    "json_split": q_json_split,
    "json_split_scalars": q_json_split_scalars,
    "json_exact_numbers": q_json_exact_numbers,
    "json_lexemes": q_json_lexemes,
    "parse_malformed": q_parse_malformed,
    "split_dispatch": q_split_dispatch,
    "custom_splitter": q_custom_splitter,
    "custom_splitter_python": q_custom_splitter_python,
    "custom_splitter_udtf": q_custom_splitter_udtf,
    "custom_splitter_faults": q_custom_splitter_faults,
    "assemble_segments": q_assemble_segments,
    "report_correlation_value": q_report_correlation_value,
    "dead_letter_backout": q_dead_letter_backout,
    "dead_letter_error_queue": q_dead_letter_error_queue,
    "dead_letter_target": q_dead_letter_target,
    "ack_request": q_ack_request,
    "queue_roundtrip": q_queue_roundtrip,
    "parallel_scan": q_parallel_scan,
    "archive_fanout": q_archive_fanout,
    "archive_name": q_archive_name,
    "kafka_shape": q_kafka_shape,
    "file_messages": q_file_messages,
    "xml_file_records": q_xml_file_records,
    "stream_file_messages": q_stream_file_messages,
    "confirmations": q_confirmations,
    "stream_confirmations": q_stream_confirmations,
    "stream_queue_scan": q_stream_queue_scan,
    "stream_drain_available_now": q_stream_drain_available_now,
    "stream_mq_source": q_stream_mq_source,
    "stream_commit_replay": q_stream_commit_replay,
    "stream_consume_by_moving": q_stream_consume_by_moving,
    "stream_batch_writer": q_stream_batch_writer,
    "stream_assemble_segments": q_stream_assemble_segments,
    "message_groups": q_message_groups,
    "message_groups_orders": q_message_groups_orders,
    "stream_message_groups": q_stream_message_groups,
}
