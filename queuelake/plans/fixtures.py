"""Message sets derived from the test tables (F1..F8).

Each builder reads the given tables and returns messages in the message
schema (plus the keys the checks need), so the work grows with the tables.
Builders that gather a group into one message (an order's items, a user's
events of a day) cut hot groups into bounded chunks first
(``operators.skew.chunk_hot_groups``): one message per group as long as the
group has at most ``max_items`` rows, several otherwise.
"""

from __future__ import annotations

import itertools
import os

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import chunk_hot_groups, ensure_parallelism, group_messages
from ..schema import MQMT_DATAGRAM, MQMT_REPORT, REPORT_CONFIRM_ON_ARRIVAL, REPORT_CONFIRM_ON_DELIVERY
from ..session import ship_package
from ..sources.fs import local_path
from ..streaming.confirmations import MQFB_COA, MQFB_COD

DEFAULT_MAX_ITEMS = 100_000
SEGMENT_CHARS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The projected columns of a table, over at least one task per core.

    A table stored as one file with one row group is read by a single task;
    ``ensure_parallelism`` spreads it before the per-row work.  A table in
    many files (the normal case at scale) is left alone: no shuffle.  Used
    for narrow builders only: grouped builders shuffle on their key anyway.
    """
    return ensure_parallelism(df)


def _s(c: str) -> Column:
    return F.col(c).cast("string")


def _tag(name: str, value: Column, pretty: bool, indent: str) -> Column:
    if pretty:
        return F.concat(F.lit(f"{indent}<{name}>"), value, F.lit(f"</{name}>\n"))
    return F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))


ITEM_FIELDS = ["l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag"]


def _message_id(key: Column, chunk: Column) -> Column:
    return F.when(chunk == 0, key.cast("string")).otherwise(F.concat_ws("-", key.cast("string"), chunk.cast("string")))


def order_xml_messages(
    spark: SparkSession,
    sf_dir: str,
    pretty: bool = False,
    max_items: int = DEFAULT_MAX_ITEMS,
) -> DataFrame:
    """one XML message per order (orders without lines included).

    ``<order><header><o_orderkey/><o_orderstatus/></header><item>..</item>..</order>``
    with items sorted as text; ``pretty`` puts every tag on its own line.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", *ITEM_FIELDS)
    ind = "    " if pretty else ""
    item = F.concat(
        F.lit("  <item>\n" if pretty else "<item>"),
        *[_tag(c, _s(c), pretty, ind) for c in ITEM_FIELDS],
        F.lit("  </item>\n" if pretty else "</item>"),
    )
    # the order's columns join its rows, not its messages: an equi-join that
    # Spark can split where a key is hot, and the chunks stay apart after it
    li = chunk_hot_groups(li, ["l_orderkey"], max_items)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    rows = orders.join(li, orders.o_orderkey == li.l_orderkey, "left").withColumn("chunk", F.coalesce("chunk", F.lit(0)))
    items = F.array_join(F.array_sort(F.collect_list(item)), "").alias("items")
    m = group_messages(rows, ["o_orderkey"], items, also=["o_orderstatus", "o_orderdate"])
    hind = "    " if pretty else ""
    header = F.concat(
        F.lit("  <header>\n" if pretty else "<header>"),
        _tag("o_orderkey", _s("o_orderkey"), pretty, hind),
        _tag("o_orderstatus", F.col("o_orderstatus"), pretty, hind),
        F.lit("  </header>\n" if pretty else "</header>"),
    )
    payload = F.concat(
        F.lit("<order>\n" if pretty else "<order>"),
        header,
        F.col("items"),
        F.lit("</order>\n" if pretty else "</order>"),
    )
    return m.select(
        _message_id(F.col("o_orderkey"), F.col("chunk")).alias("msg_id"),
        F.lit(MQMT_DATAGRAM).alias("msg_type"),
        F.col("o_orderdate").alias("put_ts"),
        payload.cast("binary").alias("payload"),
        "o_orderkey",
    )


LINE_JSON_FIELDS = [
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
]


def order_json_messages(
    spark: SparkSession,
    sf_dir: str,
    first_key: str = "items",
    max_items: int = DEFAULT_MAX_ITEMS,
) -> DataFrame:
    """``{"items":[{lineitem columns},..],"o_orderkey":k}`` per order with
    lines; ``first_key="o_orderkey"`` puts the key first (must be rejected
    by ``split_json(split="items")``)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_JSON_FIELDS)
    li = li.withColumn("l_shipdate", F.to_date("l_shipdate"))
    li = chunk_hot_groups(li, ["l_orderkey"], max_items)
    elem = F.to_json(F.struct(*LINE_JSON_FIELDS))
    per = group_messages(li, ["l_orderkey"], F.array_join(F.array_sort(F.collect_list(elem)), ",").alias("items"))
    items = F.concat(F.lit('"items":['), F.col("items"), F.lit("]"))
    key = F.concat(F.lit('"o_orderkey":'), _s("l_orderkey"))
    body = F.concat(items, F.lit(","), key) if first_key == "items" else F.concat(key, F.lit(","), items)
    return per.select(
        _message_id(F.col("l_orderkey"), F.col("chunk")).alias("msg_id"),
        F.concat(F.lit("{"), body, F.lit("}")).cast("binary").alias("payload"),
        F.col("l_orderkey").alias("o_orderkey"),
    )


# Fixed-width layout of event lines: (name, 1-based start, length, type).
EVENT_LAYOUT = [("event_id", 1, 20, "bigint"), ("event_type", 21, 16, "string"), ("value", 37, 24, "double")]


def event_line_messages(spark: SparkSession, sf_dir: str, max_items: int = DEFAULT_MAX_ITEMS) -> DataFrame:
    """per (user_id, day) one message of fixed-width event lines joined by
    ``\\n``: event_id (20, right-aligned), event_type (16, left-aligned),
    value (24, right-aligned, shortest exact decimal text of the double)."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", F.to_date("ts").alias("day"), "event_type", "value")
    line = F.concat(
        F.lpad(_s("event_id"), 20, " "),
        F.rpad(F.col("event_type"), 16, " "),
        F.lpad(_s("value"), 24, " "),
    )
    ev = chunk_hot_groups(ev, ["user_id", "day"], max_items)
    per = group_messages(ev, ["user_id", "day"], F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("text"))
    return per.select(
        F.concat_ws(":", _s("user_id"), F.date_format("day", "yyyyMMdd"), _s("chunk")).alias("msg_id"),
        F.col("text").cast("binary").alias("payload"),
        "user_id",
        "day",
    )


def event_props_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one JSON message per event: ``props`` as is."""
    ev = spread(table(spark, sf_dir, "events").select("event_id", "ts", "props"))
    return ev.select(
        _s("event_id").alias("msg_id"),
        F.col("ts").alias("put_ts"),
        F.col("props").cast("binary").alias("payload"),
        "event_id",
    )


def document_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one message per document, its text as UTF-8."""
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select(_s("doc_id").alias("msg_id"), F.col("text").cast("binary").alias("payload"), "doc_id")


def is_latin1(text: Column) -> Column:
    return ~text.rlike("[^\\x{00}-\\x{FF}]")


def conversation_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 input: one message per conversation turn, in ISO-8859-1 where the text
    fits and else in UTF-16BE (``charset``)."""
    c = spread(table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"))
    fits = is_latin1(F.col("text"))
    return c.select(
        F.concat_ws(":", _s("conv_id"), _s("turn")).alias("msg_id"),
        F.when(fits, F.encode("text", "ISO-8859-1")).otherwise(F.encode("text", "UTF-16BE")).alias("payload"),
        F.when(fits, "ISO-8859-1").otherwise("UTF-16BE").alias("charset"),
        "conv_id",
        "turn",
    )


def order_exact_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``{"vals":[<23-digit decimal>, {"x":<the same>}]}`` per order."""
    o = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"))
    number = F.concat((F.lit(10_000_000_000) + F.col("o_orderkey")).cast("string"), F.lit("."), F.lpad(_s("o_custkey"), 12, "0"))
    doc = F.concat(F.lit('{"vals":['), number, F.lit(',{"x":'), number, F.lit("}]}"))
    return o.select(_s("o_orderkey").alias("msg_id"), doc.cast("binary").alias("payload"), "o_orderkey")


def broken_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per order in three formats; where ``o_orderkey % 97 = 0`` they are
    cut or hold a number that is none."""
    o = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"))
    bad = F.pmod(F.col("o_orderkey"), F.lit(97)) == 0
    js = F.concat(F.lit('{"c":'), _s("o_custkey"), F.when(bad, F.lit("")).otherwise(F.lit("}")))
    xml = F.concat(F.lit("<o><c>"), _s("o_custkey"), F.when(bad, F.lit("</c>")).otherwise(F.lit("</c></o>")))
    fixed = F.concat(F.lpad(_s("o_orderkey"), 20, " "), F.when(bad, F.lit("  x7")).otherwise(F.lpad(_s("o_custkey"), 20, " ")))
    return o.select("o_orderkey", js.cast("binary").alias("json"), xml.cast("binary").alias("xml"), fixed.cast("binary").alias("fixed"))


def segmented_document_messages(spark: SparkSession, sf_dir: str, drop_last_mod: int = 10) -> DataFrame:
    """every document cut into 1,024-character segments.

    ``seg_offset`` is the byte offset of the segment in the UTF-8 text,
    ``last_segment`` marks the final one.  Where ``doc_id % drop_last_mod = 0``
    the final segment is withheld (of a document of one segment its mark), so
    those groups never complete.
    """
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n = F.ceil(F.char_length("text") / F.lit(SEGMENT_CHARS)).cast("int")
    idx = F.sequence(F.lit(0), n - 1)
    segs = F.transform(idx, lambda i: F.substring(F.col("text"), i * SEGMENT_CHARS + 1, SEGMENT_CHARS))
    staged = d.select("doc_id", n.alias("n"), F.when(n > 0, segs).otherwise(F.array().cast("array<string>")).alias("segs"))
    lens = F.transform(F.col("segs"), lambda s: F.octet_length(s))
    # byte offset of segment i = bytes of segments 0..i-1
    offs = F.transform(
        F.col("segs"), lambda _seg, i: F.aggregate(F.slice(lens, F.lit(1), i), F.lit(0), lambda a, x: a + x)
    )
    staged = staged.select("doc_id", "n", "segs", offs.alias("offs"))
    # outer + filter: keeps the optimizer from re-evaluating ``segs`` in an
    # inferred ``size(segs) > 0`` filter below this projection
    ex = staged.select("doc_id", "n", "offs", F.posexplode_outer("segs").alias("i", "seg")).where(
        F.col("i").isNotNull()
    )
    last = F.col("i") == F.col("n") - 1
    broken = F.pmod(F.col("doc_id"), F.lit(drop_last_mod)) == 0
    withheld = last & broken & (F.col("n") > 1)
    return ex.where(~withheld).select(
        F.concat_ws("-", _s("doc_id"), _s("i")).alias("msg_id"),
        F.lit(MQMT_DATAGRAM).alias("msg_type"),
        _s("doc_id").alias("group_id"),
        F.get(F.col("offs"), F.col("i")).alias("seg_offset"),
        (last & ~broken).alias("last_segment"),
        F.col("seg").cast("binary").alias("payload"),
        "doc_id",
    )


def grouped_turn_messages(spark: SparkSession, sf_dir: str, segments: bool = True) -> DataFrame:
    """Conversations as message groups: turn t is message t + 1, the last turn
    carries the last mark.  With ``segments`` every second message is cut into
    two segments.

    Faults, by ``conv_id``: where 11 divides it message 2 is withheld, 13 the
    last mark, 17 a second message 1 differs, 7 message 1 comes twice, 19 message
    2 lacks its second segment.
    """
    c = spread(table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"))
    ends = c.groupBy(F.col("conv_id").alias("of")).agg(F.max("turn").alias("end"))
    c = c.join(ends, F.col("conv_id") == F.col("of"))
    no = (F.col("turn") + 1).cast("int")

    def every(n: int) -> Column:
        return F.pmod("conv_id", F.lit(n)) == 0

    first = no == 1
    copies = F.concat(
        F.array(F.struct(F.lit("").alias("mark"), F.col("text").alias("text"))),
        F.when(first & every(7), F.array(F.struct(F.lit("again").alias("mark"), F.col("text").alias("text")))).otherwise(F.array()),
        F.when(first & every(17), F.array(F.struct(F.lit("other").alias("mark"), F.concat("text", F.lit("!")).alias("text")))).otherwise(F.array()),
    )
    m = c.where(~(every(11) & (no == 2))).select("conv_id", no.alias("msg_seq"), ((F.col("turn") == F.col("end")) & ~every(13)).alias("last_in_group"), F.inline(copies))
    cut = (F.length("text") >= 2) & (F.pmod("msg_seq", F.lit(2)) == 0) if segments else F.lit(False)
    half = F.floor(F.length("text") / 2).cast("int")
    head, tail = F.substr("text", F.lit(1), half), F.substr("text", half + 1)
    part = "struct<at: int, last: boolean, text: string>"
    parts = F.when(
        cut,
        F.concat(
            F.array(F.struct(F.lit(0), F.lit(False), head).cast(part)),
            F.when(every(19) & (F.col("msg_seq") == 2), F.array().cast(f"array<{part}>")).otherwise(F.array(F.struct(F.octet_length(head), F.lit(True), tail).cast(part))),
        ),
    ).otherwise(F.array(F.struct(F.lit(None), F.lit(None), F.col("text")).cast(part)))
    m = m.select("conv_id", "msg_seq", "last_in_group", "mark", F.inline(parts).alias("at", "last", "part"))
    return m.select(
        F.concat_ws("-", "conv_id", "msg_seq", "mark", "at").alias("msg_id"),
        F.lit(MQMT_DATAGRAM).alias("msg_type"),
        _s("conv_id").alias("group_id"),
        F.col("at").alias("seg_offset"),
        F.col("last").alias("last_segment"),
        F.col("part").cast("binary").alias("payload"),
        "msg_seq",
        "last_in_group",
    )


def order_line_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as message groups, as they come: a message per line, numbered by
    ``l_linenumber``; the greatest number carries the last mark.  The tables
    leave numbers out and give several lines one number."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    ends = li.groupBy(F.col("l_orderkey").alias("of")).agg(F.max("l_linenumber").alias("end"))
    li = li.join(ends, F.col("l_orderkey") == F.col("of"))
    return li.select(
        _s("l_orderkey").alias("group_id"),
        F.col("l_linenumber").cast("int").alias("msg_seq"),
        (F.col("l_linenumber") == F.col("end")).alias("last_in_group"),
        F.concat_ws("|", "l_partkey", "l_quantity").cast("binary").alias("payload"),
    )


def truncated_order_messages(spark: SparkSession, sf_dir: str, mod: int = 97, cut: int = 20) -> DataFrame:
    """F1 where the final ``cut`` bytes are lost for ``o_orderkey % mod = 0``."""
    f1 = order_xml_messages(spark, sf_dir)
    bad = F.pmod(F.col("o_orderkey"), F.lit(mod)) == 0
    p = F.col("payload")
    return f1.withColumn(
        "payload", F.when(bad, F.substring(p, 1, F.greatest(F.octet_length(p) - cut, F.lit(0)))).otherwise(p)
    )


def order_line_payload() -> Column:
    """A plain text payload for an order: key|customer|status|priority."""
    return F.concat_ws("|", _s("o_orderkey"), _s("o_custkey"), F.col("o_orderstatus"), F.col("o_orderpriority"))


def order_report_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: orders as messages; status 'P' ones are report messages whose
    correlation id is the order key."""
    o = spread(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    )
    report = F.col("o_orderstatus") == "P"
    return o.select(
        _s("o_orderkey").alias("msg_id"),
        F.when(report, F.lit(MQMT_REPORT)).otherwise(F.lit(MQMT_DATAGRAM)).alias("msg_type"),
        F.when(report, _s("o_orderkey").cast("binary")).alias("correl_id"),
        F.col("o_orderdate").alias("put_ts"),
        order_line_payload().cast("binary").alias("payload"),
        "o_orderkey",
    )


def order_plain_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One datagram per order with the plain text payload."""
    o = spread(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    )
    return o.select(
        _s("o_orderkey").alias("msg_id"),
        F.lit(MQMT_DATAGRAM).alias("msg_type"),
        F.col("o_orderdate").alias("put_ts"),
        order_line_payload().cast("binary").alias("payload"),
        "o_orderkey",
    )


def part_json_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P6 input: ``{"vals":[<p_name>, <p_size>, null, {"brand": <p_brand>}]}`` per part."""
    p = spread(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_brand"))
    name_json = F.regexp_extract(F.to_json(F.array("p_name")), "^\\[(.*)\\]$", 1)
    doc = F.concat(
        F.lit('{"vals":['),
        name_json,
        F.lit(","),
        _s("p_size"),
        F.lit(",null,"),
        F.to_json(F.struct(F.col("p_brand").alias("brand"))),
        F.lit("]}"),
    )
    return p.select(_s("p_partkey").alias("msg_id"), doc.cast("binary").alias("payload"), "p_partkey")


def _write_local_files(rows: DataFrame, key: str, folder: str) -> None:
    """What ``partitionBy(key).text`` writes to a disk, as text lines of the other
    column: a file per key and task, in a folder per key.

    Hadoop's local file system without its native library starts a process for
    the mode of every folder, file and checksum; Python's calls start none.
    """
    ship_package(rows.sparkSession)
    os.makedirs(folder)

    def run(batches):
        import pyarrow as pa

        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}.txt"
        pairs = (p for b in batches for p in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        n = 0
        for k, lines in itertools.groupby(pairs, key=lambda p: p[0]):
            at = f"{folder}/{key}={'__HIVE_DEFAULT_PARTITION__' if k is None else k}"
            try:
                os.mkdir(at)
            except FileExistsError:  # of an earlier attempt
                pass
            # whole once it has its name, whatever attempts of the task there are
            staged = f"{at}/.{name}-{task.taskAttemptId()}"
            with open(staged, "wb") as f:
                f.writelines((v or b"") + b"\n" for _, v in lines)
            os.replace(staged, f"{at}/{name}")
            n += 1
        yield pa.RecordBatch.from_pydict({"n": [n]})

    value = next(c for c in rows.columns if c != key)
    rows.sortWithinPartitions(key).select(key, F.col(value).cast("binary")).mapInArrow(run, "n long").write.format("noop").mode("overwrite").save()


def write_supplier_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    """A text file per supplier below ``path``: its name, ``s_suppkey % 50`` times.

    A file costs the same whatever it holds: the number of tasks is given, or
    Spark would see few bytes and have one task write every file.
    """
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.repeat("s_name", (F.col("s_suppkey") % 50).cast("int")).alias("value"))
    s = s.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "s_suppkey")
    folder = local_path(spark, path)
    if folder is None:
        s.write.partitionBy("s_suppkey").text(path)
    else:
        _write_local_files(s, "s_suppkey", folder)


def part_lexeme_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON as people write it, per part: white space, numbers that no double
    keeps, strings that look like containers.  Where 5 divides ``p_partkey`` the
    quotes are single ones, where 7 does the bracket is not closed."""
    p = spread(table(spark, sf_dir, "part").select("p_partkey", "p_size"))
    key, size = _s("p_partkey"), _s("p_size")
    good = F.concat(
        F.lit('{ "vals" : [ "{'), key, F.lit('}" , "[1", '), size, F.lit('.50,\n 1e'), size, F.lit('00, "a \\" ],'), key, F.lit('" , { "k" : [ 0.10, "' ), size, F.lit('}" ] } ] , "z" : [] }'),
    )
    single = F.concat(F.lit("{'vals':["), key, F.lit("]}"))
    doc = F.when(F.col("p_partkey") % 5 == 0, single).when(F.col("p_partkey") % 7 == 0, F.concat(F.lit('{"vals":['), key, F.lit("}"))).otherwise(good)
    return p.select(key.alias("msg_id"), doc.cast("binary").alias("payload"), "p_partkey")


def part_faulty_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P11 faults: the words of a part's name as a JSON array.  Where 5 divides
    ``p_partkey`` the payload is null, where 7 does it is no array, where 11 does
    a null is among the words."""
    p = spread(table(spark, sf_dir, "part").select("p_partkey", "p_name"))
    words = F.split("p_name", " ")
    k = F.col("p_partkey")
    doc = F.when(k % 5 == 0, F.lit(None)).when(k % 7 == 0, F.lit("oops")).when(k % 11 == 0, F.lit('["a",null]')).otherwise(F.to_json(words))
    return p.select(_s("p_partkey").alias("msg_id"), doc.cast("binary").alias("payload"), "p_partkey")


def part_name_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P11 input: one message per part, its name."""
    p = spread(table(spark, sf_dir, "part").select("p_partkey", "p_name"))
    return p.select(_s("p_partkey").alias("msg_id"), F.col("p_name").cast("binary").alias("payload"), "p_partkey")


def page_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per web page, its HTML as UTF-8."""
    p = spread(table(spark, sf_dir, "pages").select("page_id", "html"))
    return p.select(_s("page_id").alias("msg_id"), F.col("html").cast("binary").alias("payload"), "page_id")


def document_span_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One XML message per document: a line with its text in CDATA, beside lines
    inside of a comment, an instruction and the CDATA itself; the comment of every
    11th document never ends."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    text = F.replace(F.coalesce("text", F.lit("")), F.lit("]]>"), F.lit("]] >"))
    payload = F.concat(
        F.lit("<d><!-- <line>"), F.col("lang"), F.when(F.col("doc_id") % 11 == 0, F.lit("</line>")).otherwise(F.lit("</line> -->")),
        F.lit("<line n='1'><![CDATA[<line>"), text, F.lit("</line>]]></line><?draft <line>"), _s("doc_id"),
        F.lit("?><line>"), _s("doc_id"), F.lit("</line></d>"),
    )
    return spread(d).select(_s("doc_id").alias("msg_id"), payload.cast("binary").alias("payload"), "doc_id")


def write_nation_documents(spark: SparkSession, sf_dir: str, path: str) -> None:
    """One XML document per nation, a file each: a header with its key, then its
    customers; the header of every fifth nation is missing."""
    c = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", "c_acctbal")
    item = F.concat(F.lit("  <customer>\n    <key>"), _s("c_custkey"), F.lit("</key>\n  </customer>"))
    rows = c.select("c_nationkey", F.lit(1).alias("part"), F.col("c_custkey").alias("k"), item.alias("value"))
    n = c.select("c_nationkey").distinct()
    nation = _s("c_nationkey")
    head = F.when(F.col("c_nationkey") % 5 == 0, F.lit("<nation>")).otherwise(F.concat(F.lit("<nation>\n<header>\n  <nation>"), nation, F.lit("</nation>\n</header>")))
    ends = [n.select("c_nationkey", F.lit(part).alias("part"), F.lit(None).cast("long").alias("k"), v.alias("value")) for part, v in ((0, head), (2, F.lit("</nation>")))]
    docs = rows.unionByName(ends[0]).unionByName(ends[1]).repartition("c_nationkey").sortWithinPartitions("c_nationkey", "part", "k")
    docs.select("c_nationkey", "value").write.partitionBy("c_nationkey").mode("overwrite").text(path)


def order_letters_and_reports(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A dead letter per order that asks for both reports, and the reports: arrival
    a day later for two orders in three, delivery 0 to 9 days later for three in
    four; those of every second order come twice."""
    o = spread(table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").cast("timestamp_ntz").alias("d")))
    key = F.col("o_orderkey")
    dead = o.select(_s("o_orderkey").alias("msg_id"), F.col("d").alias("put_ts"), F.array(F.lit(REPORT_CONFIRM_ON_ARRIVAL), F.lit(REPORT_CONFIRM_ON_DELIVERY)).alias("report"))
    later = lambda days: F.col("d") + F.make_dt_interval(days.cast("int"))
    kinds = [(MQFB_COA, key % 3 != 0, F.lit(1)), (MQFB_COD, key % 4 != 1, key % 10)]
    sent = F.array(*[F.when(came, F.struct(F.lit(code).alias("feedback"), later(days).alias("put_ts"))) for code, came, days in kinds])
    copies = F.explode(F.sequence(F.lit(0), (1 - key % 2).cast("int")))
    reports = o.select(key, F.explode(F.array_compact(sent)).alias("r")).select(key, "r", copies.alias("copy")).select(
        F.concat_ws("-", key, "r.feedback").alias("msg_id"), F.lit(MQMT_REPORT).alias("msg_type"), key.cast("string").cast("binary").alias("correl_id"),
        "r.feedback", "r.put_ts",
    )
    return dead, reports


# Fixed-width layout of order item lines: (name, 1-based start, length, type).
ITEM_LINE_LAYOUT = [("l_linenumber", 1, 10, "int"), ("l_quantity", 11, 24, "double")]


def order_fixed_width_messages(
    spark: SparkSession, sf_dir: str, max_items: int = DEFAULT_MAX_ITEMS
) -> DataFrame:
    """Per order one message of fixed-width item lines (``ITEM_LINE_LAYOUT``)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    line = F.concat(F.lpad(_s("l_linenumber"), 10, " "), F.lpad(_s("l_quantity"), 24, " "))
    li = chunk_hot_groups(li, ["l_orderkey"], max_items)
    per = group_messages(li, ["l_orderkey"], F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("text"))
    return per.select(
        _message_id(F.col("l_orderkey"), F.col("chunk")).alias("msg_id"),
        F.col("text").cast("binary").alias("payload"),
        F.col("l_orderkey").alias("o_orderkey"),
    )
