"""Lock in the plan shapes the library relies on at scale."""

import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from conftest import SF_SMALL
from queuelake.functions.message import message_value
from queuelake.operators.splitters import split_json, split_lines, split_xml
from queuelake.plans import catalog
from queuelake.plans import fixtures as fx
from queuelake.sources.queue_log import read_queue, write_queue


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def _log(spark, tmp):
    write_queue(fx.order_xml_messages(spark, SF_SMALL).drop("o_orderkey"), tmp, "QM", "Q", "p", 1)
    return read_queue(spark, tmp, "QM", "Q")


def test_splitters_add_no_exchange_and_prune_columns(spark, tmp):
    log = _log(spark, tmp)
    for df in (
        split_xml(log.select("msg_id", "payload"), split="item", headers=["header"]),
        split_json(log.select("msg_id", "payload")),
        split_lines(log.select("msg_id", "payload")),
    ):
        p = plan(df)
        assert "Exchange" not in p
        assert "ReadSchema: struct<msg_id:string,payload:binary>" in p


def test_no_inferred_filter_recomputes_the_split(spark, tmp):
    log = _log(spark, tmp)
    p = plan(split_lines(log.select("msg_id", "payload")), "extended")
    optimized = p.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    for line in optimized.splitlines():
        if "Filter" in line:
            assert "split(" not in line and "regexp" not in line, line


def test_filters_and_projection_reach_the_queue_scan(spark, tmp):
    log = _log(spark, tmp)
    df = log.where((F.col("msg_type") == 4) & (F.col("seq") == 1)).select(message_value().alias("v"))
    p = plan(df)
    assert "PushedFilters: [IsNotNull(msg_type), EqualTo(msg_type,4)]" in p
    assert "PartitionFilters: [isnotnull(seq" in p
    assert "ReadSchema: struct<msg_type:int,correl_id:binary,payload:binary>" in p


def test_message_build_never_broadcasts_item_lists(spark):
    """Items are joined as rows; what is collected into lists is not joined
    again."""
    df = catalog.q_xml_revenue_by_status(spark, SF_SMALL)
    df.collect()
    above = plan(df).split("ObjectHashAggregate")[0]
    assert "BroadcastExchange" not in above and "HashJoin" not in above.split("Final Plan")[-1].split("ObjectHashAggregate")[0]


def test_failures_are_filtered_above_the_generator(spark, tmp):
    from queuelake.operators.routing import route_failures

    recs = split_xml(_log(spark, tmp).select("msg_id", "payload"), split="item")
    count = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all")
    for side in route_failures(recs, {"queue": "Q", "queueManager": "M"}):
        assert count(side) == count(recs)
