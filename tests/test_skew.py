"""Hot groups are cut into bounded messages; nothing is lost or duplicated."""

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from queuelake.operators.skew import chunk_hot_groups, ensure_parallelism, group_messages
from queuelake.operators.splitters import split_xml
from queuelake.plans import catalog
from queuelake.plans import fixtures as fx


def _items(df):
    return sorted(
        (r.o_orderkey, r.l_linenumber, r.l_quantity, r.l_extendedprice, r.l_returnflag) for r in df.collect()
    )


def _lineitem():
    con = duckdb.connect()
    return sorted(
        con.execute(
            f"SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag "
            f"FROM read_parquet('{SF_SMALL}/lineitem.parquet')"
        ).fetchall()
    )


def test_hot_orders_split_into_bounded_messages(spark):
    max_items = 3
    msgs = fx.order_xml_messages(spark, SF_SMALL, max_items=max_items)
    recs = split_xml(msgs, split="item", headers=["header"])
    per_msg = recs.groupBy("msg_id").count().agg(F.max("count")).collect()[0][0]
    # chunks are hash-assigned: about max_items each, never the whole order
    biggest = duckdb.sql(
        f"SELECT max(c) FROM (SELECT count(*) c FROM read_parquet('{SF_SMALL}/lineitem.parquet') GROUP BY l_orderkey)"
    ).fetchall()[0][0]
    assert per_msg < biggest
    assert recs.where(F.col("msg_id").contains("-")).count() > 0  # some orders were cut
    assert _items(catalog.header_enriched_items(msgs).drop("o_orderstatus")) == _lineitem()


def test_equal_rows_part(spark):
    same = spark.createDataFrame([(1, "x")] * 1000 + [(2, "y")], "k int, v string")
    sizes = sorted(r["count"] for r in chunk_hot_groups(same, ["k"], 100).groupBy("k", "chunk").count().collect())
    assert sum(sizes) == 1001 and len(sizes) == 11 and sizes[-1] < 160
    with pytest.raises(ValueError):
        chunk_hot_groups(same, ["k"], 0)


def test_no_hot_groups_stay_whole(spark):
    li = fx.table(spark, SF_SMALL, "lineitem")
    out = chunk_hot_groups(li, ["l_orderkey"], 1_000)
    assert out.select(F.max("chunk")).collect()[0][0] == 0 and out.count() == li.count()


def test_chunks_stay_apart_and_building_runs_no_job(spark):
    """No exchange on the bare key after the chunks are made, and no job but the
    schema reads of the two tables while the messages are defined."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "build")
    msgs = fx.order_xml_messages(spark, SF_SMALL, max_items=2)
    assert len(tracker.getJobIdsForGroup("build")) <= 2
    spark.sparkContext.setJobGroup("other", "other")
    plan = msgs._jdf.queryExecution().executedPlan().toString()
    lines = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert "chunk" in lines[0]  # the outermost: nothing brings a key's chunks together again
    assert group_messages


def test_ensure_parallelism_only_spreads_small_inputs(spark):
    one = spark.range(100).coalesce(1)
    assert ensure_parallelism(one, 4).rdd.getNumPartitions() == 4
    many = spark.range(100).repartition(6)
    assert ensure_parallelism(many, 4) is many


def test_hot_groups_in_json_and_fixed_width_builders(spark):
    from queuelake.functions.parse import fixed_width_columns, json_struct
    from queuelake.operators.splitters import split_json, split_lines

    js = split_json(fx.order_json_messages(spark, SF_SMALL, max_items=3), split="items")
    got = sorted(
        (r.o_orderkey, r.l_linenumber, r.l_quantity)
        for r in js.select("o_orderkey", json_struct("value", catalog.LINE_JSON_SCHEMA, corrupt=None).alias("j"))
        .select("o_orderkey", "j.l_linenumber", "j.l_quantity")
        .collect()
    )
    con = duckdb.connect()
    want = sorted(
        con.execute(f"SELECT l_orderkey, l_linenumber, l_quantity FROM read_parquet('{SF_SMALL}/lineitem.parquet')").fetchall()
    )
    assert got == want
    ev = split_lines(fx.event_line_messages(spark, SF_SMALL, max_items=2))
    got_ev = sorted(tuple(r) for r in ev.select(*fixed_width_columns("value", fx.EVENT_LAYOUT)).collect())
    want_ev = sorted(
        con.execute(f"SELECT event_id, event_type, value FROM read_parquet('{SF_SMALL}/events.parquet')").fetchall()
    )
    assert got_ev == want_ev


def test_json_messages_with_another_first_key_are_rejected(spark):
    from queuelake.operators.splitters import split_json

    msgs = fx.order_json_messages(spark, SF_SMALL, first_key="o_orderkey")
    out = split_json(msgs, split="items")
    errors = {r.error for r in out.select("error").distinct().collect()}
    assert errors == {"SPLIT_KEY_NOT_FIRST"}
    assert out.count() == msgs.count()  # one dead-letter row per message, nothing lost
