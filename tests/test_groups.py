"""Message groups in batch and on a stream; the state of collected parts."""

import random

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from queuelake.operators.groups import complete_messages, in_group_order, release_groups
from queuelake.plans import fixtures as fx
from queuelake.schema import GROUP_LOG_SCHEMA
from queuelake.session import stateful_session
from queuelake.sources.queue_log import read_queue_stream, write_queue
from queuelake.streaming.drain import drain
from queuelake.streaming.groups import release_groups_stream
from queuelake.streaming.parts import PartCollector
from queuelake.streaming.segments import Segments, assemble_segments_stream

SCHEMA = "msg_id string, group_id string, msg_seq int, last_in_group boolean, payload binary, seg_offset int, last_segment boolean"


def frame(spark, rows):
    return spark.createDataFrame([(*r, None, None) if len(r) == 5 else r for r in rows], SCHEMA)


def got(df):
    return sorted(((r.group_id, r.msg_seq, r.payload and bytes(r.payload), r.error) for r in df.collect()), key=str)


CASES = [
    ("a1", "whole", 1, False, b"1"),
    ("a2", "whole", 2, False, None),
    ("a3", "whole", 3, True, b"3"),
    ("a1", "whole", 1, False, b"1"),  # again
    ("b1", "gap", 1, False, b"1"),
    ("b3", "gap", 3, True, b"3"),
    ("c1", "no last", 1, False, b"1"),
    ("d1", "two lasts", 1, True, b"1"),
    ("d2", "two lasts", 2, True, b"2"),
    ("e0", "from 0", 0, True, b"0"),
    ("f1", "differs", 1, True, b"1"),
    ("f1", "differs", 1, True, b"one"),
    ("g2", "no first", 2, True, b"2"),
    ("h", None, 1, True, b"no group"),
    ("i", "no number", None, None, b"passes"),
    ("j", "alone", 1, True, b""),
    ("k1", "early last", 1, True, b"1"),
    ("k2", "early last", 2, False, b"2"),
]


def test_groups_are_whole_or_error_rows(spark):
    out = got(release_groups(frame(spark, CASES)))
    bad = "INCOMPLETE_MESSAGE_GROUP"
    want = [
        ("whole", 1, b"1", None), ("whole", 2, None, None), ("whole", 3, b"3", None), ("gap", 1, b"1", bad), ("gap", 3, b"3", bad),
        ("no last", 1, b"1", bad), ("two lasts", 1, b"1", bad), ("two lasts", 2, b"2", bad), ("from 0", 0, b"0", bad),
        ("differs", 1, b"1", "CONFLICTING_MESSAGES"), ("differs", 1, b"one", "CONFLICTING_MESSAGES"), ("no first", 2, b"2", bad),
        (None, 1, b"no group", None), ("no number", None, b"passes", None), ("alone", 1, b"", None),
        ("early last", 1, b"1", bad), ("early last", 2, b"2", bad),
    ]
    assert out == sorted(want, key=str)
    assert release_groups(frame(spark, CASES).limit(0)).count() == 0
    assert "msg_seq" in release_groups(frame(spark, CASES).drop("msg_seq", "last_in_group")).columns


def test_segments_of_grouped_messages(spark):
    rows = [
        ("a1x", "A", 1, False, b"he", 0, False), ("a1y", "A", 1, False, b"llo", 2, True), ("a2", "A", 2, True, b"!", None, None),
        ("b1x", "B", 1, False, b"he", 0, False), ("b2", "B", 2, True, b"!", None, None),
        ("c", None, None, None, b"plain", None, None), ("dx", "D", None, None, b"se", 0, False), ("dy", "D", None, None, b"g", 2, True),
    ]
    assert got(complete_messages(frame(spark, rows))) == sorted(
        [
            ("A", 1, b"hello", None), ("A", 2, b"!", None), ("B", 1, b"he", "INCOMPLETE_GROUP"), ("B", 2, b"!", "INCOMPLETE_MESSAGE_GROUP"),
            (None, None, b"plain", None), ("D", None, b"seg", None),
        ],
        key=str,
    )


def test_a_hot_group_is_not_gathered_and_keeps_its_order(spark):
    hot = spark.range(20_000).select(
        F.lit("hot").alias("group_id"), (F.col("id") + 1).cast("int").alias("msg_seq"), (F.col("id") == 19_999).alias("last_in_group"), F.col("id").cast("string").cast("binary").alias("payload")
    )
    out = in_group_order(release_groups(hot.unionByName(frame(spark, CASES).select(*hot.columns))))
    parts = out.select("group_id", "msg_seq", "error", F.spark_partition_id().alias("part")).collect()
    rows = [r for r in parts if r.group_id == "hot"]
    assert [r.msg_seq for r in sorted(rows, key=lambda r: r.part)] == list(range(1, 20_001))
    assert not any(r.error for r in rows)


def stream(spark, log, delay="0 seconds"):
    s = stateful_session(spark, 2)
    return release_groups_stream(read_queue_stream(s, log, "QM", "Q", schema=GROUP_LOG_SCHEMA).drop("producer", "seq"), delay)


def test_stream_gives_what_the_batch_gives(spark, tmp):
    """Any order of arrival over four micro-batches, repeats among them."""
    rng = random.Random(3)
    # what a stream can not know yet: a last mark that is not the last, a whole group's repeat
    rows = [r for r in dict.fromkeys(CASES) if r[1] and r[1] not in ("two lasts", "differs", "early last")]
    for g in range(12):
        n = rng.randint(1, 6)
        rows += [(f"{g}-{k}", f"g{g}", k, k == n, f"{g}/{k}".encode()) for k in range(1, n + 1) if rng.random() < 0.95]
    rows += rng.sample([r for r in rows if r[1] in ("gap", "no last", "no number", "from 0")], 3)
    log, sink, ckpt = f"{tmp}/log", f"{tmp}/sink", f"{tmp}/ckpt"
    want = got(release_groups(frame(spark, rows)))
    # a whole group is released with its last missing message, so nothing of it may come later
    order = sorted(rows, key=lambda r: rng.random())
    seen: dict = {}
    for seq in range(3):
        write_queue(frame(spark, order[seq::3]), log, "QM", "Q", "p", seq)
        # the groups wait for an hour
        drain(stream(spark, log, "1 hour").select("group_id", "msg_seq", "payload", "error"), sink, ckpt)
        done = spark.read.parquet(sink).where("error is null and group_id is not null and msg_seq is not null").groupBy("group_id").count().collect()
        assert all(seen.get(r.group_id, r["count"]) == r["count"] for r in done)
        seen |= {r.group_id: r["count"] for r in done}
    whole = [r for r in want if r[3] is None]
    assert [r for r in got(spark.read.parquet(sink)) if r[3] is None] == whole


def test_stream_gives_up_what_is_late(spark, tmp):
    log, sink, ckpt = f"{tmp}/log", f"{tmp}/sink", f"{tmp}/ckpt"
    run = lambda: drain(stream(spark, log).select("group_id", "msg_seq", "payload", "error"), sink, ckpt)
    write_queue(frame(spark, [("a1", "A", 1, False, b"1"), ("b1", "B", 1, False, b"1")]), log, "QM", "Q", "p", 0)
    run()
    assert spark.read.parquet(sink).count() == 0  # nothing later has arrived
    write_queue(frame(spark, [("a2", "A", 2, True, b"2")]), log, "QM", "Q", "p", 1)
    run()
    assert got(spark.read.parquet(sink)) == [("A", 1, b"1", None), ("A", 2, b"2", None), ("B", 1, b"1", "INCOMPLETE_MESSAGE_GROUP")]


def test_what_differs_comes_out_once_whatever_comes_first(spark, tmp):
    log, sink, ckpt = f"{tmp}/log", f"{tmp}/sink", f"{tmp}/ckpt"
    one, other = ("a1", "A", 1, False, b"1"), ("a1", "A", 1, False, b"one")
    for seq, rows in enumerate([[one], [other], [one, other, other], [("z1", "Z", 1, True, b"z")]]):
        write_queue(frame(spark, rows), log, "QM", "Q", "p", seq)
        drain(stream(spark, log).select("group_id", "msg_seq", "payload", "error"), sink, ckpt) if seq > 1 else None
    clash = "CONFLICTING_MESSAGES"
    assert got(spark.read.parquet(sink).where("group_id = 'A'")) == [("A", 1, b"1", clash), ("A", 1, b"one", clash)]


def test_state_needs_rocksdb_and_leaves_the_session_alone(spark, tmp):
    write_queue(frame(spark, CASES[:3]), f"{tmp}/log", "QM", "Q", "p", 0)
    plain = read_queue_stream(spark, f"{tmp}/log", "QM", "Q", schema=GROUP_LOG_SCHEMA)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    with pytest.raises(ValueError, match="providerClass"):
        release_groups_stream(plain)
    stateful_session(spark)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def written_bytes(spark, base, parts, size):
    """Bytes of state changes of one message whose segments come one micro-batch each."""
    log = f"{base}/log"
    for k in range(parts):
        seg = [("s", "G", k * size, k == parts - 1, bytes([k % 251]) * size)]
        write_queue(spark.createDataFrame(seg, "msg_id string, group_id string, seg_offset int, last_segment boolean, payload binary"), log, "QM", "Q", "p", k)
    s = stateful_session(spark, 1)
    out = assemble_segments_stream(read_queue_stream(s, log, "QM", "Q", max_files_per_trigger=1).drop("producer", "seq"))
    q = drain(out.select("group_id", F.length("payload").alias("n"), "error"), f"{base}/sink", f"{base}/ckpt")
    assert [(r.group_id, r.n, r.error) for r in spark.read.parquet(f"{base}/sink").collect()] == [("G", parts * size, None)]
    ops = [p["stateOperators"][0] for p in q.recentProgress if p["stateOperators"]]
    return sum(o["numRowsUpdated"] for o in ops)


def test_state_written_grows_linearly_with_the_segments(spark, tmp):
    few, many = (written_bytes(spark, f"{tmp}/{n}", n, 2000) for n in (3, 9))
    assert many <= 3 * few + 8


def test_fixture_holds_every_kind_of_group(spark):
    out = complete_messages(fx.grouped_turn_messages(spark, SF_SMALL.replace("0.001", "0.01")))
    kinds = {r.error: r["count"] for r in out.groupBy("error").count().collect()}
    assert set(kinds) == {None, "INCOMPLETE_MESSAGE_GROUP", "CONFLICTING_MESSAGES", "INCOMPLETE_GROUP"}
    assert min(kinds.values()) > 0


class Calls:
    """A processor's handle and its states, in memory: counts every call."""

    def __init__(self):
        self.n, self.states = 0, {}

    def getMapState(self, name, *_):
        return self.states.setdefault(name, State(self))

    getValueState = getMapState

    def registerTimer(self, at):
        self.n += 1

    deleteTimer = registerTimer


class State:
    def __init__(self, calls):
        self.calls, self.kept = calls, {}

    def _call(self, result=None):
        self.calls.n += 1
        return result

    def containsKey(self, k):
        return self._call(k in self.kept)

    def getValue(self, k):
        return self._call(self.kept[k])

    def updateValue(self, k, v):
        self._call(self.kept.update({k: v}))

    def keys(self):
        return self._call(list(self.kept))

    def clear(self):
        self._call(self.kept.clear())

    def exists(self):
        return self._call(None in self.kept)

    def get(self):
        return self._call(self.kept.get(None))

    def update(self, v):
        self._call(self.kept.update({None: v}))


class Clock:
    def getCurrentWatermarkInMs(self):
        return 0


def collect(batches, **bounds):
    """(what comes out, calls of the state, entries left) of one group's batches."""
    processor, calls = PartCollector(Segments(1 << 20), 0, **bounds), Calls()
    processor.init(calls)
    out = []
    for rows in batches:
        rows = [dict(zip(("seg_offset", "last_segment", "payload"), r), msg_id="m", msg_type=8, correl_id=None, put_ts=None, error=None, __arrival_ms=1) for r in rows]
        out += [(r.seg_offset, r.payload, r.error) for r in processor.handleInputRows(("G",), iter(rows), Clock())]
    return out, calls.n, sum(len(s.kept) for s in calls.states.values())


def test_a_message_that_arrives_at_once_is_not_written_to_state():
    whole = [(k, k == 49, b"x") for k in range(50)]
    out, calls, left = collect([whole[::-1] + whole[:3]])
    assert (out, left) == ([(None, b"x" * 50, None)], 0)
    assert calls == 1  # whether the group is known


def test_parts_beyond_the_bound_and_of_other_batches_come_out_alike():
    whole = [(2 * k, k == 9, b"%d%d" % (k, k)) for k in range(10)]
    clash = (4, False, b"??")
    for batches in ([whole], [whole[::2], whole[1::2]], [whole[:3], whole[2:]]):
        plain = collect(batches)
        for bounds in ({"held_parts": 1}, {"held_bytes": 5}, {"held_parts": 4}):
            out, _, left = collect(batches, **bounds)
            assert (out, left) == (plain[0], plain[2]) == ([(None, b"00112233445566778899", None)], 0)
    for bounds in ({}, {"held_parts": 1}):
        out, _, left = collect([whole[:4] + [clash, clash], [clash], whole[4:]], **bounds)
        assert out == [(4, b"??", "CONFLICTING_SEGMENTS")] and left == 12  # parts, totals, the clash
