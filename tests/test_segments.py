from pyspark.sql import functions as F

from queuelake.operators.segments import assemble_segments

SCHEMA = "msg_id string, group_id string, seg_offset int, last_segment boolean, payload binary"


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _out(df):
    return sorted(((r.group_id or ""), bytes(r.payload)) for r in df.collect())


def test_complete_groups_and_passthrough(spark):
    rows = [
        ("a0", "A", 0, False, b"hel"),
        ("a1", "A", 3, False, b"lo "),
        ("a2", "A", 6, True, b"world"),
        ("b1", "B", 2, True, b"yz"),  # missing offset 0
        ("c0", "C", 0, False, b"xx"),  # no last segment yet
        ("d0", "D", 0, True, b"one"),
        ("p", None, None, None, b"plain"),
        ("a1", "A", 3, False, b"lo "),  # duplicate delivery
    ]
    every = assemble_segments(_df(spark, rows))
    assert sorted((r.group_id, bytes(r.payload), r.error) for r in every.where("error is not null").collect()) == [
        ("B", b"yz", "INCOMPLETE_GROUP"),
        ("C", b"xx", "INCOMPLETE_GROUP"),
    ]
    out = every.where("error is null")
    assert _out(out) == [("", b"plain"), ("A", b"hello world"), ("D", b"one")]
    assert out.where(F.col("group_id") == "A").collect()[0].msg_id == "a0"


def test_gap_overlap_and_keep_incomplete(spark):
    rows = [
        ("e0", "E", 0, False, b"ab"),
        ("e1", "E", 3, True, b"cd"),  # gap
        ("f0", "F", 0, True, b"ab"),
        ("f1", "F", 2, True, b"cd"),  # two last segments
    ]
    kept = assemble_segments(_df(spark, rows)).collect()
    assert sorted((r.group_id, bytes(r.payload), r.error) for r in kept) == [
        ("E", b"abcd", "INCOMPLETE_GROUP"),
        ("F", b"abcd", "INCOMPLETE_GROUP"),
    ]


def test_multibyte_boundaries(spark):
    text = "é" * 5 + "x"
    data = text.encode()
    rows = [(f"s{i}", "G", i, i == len(data) - 1, data[i : i + 1]) for i in range(len(data))]
    assert _out(assemble_segments(_df(spark, rows))) == [("G", data)]


def test_oversized_group_comes_out_segment_by_segment(spark):
    rows = [("h%d" % i, "HOT", i * 2, i == 49, b"xx") for i in range(50)] + [
        ("a0", "A", 0, True, b"ok"),
    ]
    out = assemble_segments(_df(spark, rows), max_message_bytes=64)
    assert _out(out.where("error is null")) == [("A", b"ok")]
    hot = out.where(F.col("group_id") == "HOT").collect()
    assert len(hot) == 50 and {r.error for r in hot} == {"GROUP_TOO_LARGE"}
    assert sorted(r.seg_offset for r in hot) == [i * 2 for i in range(50)]
    # under the limit the same group is one message
    assert ("HOT", b"xx" * 50) in _out(assemble_segments(_df(spark, rows), max_message_bytes=1000))


def test_redelivered_and_conflicting_segments(spark):
    wide = SCHEMA + ", seq long, put_ts timestamp_ntz"
    import datetime as dt

    t = [dt.datetime(2024, 1, 1, h) for h in range(3)]
    rows = [
        ("a0", "A", 0, False, b"ab", 1, t[0]),
        ("a1", "A", 2, True, b"cd", 1, t[0]),
        ("other", "A", 2, True, b"cd", 2, t[1]),  # again: another append, id and put time
        ("b0", "B", 0, False, b"ab", 1, t[0]),
        ("b1", "B", 2, True, b"cd", 1, t[0]),
        ("b2", "B", 2, True, b"XX", 1, t[2]),  # other bytes at the same place
        ("c0", "C", None, True, b"q", 1, None),
        ("d0", "D", 0, True, None, 1, None),
        ("d0", "D", 0, True, None, 1, None),
        ("e0", "E", 0, False, b"12", 1, None),  # overlap and gap with the right sum
        ("e1", "E", 1, False, b"3", 1, None),
        ("e2", "E", 3, True, b"4", 1, None),
    ]
    out = assemble_segments(spark.createDataFrame(rows, wide)).collect()
    got = sorted((r.group_id, r.seg_offset, r.payload and bytes(r.payload), r.error) for r in out if r.group_id != "B")
    assert got == [
        ("A", None, b"abcd", None),
        ("C", None, b"q", "INCOMPLETE_GROUP"),
        ("D", None, b"", None),
        ("E", None, b"1234", "INCOMPLETE_GROUP"),
    ]
    assert sorted(bytes(r.payload) for r in out if r.group_id == "B") == [b"XX", b"ab", b"cd"]
    assert {r.error for r in out if r.group_id == "B"} == {"CONFLICTING_SEGMENTS"}


def test_states_agree_with_the_plain_definition(spark):
    import random

    rng = random.Random(7)
    rows, want = [], {}
    for g in range(300):
        cuts = sorted(rng.sample(range(1, 12), rng.randrange(0, 5)))
        segs = [(a, b) for a, b in zip([0, *cuts], [*cuts, 12])]
        if rng.random() < 0.6:  # spoil it
            k = rng.randrange(len(segs))
            a, b = segs[k]
            segs[k] = rng.choice([(a + 1, b), (a, b + 1), (a, max(a, b - 1)), (a + 1, b + 1)])
            if rng.random() < 0.3:
                del segs[rng.randrange(len(segs))]
        last = len(segs) - 1 if rng.random() < 0.9 else rng.randrange(len(segs) + 1) - 1
        rows += [(f"{g}-{i}", str(g), a, i == last, b"x" * (b - a)) for i, (a, b) in enumerate(segs)]
        at = dict(segs)
        good = len(at) == len(segs) and segs and last == max(range(len(segs)), key=lambda i: segs[i])
        order = sorted(at)
        good = good and order[0] == 0 and all(at[x] == y for x, y in zip(order, order[1:]))
        want[str(g)] = bool(good)
    out = assemble_segments(_df(spark, rows)).collect()
    got = {r.group_id: r.error is None for r in out}
    assert set(got) == {r[1] for r in rows} and all(want[g] == ok for g, ok in got.items())
