"""Property checks with fixed seeds (no extra libraries)."""

import random

from pyspark.sql import functions as F

from conftest import messages
from queuelake.operators.splitters import split_json, split_lines, split_xml

TERMS = ["\n", "\r\n", "\r", "\u2028", "\u2029", "\u0085"]


def _rand_text(rng):
    parts = []
    for _ in range(rng.randint(0, 8)):
        parts.append("".join(rng.choice("ab é€<>{}") for _ in range(rng.randint(0, 5))))
        parts.append(rng.choice(TERMS))
    if parts and rng.random() < 0.5:
        parts.pop()
    return "".join(parts)


def _java_lines(text):
    """Reference semantics of a Java line scanner, written independently."""
    import re

    if text == "":
        return []
    pieces = re.split("\r\n|[\n\r\u2028\u2029\u0085]", text)
    if re.search("(\r\n|[\n\r\u2028\u2029\u0085])$", text):
        pieces = pieces[:-1]
    return pieces


def test_split_lines_matches_scanner_model(spark):
    rng = random.Random(7)
    texts = [_rand_text(rng) for _ in range(300)]
    df = messages(spark, texts)
    out = split_lines(df).select("msg_id", "pos", F.col("value").cast("string").alias("v")).collect()
    got = {}
    for r in out:
        got.setdefault(int(r.msg_id), []).append((r.pos, r.v))
    for i, t in enumerate(texts):
        assert [v for _, v in sorted(got.get(i, []))] == _java_lines(t), repr(t)


def test_record_count_equals_element_count(spark):
    rng = random.Random(11)
    docs, counts = [], []
    for _ in range(200):
        n = rng.randint(0, 6)
        items = "".join(f"<i><v>{rng.randint(0, 99)}</v></i>" for _ in range(n))
        docs.append(f"<r><h>x</h>{items}</r>")
        counts.append(n)
    out = split_xml(messages(spark, docs), split="i").groupBy("msg_id").count().collect()
    got = {int(r.msg_id): r["count"] for r in out}
    assert all(got.get(i, 0) == n for i, n in enumerate(counts))
    jdocs = ['{"items":[' + ",".join(str(j) for j in range(n)) + "]}" for n in counts]
    jout = split_json(messages(spark, jdocs), split="items").where("error is null").groupBy("msg_id").count().collect()
    jgot = {int(r.msg_id): r["count"] for r in jout}
    assert all(jgot.get(i, 0) == n for i, n in enumerate(counts))


def test_independent_of_partitioning(spark):
    rng = random.Random(3)
    texts = [_rand_text(rng) for _ in range(200)]
    df = messages(spark, texts)
    a = split_lines(df.repartition(1)).select("msg_id", "pos", "value").collect()
    b = split_lines(df.repartition(13)).select("msg_id", "pos", "value").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
