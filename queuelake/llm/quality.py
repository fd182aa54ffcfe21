"""Quality rules with adaptive thresholds.

Every metric is sketched per language and source: a quantile sketch is a table
of counts over logarithmic buckets (exact below 64, then 32 buckets for each
doubling, so a quantile is at most 1/32 low).  Counts of two sketches simply
add up, so sketches merge in any order, are pre-aggregated before the shuffle,
and give the same quantiles however the input is partitioned.

A document is rejected when a metric lies beyond the outer fences of its group,
``SPREADS`` times the spread between the quartiles away from them.  The least
spreads only keep a group apart whose quartiles are one value: that of the word
length is a bucket's width, below the spread of any language.  Groups of fewer than ``MIN_GROUP`` documents use
the merged sketch of their language, and languages of fewer the merged sketch
of all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from queuelake.llm.frames import from_struct, map_batches, row_struct, texts, written
from queuelake.llm.words import _SPACE, SHINGLE_WORDS, as_bytes, span_hashes, window_hashes, word_bounds

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MIN_GROUP = 100
SPREADS = 4
SYMBOLS = b"#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"


class Metric(NamedTuple):
    name: str
    expression: str  # an integer, of the counts
    least_spread: int


METRICS = [
    Metric("symbol_permille", "1000 * n_symbols div greatest(word_chars, 1)", 10),
    Metric("dup_line_permille", "1000 * n_dup_lines div greatest(n_lines, 1)", 50),
    Metric("word_centichars", "100 * word_chars div greatest(n_words, 1)", 8),
]

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
COUNT_TYPE = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])


def text_counts(text: str | None) -> tuple[int, ...]:
    """The counts of one whole text, in the order of ``COUNTS``."""
    data = as_bytes(text, lower=False)
    b, start, end = word_bounds(data)
    n = len(start)
    if n == 0:
        return 0, 0, sum(data.count(c) for c in SYMBOLS), 0, 0, 0
    word_chars = int(np.count_nonzero((b & 0xC0) != 0x80)) - int(np.count_nonzero(_SPACE[b]))
    seen: set[str] = set()
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    for x in lines:
        seen.add(x)
    repeated = 0
    windows = window_hashes(span_hashes(b, start, end))
    if len(windows) > 1:
        order = np.argsort(windows, kind="stable")
        same = windows[order[1:]] == windows[order[:-1]]
        if same.any():
            hit = np.zeros(len(windows) + SHINGLE_WORDS, dtype=np.int32)
            twice = np.zeros(len(windows), dtype=bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            at = np.flatnonzero(twice)
            hit[at] += 1
            hit[at + SHINGLE_WORDS] -= 1
            repeated = int(np.count_nonzero(np.cumsum(hit)))
    return n, word_chars, sum(data.count(c) for c in SYMBOLS), len(lines) - len(seen), repeated, len(lines)


def with_counts(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` (with a column ``text``, or ``row`` of ``row_struct``) and a
    struct column ``name`` of the text's counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([text_counts(t) for t in texts(batch).to_pylist()], dtype=np.int64).reshape(-1, len(COUNTS))
            counts = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(rows[:, i])) for i in range(len(COUNTS))], names=COUNTS)
            yield pa.RecordBatch.from_arrays([*batch.columns, counts], names=[*batch.schema.names, name])

    return map_batches(docs, run, T.StructType([*docs.schema.fields, T.StructField(name, COUNT_TYPE)]))


def base_failed(counts: str = "") -> Column:
    p = f"{counts}." if counts else ""
    return F.expr(f"{p}n_words < {MIN_WORDS} or 100 * {p}n_repeat_words > {MAX_REPEAT_PERCENT} * {p}n_words")


def metric(m: Metric, counts: str = "") -> Column:
    """The metric's integer value from columns or from a struct of counts."""
    out = m.expression
    for c in COUNTS if counts else []:
        out = out.replace(c, f"{counts}.{c}")
    return F.expr(out)


def bucket(value: Column) -> Column:
    """Least value of the logarithmic bucket that holds ``value``."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketch(counted: DataFrame) -> DataFrame:
    """(lang, source, metric, bucket, n): the sketches of all groups.

    Documents that fail the base rules say nothing about normal ones and stay
    out."""
    values = F.array(*[F.struct(F.lit(m.name).alias("metric"), bucket(metric(m)).alias("bucket")) for m in METRICS])
    return (
        counted.where(~base_failed()).select("lang", "source", F.explode(values).alias("v"))
        .groupBy("lang", "source", "v.metric", "v.bucket").agg(F.count("*").alias("n"))
    )


def _quartiles(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Merge the sketches by ``keys`` and read the quartiles off."""
    merged = sketches.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "metric")
    upto = F.sum("n").over(group.orderBy("bucket"))
    total = F.sum("n").over(group)
    at = merged.select(*keys, "metric", "bucket", upto.alias("upto"), total.alias("total"))
    return at.groupBy(*keys, "metric").agg(
        F.max("total").alias("total"),
        F.min(F.when(4 * F.col("upto") >= F.col("total"), F.col("bucket"))).alias("q1"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("total"), F.col("bucket"))).alias("q3"),
    )


def thresholds(sketches: DataFrame) -> DataFrame:
    """(lang, source, low_<metric>, high_<metric>...): one row per group."""
    own = _quartiles(sketches, ["lang", "source"])
    lang = _quartiles(sketches, ["lang"]).select(F.col("lang").alias("l_lang"), F.col("metric").alias("l_metric"), *[F.col(c).alias(f"l_{c}") for c in ("total", "q1", "q3")])
    every = _quartiles(sketches, []).select(F.col("metric").alias("e_metric"), *[F.col(c).alias(f"e_{c}") for c in ("q1", "q3")])
    both = own.join(lang, F.col("lang").eqNullSafe(F.col("l_lang")) & (F.col("metric") == F.col("l_metric"))).join(every, F.col("metric") == F.col("e_metric"))

    def quartile(q: str) -> Column:
        return F.when(F.col("total") >= MIN_GROUP, F.col(q)).when(F.col("l_total") >= MIN_GROUP, F.col(f"l_{q}")).otherwise(F.col(f"e_{q}"))

    least = reduce(lambda acc, m: acc.when(F.col("metric") == m.name, m.least_spread), METRICS[1:], F.when(F.col("metric") == METRICS[0].name, METRICS[0].least_spread))
    fenced = both.select("lang", "source", "metric", quartile("q1").alias("q1"), quartile("q3").alias("q3"), least.alias("least"))
    reach = SPREADS * F.greatest(F.col("q3") - F.col("q1"), F.col("least"))
    fenced = fenced.select("lang", "source", "metric", (F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high"))
    return fenced.groupBy("lang", "source").agg(*[
        F.max(F.when(F.col("metric") == m.name, F.col(side))).alias(f"{side}_{m.name}") for m in METRICS for side in ("low", "high")
    ])


def judged(counted: DataFrame, limits: DataFrame, counts: str = "") -> DataFrame:
    """``counted`` (lang, source and the counts) with the limits of its group and
    ``is_kept``.

    A group without limits (all its documents fail the base rules) keeps none
    that the base rules have not already rejected."""
    t = limits.withColumnsRenamed({"lang": "of_lang", "source": "of_source"})
    inside = [F.coalesce(metric(m, counts).between(F.col(f"low_{m.name}"), F.col(f"high_{m.name}")), F.lit(True)) for m in METRICS]
    return (
        counted.join(t, F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source")), "left")
        .withColumn("is_kept", ~base_failed(counts) & reduce(lambda a, b: a & b, inside))
    )


def quality_decisions(docs: DataFrame) -> DataFrame:
    """Counts and decision of every document.

    A null text has no words, so the base rules reject it.  A null language or
    source is a group like any other.  Repeated rows count and are decided one
    by one.  Other columns are not read; an empty table gives no rows.
    """
    counted = with_counts(docs.select("doc_id", "text", "lang", "source"), "counts").select("doc_id", "lang", "source", "counts.*")
    counted = written(counted, "quality")
    out = judged(counted, thresholds(sketch(counted)))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"), F.col("is_kept").alias("kept"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that the rules keep.

    The thresholds come from one pass over the texts, the decisions from a
    second, which joins only the small table of limits and moves no text."""
    counted = with_counts(docs.select("text", "lang", "source"), "counts").select("lang", "source", "counts.*")
    limits = written(thresholds(sketch(counted)), "limits")
    rows = with_counts(docs.select(row_struct(docs)), "counts").select("row", "row.lang", "row.source", "counts")
    return from_struct(judged(rows, limits, "counts").where("is_kept"), docs)
