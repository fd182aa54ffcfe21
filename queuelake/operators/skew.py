"""Splitting hot groups before a per-group collect.

Building one message per group (an order's items, a user's events of a day)
collects each group into one row.  A single hot key must not land whole in
one task, so groups above ``max_rows`` are cut into ``ceil(n / max_rows)``
chunks by a hash of the row's number (equal rows part too); every other group
keeps chunk 0.  Chunks hold ``max_rows`` rows on average (binomial spread: a
few ``sqrt(max_rows)`` more at most for large limits).

Everything is part of the query's own plan: the counts are a partial aggregate
of the keys, and the table of hot groups (at most ``rows / max_rows``) meets the
rows in an ordinary join, whose strategy and skew handling are Spark's.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def chunk_hot_groups(df: DataFrame, keys: Sequence[str], max_rows: int, chunk_col: str = "chunk") -> DataFrame:
    """``df`` with ``chunk_col``.  ``df`` should be a scan and projections: the
    row numbers are taken before anything is shuffled, so a task that runs again
    gives its rows the same ones."""
    if max_rows < 1:
        raise ValueError("max_rows must be positive")
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    hot = counts.where(F.col("__n") > max_rows).select(*keys, F.ceil(F.col("__n") / F.lit(max_rows)).cast("int").alias("__chunks"))
    numbered = df.withColumn("__row", F.xxhash64(F.monotonically_increasing_id()))
    chunk = F.coalesce(F.pmod(F.col("__row"), F.col("__chunks")).cast("int"), F.lit(0))
    return numbered.join(hot, list(keys), "left").withColumn(chunk_col, chunk).drop("__chunks", "__row")


def group_messages(df: DataFrame, keys: Sequence[str], agg, chunk_col: str = "chunk", also: Sequence[str] = ()) -> DataFrame:
    """``groupBy(keys, also, chunk).agg(agg)``; ``also`` depends on the keys.

    The rows are hash-partitioned on the keys and the chunk first and the
    aggregate reuses that partitioning: the exchange moves the compact typed
    columns instead of the built record strings, and ``agg`` (string building +
    ``collect_list``, which a map-side combine would not shrink anyway) runs on
    the reduce side in parallel, however few splits the input has.
    """
    return df.repartition(*keys, chunk_col).groupBy(*keys, chunk_col, *also).agg(agg)


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a narrow input over at least ``min_partitions`` tasks.

    Only inputs with fewer partitions than the cluster's parallelism (one
    small file, one row group) are repartitioned; a large input already has
    more splits than cores and is returned untouched, without a shuffle.
    """
    try:
        want = min_partitions or int(df.sparkSession.sparkContext.defaultParallelism)
        have = df.rdd.getNumPartitions()  # planning only on a scan: no job
    except Exception:  # Spark Connect: no RDD view; leave the plan as it is
        return df
    return df if have >= want else df.repartition(want)
