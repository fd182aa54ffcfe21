"""The queue log: a replayable, append-only store of queue messages.

Layout (one directory per queue)::

    <root>/<queueManager>/<queue>/producer=<name>/seq=<20 digits>/part-*.parquet
                                                               /_SUCCESS

Every append is one directory keyed by (producer, seq).  It is written aside
and renamed when finished, so readers never see a part of it.  A producer that retries an append with the same seq
skips it, so a retried batch never adds a second copy.  Readers are Spark's
own parquet sources (batch and streaming): column pruning, row-group
filters on ``msg_type``/``put_ts`` and partition pruning on
``producer``/``seq`` come for free.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schema import LOG_SCHEMA, MESSAGE_SCHEMA, MQMT_DATAGRAM
from .fs import path_exists, write_once


def queue_dir(root: str, queue_manager: str, queue: str) -> str:
    return f"{root.rstrip('/')}/{queue_manager}/{queue}"


def seq_dir(root: str, queue_manager: str, queue: str, producer: str, seq: int) -> str:
    return f"{queue_dir(root, queue_manager, queue)}/producer={producer}/seq={int(seq):020d}"


def conform_messages(df: DataFrame, producer: str = "p", seq: int = 0) -> DataFrame:
    """Project ``df`` onto the message schema, filling what is missing.

    ``payload`` (string or binary) is required.  A missing ``msg_id`` is made
    unique per append; ``msg_type`` defaults to datagram; ``put_ts`` to now
    (UTC wall clock).
    """
    if "payload" not in df.columns:
        raise ValueError("messages need a 'payload' column")
    cols: list[Column] = []
    for f in MESSAGE_SCHEMA.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.name == "msg_id":
            cols.append(
                F.concat_ws(":", F.lit(producer), F.lit(str(seq)), F.monotonically_increasing_id().cast("string")).alias("msg_id")
            )
        elif f.name == "msg_type":
            cols.append(F.lit(MQMT_DATAGRAM).alias("msg_type"))
        elif f.name == "put_ts":
            cols.append(F.convert_timezone(None, F.lit("UTC"), F.current_timestamp()).cast(f.dataType).alias("put_ts"))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    extra = [c for c in df.columns if c not in {f.name for f in MESSAGE_SCHEMA.fields}]
    return df.select(*cols, *extra)


def write_queue(
    df: DataFrame,
    root: str,
    queue_manager: str,
    queue: str,
    producer: str = "p",
    seq: int | None = None,
) -> str:
    """Append messages to a queue (batch).  Idempotent per (producer, seq).

    ``seq`` defaults to the current time in microseconds.  Writers that run
    at the same time must use different ``producer`` names: an append whose
    (producer, seq) is already finished is skipped, by design, so a retried
    append never adds a second copy.
    """
    if seq is None:
        seq = time.time_ns() // 1000
    path = seq_dir(root, queue_manager, queue, producer, seq)
    write_once(conform_messages(df, producer, seq), path)
    return path


def read_queue(
    spark: SparkSession,
    root: str,
    queue_manager: str,
    queue: str,
    num_partitions: int | None = None,
    schema: StructType = LOG_SCHEMA,
) -> DataFrame:
    """All finished messages of a queue as a batch DataFrame (log schema;
    pass ``DEAD_LETTER_LOG_SCHEMA`` for a dead-letter queue)."""
    qdir = queue_dir(root, queue_manager, queue)
    if not path_exists(spark, qdir):
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).option("basePath", qdir).parquet(qdir)
    return with_partitions(df, num_partitions)


def with_partitions(df: DataFrame, num_partitions: int | None) -> DataFrame:
    """``numPartitions``: fewer partitions by coalescing (no shuffle), more by
    a round-robin repartition."""
    if not num_partitions:
        return df
    try:
        current = df.rdd.getNumPartitions()
    except Exception:  # Spark Connect: no RDD view
        return df.repartition(num_partitions)
    if num_partitions < current:
        return df.coalesce(num_partitions)
    if num_partitions > current:
        return df.repartition(num_partitions)
    return df


def read_queue_stream(
    spark: SparkSession,
    root: str,
    queue_manager: str,
    queue: str,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
    clean_source: str | None = None,
    source_archive_dir: str | None = None,
    schema: StructType = LOG_SCHEMA,
) -> DataFrame:
    """Messages of a queue as a stream, on Spark's file source.

    The file source logs which files each micro-batch read, so a restart from
    the checkpoint replays exactly the uncommitted batch.  ``clean_source=
    "archive"`` moves consumed files to ``source_archive_dir`` (consume by
    moving); ``"delete"`` removes them.
    """
    qdir = queue_dir(root, queue_manager, queue)
    r = spark.readStream.schema(schema).option("basePath", qdir)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if max_bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    if clean_source:
        r = r.option("cleanSource", clean_source)
        if source_archive_dir:
            r = r.option("sourceArchiveDir", source_archive_dir)
    return r.parquet(qdir)
