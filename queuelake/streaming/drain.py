"""Running streams: drain what is there, reference-style reader, sinks."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.message import message_value
from ..operators.splitters import split_records
from ..options import QueueOptions
from ..sources.queue_log import read_queue, read_queue_stream


#: Options that ask for writes, which a plain DataFrame cannot do.
_WRITING = ("movepath", "backoutqueue", "ackqueue", "error.queue", "error queue", "error.queuemanager")


def read_mq(spark: SparkSession, stream: bool = True, **options: str) -> DataFrame:
    """The queue as records, split by ``fileFormat``/``split``/``headers``.

    ``path`` is the queue-log root.  Output: ``msg_id``, ``put_ts``,
    ``producer``, ``seq`` and the splitter contract's columns, error rows
    included.  Options that archive, route or acknowledge need a run of their
    own: ``process_mq`` takes the same options and acts on them; here they are
    rejected.
    """
    asked = sorted(k for k in options if k.lower() in _WRITING)
    if asked:
        raise ValueError(f"read_mq only reads; use process_mq for {asked}")
    o = QueueOptions.from_dict(options)
    if not o.path:
        raise ValueError("option 'path' (queue-log root) is required")
    if stream:
        msgs = read_queue_stream(spark, o.path, o.queue_manager, o.queue)
    else:
        msgs = read_queue(spark, o.path, o.queue_manager, o.queue, o.num_partitions)
    msgs = msgs.select("msg_id", "put_ts", "producer", "seq", message_value().alias("payload"))
    return split_records(msgs, o.file_format, **o.splitter_options())


def process_mq(
    spark: SparkSession,
    output: str,
    checkpoint: str,
    producer: str,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    **options: str,
) -> StreamingQuery:
    """Read a queue to the end, as ``read_mq`` does, and act on every option:
    raw messages go to each ``movePath``, failed ones whole to the backout or
    error queue (with the acknowledgement request of ``ackQueue``), good
    records to ``output``.  A rerun with the same checkpoint goes on where the
    last one committed."""
    from .writer import QueueBatchWriter

    o = QueueOptions.from_dict(options)
    writer = QueueBatchWriter(o, output, producer)
    stream = read_queue_stream(spark, o.path, o.queue_manager, o.queue, max_files_per_trigger=max_files_per_trigger)
    return run_foreach_batch(stream, writer, checkpoint, available_now)


def drain(
    df: DataFrame,
    sink_path: str,
    checkpoint: str,
    fmt: str = "parquet",
    output_mode: str = "append",
    partition_by: list[str] | None = None,
) -> StreamingQuery:
    """Process everything available now, then stop (``availableNow``).

    Each run picks up exactly what arrived since the last committed batch of
    this checkpoint; batches may be capped by the source's
    ``maxFilesPerTrigger``.  Waits for the run to finish.
    """
    w = (
        df.writeStream.format(fmt)
        .outputMode(output_mode)
        .option("path", sink_path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return q


def run_foreach_batch(df: DataFrame, fn, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Run ``fn(batch_df, batch_id)`` per micro-batch with a checkpoint."""
    w = df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    q = w.start()
    if available_now:
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    return q


def to_sink(df: DataFrame, kind: str, checkpoint: str, **kw) -> StreamingQuery:
    """Append a stream of records to ``kafka``, ``queue`` or ``parquet``."""
    kind = kind.lower()
    if kind == "kafka":
        from ..sources.kafka import kafka_writer

        return kafka_writer(df, kw["topic"], kw["bootstrap_servers"], checkpoint, kw.get("key"), kw.get("value", "value")).start()
    if kind == "parquet":
        return drain(df, kw["path"], checkpoint)
    if kind == "queue":
        from ..sources.kafka import refuse_failures
        from .writer import queue_append

        df = refuse_failures(df)

        return run_foreach_batch(
            df.select(F.col(kw.get("value", "value")).alias("payload"), *kw.get("keep", [])),
            queue_append(kw["root"], kw["queue_manager"], kw["queue"], kw["producer"]),
            checkpoint,
        )
    raise ValueError(f"unknown sink kind {kind!r}")


__all__ = ["read_mq", "process_mq", "drain", "run_foreach_batch", "to_sink"]
