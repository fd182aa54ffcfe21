"""``foreachBatch`` writers: archive, dead letters and good records per batch.

There is no transaction across several targets, so every target directory is
keyed by queue manager, queue, producer and batch id and skipped when already
finished: a batch replayed after a failure (its offsets are fixed, so its
content is the same) adds nothing twice.  Each directory keeps the identity of
the stream's checkpoint; another checkpoint that would write the same directory
(its batch ids start at 0 again) fails and needs another producer name.
Write order: archive, dead letters, good records.
"""

from __future__ import annotations

from typing import Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.message import message_value
from ..operators.routing import route_failures
from ..operators.splitters import split_records
from ..options import QueueOptions, dead_letter_target
from ..schema import MQMT_REPORT
from ..sources.archive import archive
from ..sources.fs import write_once
from ..sources.queue_log import conform_messages, seq_dir


def checkpoint_identity(df: DataFrame) -> str | None:
    """The streaming query's id, which its checkpoint keeps over restarts;
    None outside of a stream."""
    return df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def queue_append(root: str, queue_manager: str, queue: str, producer: str):
    """foreachBatch function appending each batch to a queue (seq = batch id)."""

    def fn(batch_df: DataFrame, batch_id: int) -> None:
        path = seq_dir(root, queue_manager, queue, producer, batch_id)
        write_once(conform_messages(batch_df, producer, batch_id), path, owner=checkpoint_identity(batch_df))

    return fn


class QueueBatchWriter:
    """Per micro-batch of messages: archive raw payloads to every ``movePath``,
    split by ``fileFormat``, send failed messages (whole, with their header
    fields) to the dead-letter queue of ``options`` and write good records to
    ``output`` (parquet, ``reader=<reader>/batch_id=<n>`` directories)."""

    def __init__(self, options: QueueOptions | Mapping[str, str], output: str, producer: str):
        self.o = options if isinstance(options, QueueOptions) else QueueOptions.from_dict(options)
        if not self.o.path:
            raise ValueError("option 'path' (queue-log root for dead letters) is required")
        self.target = dead_letter_target(self.o)
        self.output = output.rstrip("/")
        self.producer = producer
        self.reader = "-".join((self.o.queue_manager, self.o.queue, producer))

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        owner = checkpoint_identity(batch_df)
        # read once for the split (persisted below) and once for every archive
        msgs = batch_df.persist(StorageLevel.MEMORY_AND_DISK) if self.o.move_paths else batch_df
        split = None
        try:
            if self.o.move_paths:
                archive(msgs, self.o.move_paths, batch_id, self.o.data_source, self.reader, owner)
            keep = [c for c in ("msg_id", "msg_type", "correl_id", "put_ts") if c in msgs.columns]
            # a report's value is its correlation id: keep what it was sent with
            sent = F.when(F.col("msg_type") == MQMT_REPORT, F.col("payload")).alias("report_payload")
            split = split_records(
                msgs.select(*keep, sent, message_value().alias("payload")),
                self.o.file_format,
                **self.o.splitter_options(),
            ).persist(StorageLevel.MEMORY_AND_DISK)
            good, dead = route_failures(split, self.o)
            report = F.col("msg_type") == MQMT_REPORT
            dead_msgs = dead.select(
                *keep,
                F.when(report, F.col("report_payload")).otherwise(F.col("value")).alias("payload"),
                "error",
                "reply_to_qmgr",
                "reply_to_queue",
                "report",
            )
            write_once(
                conform_messages(dead_msgs, self.reader, batch_id),
                seq_dir(self.o.path, self.target.queue_manager, self.target.queue, self.reader, batch_id),
                owner=owner,
            )
            write_once(good.drop("error", "report_payload"), f"{self.output}/reader={self.reader}/batch_id={int(batch_id)}", owner=owner)
        finally:
            if split is not None:
                split.unpersist()
            if self.o.move_paths:
                msgs.unpersist()
