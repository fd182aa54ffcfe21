"""Routing of messages that cannot be processed (dead letters)."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..options import QueueOptions, dead_letter_target
from ..schema import REPORT_CONFIRM_ON_ARRIVAL, REPORT_CONFIRM_ON_DELIVERY


def _opts(options: QueueOptions | Mapping[str, str]) -> QueueOptions:
    return options if isinstance(options, QueueOptions) else QueueOptions.from_dict(options)


def with_ack_request(df: DataFrame, options: QueueOptions | Mapping[str, str]) -> DataFrame:
    """Stamp outgoing messages with a reply-to and confirm-on-arrival /
    confirm-on-delivery report request when ``ackQueue`` is configured."""
    o = _opts(options)
    if o.ack_queue:
        return df.select(
            "*",
            F.lit(o.queue_manager).alias("reply_to_qmgr"),
            F.lit(o.ack_queue).alias("reply_to_queue"),
            F.array(F.lit(REPORT_CONFIRM_ON_ARRIVAL), F.lit(REPORT_CONFIRM_ON_DELIVERY)).alias("report"),
        )
    return df.select(
        "*",
        F.lit(None).cast("string").alias("reply_to_qmgr"),
        F.lit(None).cast("string").alias("reply_to_queue"),
        F.lit(None).cast("array<string>").alias("report"),
    )


def route_failures(split_df: DataFrame, options: QueueOptions | Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Split the output of a splitter into ``(good, dead)``.

    ``dead`` holds one row per failed message (the splitter contract puts the
    whole payload in ``value``), stamped with the dead-letter target
    (``target_qmgr``, ``target_queue``) and, if configured, the ack request.
    Both sides are filters of the same plan: no shuffle, nothing dropped.
    Writing both recomputes the split once per write unless ``split_df`` is
    persisted first (``QueueBatchWriter`` does that per micro-batch).
    """
    o = _opts(options)
    target = dead_letter_target(o)
    failed = F.col("error").isNotNull()
    good = split_df.where(~failed)
    dead = split_df.where(failed).select(
        "*",
        F.lit(target.queue_manager).alias("target_qmgr"),
        F.lit(target.queue).alias("target_queue"),
    )
    return good, with_ack_request(dead, o)
