"""Confirm-on-arrival and confirm-on-delivery reports matched to dead letters.

Dead letters leave with a request for reports (``routing.with_ack_request``);
the reports come back as messages that name the letter by their correlation id.
One outer join with a bound on time finds the confirmations and what was never
confirmed; on a stream its state is what lies within the bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import MQMT_REPORT, REPORT_CONFIRM_ON_ARRIVAL, REPORT_CONFIRM_ON_DELIVERY

# Feedback codes of reports (MQFB_*), as published in the IBM MQ
# constants reference.
MQFB_COA = 259
MQFB_COD = 260


def _instant(ntz: Column) -> Column:
    """A UTC wall clock as the instant that watermarks need."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), ntz).cast("timestamp")


def confirmations(dead: DataFrame, reports: DataFrame, within: str = "7 days", delay: str = "1 hour") -> DataFrame:
    """``msg_id``, ``kind`` (COA or COD), ``put_ts`` and ``confirmed_ts`` of every
    report that the dead letters ask for (their ``report`` array).

    ``reports`` are messages with a ``feedback`` code; others than COA and COD
    reports are not read.  A report confirms the letter whose ``msg_id`` is its
    correlation id, if its put time is at most ``within`` after the letter's; a
    report delivered again counts once, a different one of the same kind gives a
    row of its own.  What is not confirmed has a null ``confirmed_ts``: in a batch
    at once, on a stream (both inputs are streams) when the watermarks, ``delay``
    behind the latest put times of both, have passed the bound.  A letter without
    put time can not be confirmed; one that asks for nothing gives no row.
    """
    stream = dead.isStreaming
    if stream != reports.isStreaming:
        raise ValueError("dead letters and reports are either both streams or both not")
    kind = F.when(F.col("feedback") == MQFB_COA, REPORT_CONFIRM_ON_ARRIVAL).when(F.col("feedback") == MQFB_COD, REPORT_CONFIRM_ON_DELIVERY)
    asked = dead.select("msg_id", "put_ts", F.explode(F.array_distinct("report")).alias("kind"), _instant(F.col("put_ts")).alias("d_at"))
    came = reports.where((F.col("msg_type") == MQMT_REPORT) & kind.isNotNull() & F.col("put_ts").isNotNull()).select(
        F.col("msg_id").alias("r_id"), F.col("correl_id").cast("string").alias("r_of"), kind.alias("r_kind"),
        F.col("put_ts").alias("confirmed_ts"), _instant(F.col("put_ts")).alias("r_at"),
    )
    same = ["r_id", "r_of", "r_kind", "confirmed_ts"]
    if stream:
        asked = asked.withWatermark("d_at", delay)
        came = came.withWatermark("r_at", delay).dropDuplicatesWithinWatermark(same)
    else:
        came = came.dropDuplicates(same)
    dated = F.col("d_at").isNotNull()
    of = (F.col("msg_id") == F.col("r_of")) & (F.col("kind") == F.col("r_kind"))
    on_time = (F.col("r_at") >= F.col("d_at")) & (F.col("r_at") <= F.col("d_at") + F.expr(f"interval {within}"))
    out = ["msg_id", "kind", "put_ts", "confirmed_ts"]
    never = asked.where(~dated).withColumn("confirmed_ts", F.lit(None).cast("timestamp_ntz"))
    return asked.where(dated).join(came, of & on_time, "left_outer").select(*out).unionByName(never.select(*out))


__all__ = ["confirmations", "MQFB_COA", "MQFB_COD"]
