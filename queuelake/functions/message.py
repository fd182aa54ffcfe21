"""Column expressions on queue messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import ARCHIVE_TS_FORMAT, MQMT_REPORT


def message_value(msg_type: str = "msg_type", correl_id: str = "correl_id", payload: str = "payload") -> Column:
    """The bytes a message contributes: its correlation id for report messages,
    else its payload."""
    return F.when(F.col(msg_type) == F.lit(MQMT_REPORT), F.col(correl_id)).otherwise(F.col(payload))


def archive_name(data_source: str, put_ts: str = "put_ts", msg_id: str = "msg_id") -> Column:
    """``yyyyMMddHHmmss_<message id>_MQ_<dataSource>``.

    The message id stands where a random id would: a retried batch then
    writes the same name again instead of a second copy.
    """
    return F.concat(
        F.date_format(F.col(put_ts), ARCHIVE_TS_FORMAT),
        F.lit("_"),
        F.col(msg_id),
        F.lit("_MQ_" + data_source),
    )
