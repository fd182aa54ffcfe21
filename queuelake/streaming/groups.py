"""Message groups on a stream: released whole and in order, or given up.

The stream's counterpart of ``operators.groups``: logical messages (of segments,
``streaming.segments`` has made them before) wait in keyed state, one entry each,
until every sequence number up to the last mark is there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.groups import CONFLICTING_MESSAGES, INCOMPLETE_MESSAGE_GROUP, with_group_columns
from ..schema import GROUP_FIELDS
from .parts import Part, Rule, Totals, collect_parts


class Messages(Rule):
    number, last = "msg_seq", "last_in_group"
    extra = [*GROUP_FIELDS, T.StructField("error", T.StringType())]
    conflicting, incomplete = CONFLICTING_MESSAGES, INCOMPLETE_MESSAGE_GROUP

    def end(self, no: int, part: Part) -> int:
        return no

    def may_be_whole(self, t: Totals) -> bool:
        return t.n_last == 1 and t.last_end == t.n

    def is_whole(self, ends: dict[int, int]) -> bool:
        return min(ends) == 1 and max(ends) == len(ends)

    def one(self, key: str, no: int, part: Part, error: str | None) -> Row:
        return Row(msg_id=part.msg_id, msg_type=part.msg_type, correl_id=part.correl_id, group_id=key, seg_offset=None, last_segment=None, put_ts=part.put_ts, payload=part.payload, msg_seq=no, last_in_group=part.last, error=error or part.error)


def release_groups_stream(df: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Messages of a stream in the message schema with msg_seq, last_in_group
    and error.  Those of a group come out together, in order of ``msg_seq``, in
    the micro-batch that completes it; messages of no group pass straight through.

    Error rows: all of a group that has had no new message for ``delay`` of
    arrival time (``INCOMPLETE_MESSAGE_GROUP``, as soon as later messages have
    arrived), or that has different messages at one number
    (``CONFLICTING_MESSAGES``).  A message delivered again is taken once; one
    that arrives after its group was given up, or released, makes a new group.

    The session's state store has to be RocksDB (``session.stateful_session``).
    """
    df = with_group_columns(df)
    grouped = F.col("group_id").isNotNull() & F.col("msg_seq").isNotNull()
    return df.where(~grouped).unionByName(collect_parts(df.where(grouped), Messages(), delay))
