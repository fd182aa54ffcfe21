"""Stateful reassembly of segmented messages on a stream.

Per ``group_id`` every segment that waits for others is one entry of keyed state
(see ``streaming.parts``).  A group is emitted as one message as soon as it is
complete.  Once it has had no new segment for ``delay`` of arrival time and
later segments have arrived, it is emitted with an error and whatever arrived,
so it can be dead-lettered instead of waiting forever.  Unsegmented messages
pass straight through.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..operators.segments import CONFLICTING_SEGMENTS, GROUP_TOO_LARGE, INCOMPLETE_GROUP, MAX_MESSAGE_BYTES
from ..schema import MESSAGE_COLUMNS, MESSAGE_SCHEMA
from .parts import Part, Rule, Totals, collect_parts


class Segments(Rule):
    conflicting, incomplete = CONFLICTING_SEGMENTS, INCOMPLETE_GROUP

    def __init__(self, max_message_bytes: int):
        self.max_message_bytes = max_message_bytes

    def end(self, no: int, part: Part) -> int:
        return no + len(part.payload or b"")

    def may_be_whole(self, t: Totals) -> bool:
        return t.n_last == 1 and t.size == t.last_end

    def is_whole(self, ends: dict[int, int]) -> bool:
        expect = 0
        for no in sorted(ends):
            if no != expect:
                return False
            expect = ends[no]
        return True

    def oversized(self, t: Totals) -> str | None:
        return GROUP_TOO_LARGE if t.size > self.max_message_bytes else None

    def one(self, key: str, no: int, part: Part, error: str | None) -> Row:
        return Row(msg_id=part.msg_id, msg_type=part.msg_type, correl_id=part.correl_id, group_id=key, seg_offset=no, last_segment=part.last, put_ts=part.put_ts, payload=part.payload or b"", error=error)

    def out(self, key: str, parts: Iterator[tuple[int, Part]], error: str | None) -> Iterator[Row]:
        head, whole = None, bytearray()
        for no, part in parts:
            head = head or part
            whole += part.payload or b""
        yield Row(msg_id=head.msg_id, msg_type=head.msg_type, correl_id=head.correl_id, group_id=key, seg_offset=None, last_segment=None, put_ts=head.put_ts, payload=bytes(whole), error=error)


def assemble_segments_stream(df: DataFrame, delay: str = "10 minutes", max_message_bytes: int = MAX_MESSAGE_BYTES) -> DataFrame:
    """Reassemble segmented messages of a stream (see module doc).

    A group that has had no segment for ``delay`` of arrival time comes out as
    ``INCOMPLETE_GROUP``; segments that arrive for it later make a new group,
    which comes out as an error row of its own.  A segment delivered again is
    taken once; other bytes at the same offset come out as
    ``CONFLICTING_SEGMENTS`` and the group does too, after ``delay``.  A group
    of more bytes than a row can hold is released segment by segment.  A
    segment is written to state once, if its micro-batch does not complete the group.

    The session's state store has to be RocksDB (``session.stateful_session``).
    """
    df = df.select(
        *[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in MESSAGE_SCHEMA.fields]
    )
    plain = df.where(F.col("group_id").isNull()).select(*MESSAGE_COLUMNS, F.lit(None).cast("string").alias("error"))
    seg = df.where(F.col("group_id").isNotNull())
    return plain.unionByName(collect_parts(seg, Segments(max_message_bytes), delay))
