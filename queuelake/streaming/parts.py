"""Keyed state that collects the numbered parts of a whole.

``PartCollector`` is a ``transformWithState`` processor: each part of a key is
one entry of a map state, written once, beside one small row of totals.  So the
state written grows linearly with a key's parts, whatever their number of
micro-batches.  Every call of the state is a round trip to the JVM, so the parts of
a micro-batch are held, up to a bound, until all have arrived: what is whole by
then never reaches the state.  What makes a whole, and what comes out of it, is a
``Rule``: segments of a message (``streaming.segments``) or messages of a group
(``streaming.groups``).

A part delivered again counts once.  Other content at the same number comes out
at once as an error, once too, and the key is told.  Every key ends: whole, or given up by
a timer once it has had no new part for ``delay`` of arrival time (the timestamp
of the micro-batch, which Spark logs, so a replay sees the same one).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from ..schema import MESSAGE_COLUMNS, MESSAGE_SCHEMA
from ..session import require_rocksdb, ship_package


class Part(NamedTuple):
    msg_id: str | None
    msg_type: int | None
    correl_id: bytes | None
    put_ts: object
    last: bool
    payload: bytes | None
    error: str | None

    def content(self) -> tuple[bool, bytes, str | None]:
        """What makes two deliveries of a number the same part."""
        return self.last, bytes(self.payload or b""), self.error


class Totals(NamedTuple):
    """Of the parts of a key."""

    n: int = 0
    size: int = 0  # bytes
    n_last: int = 0
    last_end: int = -1  # the end of the last part, as the rule counts
    latest_ms: int = 0
    bad: str | None = None
    timer_ms: int = -1


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_I, _L, _S, _B = T.IntegerType(), T.LongType(), T.StringType(), T.BinaryType()
_PART = _struct(msg_id=_S, msg_type=_I, correl_id=_B, put_ts=T.TimestampNTZType(), last=T.BooleanType(), payload=_B, error=_S)
_TOTALS = _struct(n=_I, size=_L, n_last=_I, last_end=_L, latest_ms=_L, bad=_S, timer_ms=_L)
_NUMBER = _struct(no=_I)
_CLASH = _struct(no=_I, digest=_S)
_SEEN = _struct(seen=T.BooleanType())


class Rule:
    """What the parts of a key make up."""

    #: Columns that hold a part's number and its last mark.
    number, last = "seg_offset", "last_segment"
    #: Added to the message schema on output.
    extra: list[T.StructField] = [T.StructField("error", T.StringType())]
    conflicting, incomplete = "", ""

    def end(self, no: int, part: Part) -> int:
        raise NotImplementedError

    def may_be_whole(self, t: Totals) -> bool:
        raise NotImplementedError

    def is_whole(self, ends: dict[int, int]) -> bool:
        """From every part's number and end."""
        raise NotImplementedError

    def oversized(self, t: Totals) -> str | None:
        return None

    def one(self, key: str, no: int, part: Part, error: str | None) -> Row:
        """A part as it came."""
        raise NotImplementedError

    def out(self, key: str, parts: Iterator[tuple[int, Part]], error: str | None) -> Iterator[Row]:
        """All parts of a key, in order."""
        return (self.one(key, no, part, error) for no, part in parts)

    def schema(self) -> T.StructType:
        return T.StructType(MESSAGE_SCHEMA.fields + self.extra)


#: What is held of a key's new parts; beyond it they go to state as they arrive.
HELD_BYTES = 1 << 20
HELD_PARTS = 1024


class PartCollector(StatefulProcessor):
    def __init__(self, rule: Rule, delay_ms: int, held_bytes: int = HELD_BYTES, held_parts: int = HELD_PARTS):
        self.rule, self.delay_ms = rule, delay_ms
        self.held_bytes, self.held_parts = held_bytes, held_parts

    def init(self, handle) -> None:
        self.handle = handle
        self.parts = handle.getMapState("parts", _NUMBER, _PART)
        self.totals = handle.getValueState("totals", _TOTALS)
        self.clashes = handle.getMapState("clashes", _CLASH, _SEEN)

    def _in_order(self, held: dict[int, Part], stored: bool) -> Iterator[tuple[int, Part]]:
        """One part of the state at a time: beside what is held, the key's own limit
        of memory is a part."""
        for no in sorted([*held, *(k[0] for k in self.parts.keys())] if stored else held):
            yield no, held[no] if no in held else Part(*self.parts.getValue((no,)))

    def _store(self, held: dict[int, Part]) -> None:
        for no, part in held.items():
            self.parts.updateValue((no,), tuple(part))
        held.clear()

    def _drop(self, t: Totals, stored: bool = True, known: bool = True) -> None:
        if stored:
            self.parts.clear()
        if known:
            self.totals.clear()
        if t.bad:
            self.clashes.clear()
        if t.timer_ms >= 0:
            self.handle.deleteTimer(t.timer_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        (key,), rule = key, self.rule
        before = self.totals.get()
        known = stored = before is not None
        t = Totals(*before) if known else Totals()
        held, held_bytes = {}, 0
        for row in rows:
            no = -1 if row[rule.number] is None else int(row[rule.number])
            payload = None if row["payload"] is None else bytes(row["payload"])
            correl = None if row["correl_id"] is None else bytes(row["correl_id"])
            part = Part(row["msg_id"], row["msg_type"], correl, row["put_ts"], bool(row[rule.last]), payload, row["error"])
            t = t._replace(latest_ms=max(t.latest_ms, row["__arrival_ms"]))
            first = held.get(no)
            if first is None and stored and self.parts.containsKey((no,)):
                first = Part(*self.parts.getValue((no,)))
            if first is not None:
                if first.content() != part.content():
                    t = t._replace(bad=rule.conflicting)
                    clash = (no, hashlib.md5(repr(part.content()).encode()).hexdigest())
                    if not self.clashes.containsKey(clash):
                        self.clashes.updateValue(clash, (True,))
                        yield rule.one(key, no, part, rule.conflicting)
                continue
            held[no] = part
            held_bytes += len(payload or b"")
            if held_bytes > self.held_bytes or len(held) > self.held_parts:
                self._store(held)
                stored, held_bytes = True, 0
            t = t._replace(
                n=t.n + 1,
                size=t.size + len(payload or b""),
                n_last=t.n_last + part.last,
                last_end=rule.end(no, part) if part.last else t.last_end,
                bad=t.bad or (part.error and rule.incomplete),
            )
        too_large = rule.oversized(t)
        if too_large:
            for no, part in self._in_order(held, stored):
                yield rule.one(key, no, part, too_large)
            self._drop(t, stored, known)
        elif not t.bad and rule.may_be_whole(t) and rule.is_whole({no: rule.end(no, part) for no, part in self._in_order(held, stored)}):
            yield from rule.out(key, self._in_order(held, stored), None)
            self._drop(t, stored, known)
        else:
            self._store(held)
            if t.timer_ms >= 0:
                self.handle.deleteTimer(t.timer_ms)
            # one more: nothing is given up before anything later has arrived
            at = max(t.latest_ms + self.delay_ms, timerValues.getCurrentWatermarkInMs()) + 1
            self.handle.registerTimer(at)
            self.totals.update(tuple(t._replace(timer_ms=at)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        t = Totals(*self.totals.get())
        yield from self.rule.out(key[0], self._in_order({}, True), t.bad or self.rule.incomplete)
        self._drop(t._replace(timer_ms=-1))

    def close(self) -> None:
        pass


def interval_ms(text: str) -> int:
    n, unit = text.strip().split(None, 1)
    unit = unit.lower().rstrip("s")
    # Milliseconds per unit.
    scale = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}
    return int(float(n) * scale[unit])


def collect_parts(parts: DataFrame, rule: Rule, delay: str) -> DataFrame:
    """The wholes, and what was given up, of a stream of parts with ``group_id``."""
    ship_package(parts.sparkSession)
    require_rocksdb(parts.sparkSession)
    error = F.col("error") if "error" in parts.columns else F.lit(None).cast("string").alias("error")
    columns = [*MESSAGE_COLUMNS, *([rule.number, rule.last] if rule.number not in MESSAGE_COLUMNS else [])]
    rows = parts.select(*columns, error)
    rows = rows.withColumn("__arrival", F.current_timestamp()).withColumn("__arrival_ms", F.unix_millis("__arrival")).withWatermark("__arrival", "0 seconds")
    return rows.groupBy("group_id").transformWithState(PartCollector(rule, interval_ms(delay)), rule.schema(), "append", "EventTime")
