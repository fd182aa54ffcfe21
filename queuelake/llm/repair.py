"""Repair of conversation structure: lightest derivations from an agenda.

A repaired conversation is empty or an optional system turn, then user and
assistant turns in alternation, ending with an assistant: its roles' initials
read ``(s?(ua)+)?``.  Each turn is kept (K), given another role (R) or deleted
(D), and empty turns are inserted (I).  The parse is deduction over items
``(turns read, role last given out)``; an edit is an edge of a hypergraph whose
value is ``(cost + its cost, audit + its letter)``.  That function is monotone
and superior in the order of (cost, audit): no edge gives less than it was
given, and two derivations of equal cost of one item are never prefixes of each
other.  So Knuth's generalisation of Dijkstra's algorithm holds: items are
popped from an agenda, least value first, each is final when popped, and the
search ends when the goal is.

A conversation that is not longer than a block, and lies in one partition, is
one search.  Of others each block of turns is searched on its own, from every
role it may be entered with to every role it may be left with; these items are
the second antecedents of the edges that join the blocks up, again lightest
first.  No conversation is gathered: rows are sorted by range (a conversation
of any length lies over many partitions), blocks are bounded, and what the
joining holds of a block is its sixteen costs and audits.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queuelake.llm.frames import written
from queuelake.session import ship_package

# Costs of the edits, and of a truncated turn that stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1

BLOCK_TURNS = 256
BLOCK_CHARS = 4 << 20

BLANK_RE, LAST_RE = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*\z"

#: What was given out last: nothing, system, user, assistant.
STATES = "-sua"
#: The initials that may follow each.
FOLLOWS = {"-": "su", "s": "u", "u": "a", "a": "u"}
ROLE = {"u": "user", "a": "assistant"}


class Turn(NamedTuple):
    initial: str
    fault: str | None


class Derivation(NamedTuple):
    cost: int
    audit: str
    roles: str  # initial of each turn given out, upper case if it was inserted, "." for a deleted one


def lightest(turns: list[Turn], entry: str, exits: str, trailing: bool) -> dict[str, Derivation]:
    """The lightest derivation of the turns from ``entry`` to each of ``exits``
    that is reachable.  With ``trailing``, turns may be inserted after the last
    one; without, the audit ends with a turn's own letter (so that blocks join
    up in one way)."""
    agenda = [(0, "", 0, entry, False, "")]
    final: set[tuple[int, str, bool]] = set()
    found: dict[str, Derivation] = {}
    n = len(turns)
    while agenda and len(found) < len(exits):
        cost, audit, i, state, inserted, roles = heapq.heappop(agenda)
        if (i, state, inserted) in final:
            continue
        final.add((i, state, inserted))
        if i == n and state in exits and state not in found and (trailing or not inserted):
            found[state] = Derivation(cost, audit, roles)
        nexts = FOLLOWS[state]
        if i < n or trailing:
            for x in nexts:
                if x in ROLE:
                    heapq.heappush(agenda, (cost + INSERT, audit + "I", i, x, True, roles + x.upper()))
        if i == n:
            continue
        initial, fault = turns[i]
        heapq.heappush(agenda, (cost + DELETE, audit + "D", i + 1, state, False, roles + "."))
        if fault in ("blank", "duplicate"):
            continue
        more = TRUNCATED if fault else 0
        for x in nexts:
            if x == initial:
                heapq.heappush(agenda, (cost + KEEP + more, audit + "K", i + 1, x, False, roles + x))
            if x in ROLE:
                heapq.heappush(agenda, (cost + REROLE + more, audit + "R", i + 1, x, False, roles + x))
    return found


def whole(turns: list[Turn]) -> Derivation:
    """The lightest derivation of a whole conversation."""
    return min(lightest(turns, "-", "-a", True).values(), key=lambda d: d[:2])


def rebuilt(roles: list[str], texts: list[str], d: Derivation) -> list[tuple[str, str]]:
    """The turns that a derivation leaves, as (role, text)."""
    out, i, at = [], 0, 0
    for letter in d.audit:
        given = d.roles[at]
        at += 1
        if letter == "I":
            out.append((ROLE[given.lower()], ""))
            continue
        if letter != "D":
            out.append((ROLE[given] if letter == "R" else roles[i], texts[i]))
        i += 1
    return out


# ---- rows


def faults(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text, at) with the first fault of each row.

    A duplicate's first row is the least of its group by turn and place, taken
    by partial aggregates, so that a turn which repeats without end is not
    gathered."""
    digest = F.struct("conv_id", "role", F.md5(F.col("text").cast("binary")).alias("md5"))
    rows = turns.withColumn("same", digest).withColumn("order", F.struct("turn", "at"))
    first = rows.groupBy("same").agg(F.min("order").alias("first"))
    rows = rows.join(first, rows["same"].eqNullSafe(first["same"])).select(*turns.columns, "order", "first")
    text = F.col("text")
    return rows.select(
        *turns.columns,
        F.when(~text.rlike(BLANK_RE), "blank").when(F.col("order") != F.col("first"), "duplicate").when(~text.rlike(LAST_RE), "truncated").alias("fault"),
    )


_ITEM = pa.struct([("entry", pa.string()), ("exit", pa.string()), ("cost", pa.int64()), ("audit", pa.string()), ("roles", pa.string())])
_TURN = pa.struct([("role", pa.string()), ("text", pa.string())])
_BLOCK = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("part", pa.int64()),
        ("seq", pa.int64()),
        ("whole", pa.bool_()),
        ("first", pa.string()),
        ("last", pa.string()),
        ("illegal", pa.int64()),
        ("items", pa.list_(_ITEM)),
        ("turns", pa.list_(_TURN)),
    ]
)
_BLOCK_DDL = (
    "part long, seq long, whole boolean, first string, last string, illegal long, "
    "items array<struct<entry: string, exit: string, cost: long, audit: string, roles: string>>, turns array<struct<role: string, text: string>>"
)
#: Adjacent initials that are no fault.
LEGAL = ("su", "ua", "au")


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


def _cut(batches: Iterator[pa.RecordBatch], block_turns: int) -> Iterator[tuple[object, bool, bool, list]]:
    """(conv_id, begins here, ends here, rows) of each block of sorted rows; a
    conversation may go on beyond either end of the partition."""
    held, chars, conv, begun, first = [], 0, None, False, True
    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in range(4)]
        for row in zip(*columns):
            if held and row[0] != conv:
                yield conv, not begun and not first, True, held
                held, chars, begun, first = [], 0, False, False
            elif len(held) >= block_turns or (held and chars + len(row[2]) > BLOCK_CHARS):
                yield conv, not begun and not first, False, held
                held, chars, begun = [], 0, True
            conv = row[0]
            held.append(row)
            chars += len(row[2])
    if held:
        yield conv, not begun and not first, False, held


def _blocks(rows: DataFrame, block_turns: int) -> DataFrame:
    """The blocks of all conversations, with their items: of a conversation that
    is one block and surely whole the goal alone, else of every entry and exit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        out: list[dict] = []
        for seq, (conv, begins, ends, held) in enumerate(_cut(batches, block_turns)):
            turns = [Turn(role[:1], fault) for _, role, _, fault in held]
            if begins and ends:
                items = [{"entry": "-", "exit": "a", **whole(turns)._asdict()}]
            else:
                items = [{"entry": a, "exit": b, **d._asdict()} for a in STATES for b, d in lightest(turns, a, STATES, False).items()]
            initials = [t.initial for t in turns]
            texts = [{"role": role, "text": text} for _, role, text, _ in held]
            out.append(dict(zip(_BLOCK.names, (conv, part, seq, begins and ends, initials[0], initials[-1], _illegal(initials), items, texts))))
            if len(out) >= 512 or len(held) > 64:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    kind = rows.schema["conv_id"].dataType
    schema = _BLOCK.set(0, pa.field("conv_id", pa.string() if kind.typeName() == "string" else pa.int64()))
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "at")]
    n = rows.sparkSession.conf.get("spark.sql.shuffle.partitions")
    dealt = rows.repartitionByRange(int(n), *order).sortWithinPartitions(*order)
    return dealt.select("conv_id", "role", "text", "fault").mapInArrow(run, f"conv_id {kind.simpleString()}, {_BLOCK_DDL}")


class _Joined:
    """Derivations of the blocks of a conversation read so far, by exit."""

    def __init__(self) -> None:
        # exit -> (cost, rank of the audit among those of the other exits)
        self.best: dict[str, tuple[int, int]] = {"-": (0, 0)}
        self.came: list[dict[str, str]] = []

    def add(self, items: list[dict]) -> None:
        """The edge that joins an item of the block to each of the conversation's,
        lightest first.  Audits that differ do so at one place for good, so
        their rank stands for them."""
        agenda = []
        for x in items:
            if x["entry"] in self.best:
                cost, rank = self.best[x["entry"]]
                heapq.heappush(agenda, (cost + x["cost"], rank, x["audit"], x["exit"], x["entry"]))
        final: dict[str, tuple[int, int, str, str]] = {}
        while agenda:
            cost, rank, audit, leave, entry = heapq.heappop(agenda)
            if leave not in final:
                final[leave] = (cost, rank, audit, entry)
        ranks = {k: i for i, k in enumerate(sorted({(r, a) for _, r, a, _ in final.values()}))}
        self.best = {leave: (cost, ranks[rank, audit]) for leave, (cost, rank, audit, _) in final.items()}
        self.came.append({leave: entry for leave, (_, _, _, entry) in final.items()})

    def end(self) -> tuple[str, str, list[str]]:
        """(turns inserted at the end, their audit, the exit of every block)."""
        tails = {"-": "", "a": "", "u": "A", "s": "UA"}
        _, _, _, leave = min((cost + INSERT * len(tails[x]), rank, "I" * len(tails[x]), x) for x, (cost, rank) in self.best.items())
        path = [leave]
        for came in reversed(self.came):
            path.append(came[path[-1]])
        return tails[leave], "I" * len(tails[leave]), path[::-1]


_CHOSEN = "conv_id {kind}, part long, seq long, entry string, exit string, tail string"


def _choose(blocks: DataFrame) -> DataFrame:
    """For each block of the long conversations, the item that the lightest
    derivation takes.  One conversation's blocks stream through a task in order;
    it holds four values, and four letters a block."""
    kind = blocks.schema["conv_id"].dataType
    key = pa.string() if kind.typeName() == "string" else pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, joined, at = None, None, []

        def done() -> pa.RecordBatch:
            tail, _, path = joined.end()
            n = len(at)
            return pa.RecordBatch.from_arrays(
                [pa.array([conv] * n, key), pa.array([x[0] for x in at], pa.int64()), pa.array([x[1] for x in at], pa.int64()), pa.array(path[:-1]), pa.array(path[1:]), pa.array([""] * (n - 1) + [tail])],
                names=["conv_id", "part", "seq", "entry", "exit", "tail"],
            )

        for batch in batches:
            for row in batch.to_pylist():
                if joined is None or row["conv_id"] != conv:
                    if joined is not None:
                        yield done()
                    conv, joined, at = row["conv_id"], _Joined(), []
                joined.add(row["items"])
                at.append((row["part"], row["seq"]))
        if joined is not None:
            yield done()

    order = ["conv_id", "part", "seq"]
    rows = blocks.select(*order, "items").repartition("conv_id").sortWithinPartitions(*order)
    return rows.mapInArrow(run, _CHOSEN.format(kind=kind.simpleString()))


def repair_turns(turns: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """``repair_faulty`` of turns (conv_id, turn, role, text, at) without their faults."""
    return repair_faulty(written(faults(turns), "faults"), block_turns)


def repair_faulty(rows: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """The repaired conversations, in blocks: conv_id, part and seq (the order of
    a conversation's blocks), whole (it is the only one), first, last and illegal
    (initials before the repair), cost, audit, and turns (role, text) as repaired.

    ``rows`` has conv_id (long or string), turn, role, text (not null), at (what
    breaks ties of turn) and fault.  A conversation that has no row has no block.
    """
    ship_package(rows.sparkSession)
    blocks = written(_blocks(rows, block_turns), "blocks")
    short = blocks.where("whole").select("*", F.get("items", F.lit(0)).alias("item"), F.lit("").alias("tail"))
    long = blocks.where("not whole")
    chosen = _choose(long)
    same = [long[c].eqNullSafe(chosen[c]) for c in ("conv_id", "part", "seq")]
    taken = F.filter("items", lambda x: (x["entry"] == chosen["entry"]) & (x["exit"] == chosen["exit"]))
    joined = long.join(chosen, same[0] & same[1] & same[2]).select(*[long[c] for c in blocks.columns], F.get(taken, F.lit(0)).alias("item"), chosen["tail"])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                out = []
                for row in batch.slice(k, 64).to_pylist():
                    item, tail = row["item"], row["tail"]
                    d = Derivation(item["cost"] + INSERT * len(tail), item["audit"] + "I" * len(tail), item["roles"] + tail)
                    kept = rebuilt([t["role"] for t in row["turns"]], [t["text"] for t in row["turns"]], d)
                    row |= {"cost": d.cost, "audit": d.audit, "turns": [{"role": a, "text": b} for a, b in kept]}
                    out.append({c: row[c] for c in names})
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema([batch.schema.field(0), *fields]))

    names = ["conv_id", "part", "seq", "whole", "first", "last", "illegal", "cost", "audit", "turns"]
    fields = [*[_BLOCK.field(c) for c in names[1:7]], pa.field("cost", pa.int64()), pa.field("audit", pa.string()), _BLOCK.field("turns")]
    kind = rows.schema["conv_id"].dataType.simpleString()
    ddl = f"conv_id {kind}, part long, seq long, whole boolean, first string, last string, illegal long, cost long, audit string, turns array<struct<role: string, text: string>>"
    return short.unionByName(joined).select("conv_id", "part", "seq", "whole", "first", "last", "illegal", "turns", "item", "tail").mapInArrow(apply, ddl)


# ---- the query's own: damage and digest


def damage(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, at) after the damage that the checksum of
    ``conv_id:turn`` says.  A null role or text, and a null in the checksum's
    text, is one space; ties of turn go by role, text and place."""

    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    what = (F.crc32(F.concat_ws(":", shown("conv_id"), shown("turn")).cast("binary")) % 20).cast("int")
    rows = turns.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), what.alias("what"), F.monotonically_increasing_id().alias("id"))
    rows = rows.where("what <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("what") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("what") == 1, "").when(F.col("what") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        "role",
        "text",
        "id",
        F.explode(F.when(F.col("what") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).toDF("conv_id", "turn", "role", "text", "old_role", "old_text", "id", "copy")
    # long texts do not travel as sort keys
    at = F.struct(F.col("old_role").alias("role"), F.left("old_text", F.lit(64)).alias("head"), F.md5(F.col("old_text").cast("binary")).alias("md5"), "id", "copy")
    return rows.select("conv_id", "turn", "role", "text", at.alias("at"))


def _digests(blocks: DataFrame) -> DataFrame:
    """(conv_id, cost, audit, repaired_sha256, illegal) of conversations of
    several blocks, which stream through a task in order."""
    kind = blocks.schema["conv_id"].dataType
    key = pa.string() if kind.typeName() == "string" else pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}

        def done() -> pa.RecordBatch:
            out = [held["conv_id"], held["cost"], "".join(held["audit"]), held["sha"].hexdigest(), held["illegal"]]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(out, (key, pa.int64(), pa.string(), pa.string(), pa.int64()))], names=["conv_id", "cost", "audit", "repaired_sha256", "illegal"])

        for batch in batches:
            for k in range(0, batch.num_rows, 16):
                for row in batch.slice(k, 16).to_pylist():
                    if not held or row["conv_id"] != held["conv_id"]:
                        if held:
                            yield done()
                        held = {"conv_id": row["conv_id"], "cost": 0, "audit": [], "sha": hashlib.sha256(), "illegal": 0, "last": None, "any": False}
                    held["cost"] += row["cost"]
                    held["audit"].append(row["audit"])
                    held["illegal"] += row["illegal"] + (held["last"] is not None and held["last"] + row["first"] not in LEGAL)
                    held["last"] = row["last"]
                    for t in row["turns"]:
                        held["sha"].update((("\n" if held["any"] else "") + f"{t['role']}:{t['text']}").encode())
                        held["any"] = True
        if held:
            yield done()

    order = ["conv_id", "part", "seq"]
    return blocks.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(run, f"conv_id {kind.simpleString()}, cost long, audit string, repaired_sha256 string, illegal long")


def repair_damaged(turns: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """Damage, repair and digest of every conversation of ``turns`` (conv_id,
    turn, role, text): conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256.

    Nulls of role and text are one space, a null conv_id is a conversation of its
    own, null turns come first and count in no gap, rows that repeat are
    duplicates.  A conversation without rows after the damage has zeros, an empty
    audit and the digest of an empty string; an empty table gives no rows.  Other
    columns are not read.
    """
    rows = written(faults(damage(turns.select("conv_id", "turn", "role", "text"))), "faults")
    repaired = written(repair_faulty(rows, block_turns), "repaired")
    said = F.array_join(F.transform("turns", lambda t: F.concat_ws(":", t["role"], t["text"])), "\n")
    one = repaired.where("whole").select("conv_id", "cost", "audit", F.sha2(said.cast("binary"), 256).alias("repaired_sha256"), "illegal")
    digests = one.unionByName(_digests(repaired.where("not whole"))).withColumnRenamed("conv_id", "id")
    stats = rows.groupBy(F.col("conv_id").alias("gid")).agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.count_if(F.col("fault") == c).alias(c) for c in ("blank", "duplicate", "truncated")],
    )
    base = turns.select("conv_id").distinct()
    out = base.join(stats, F.col("conv_id").eqNullSafe(F.col("gid")), "left").join(digests, F.col("conv_id").eqNullSafe(F.col("id")), "left")
    zero = F.lit(0).cast("long")
    return out.select(
        "conv_id",
        *[F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
