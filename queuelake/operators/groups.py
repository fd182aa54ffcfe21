"""Message groups: deliver the messages of a group only when all are there.

The second level of completeness above segments: messages of a group share
``group_id`` and are numbered by ``msg_seq`` from 1; ``last_in_group`` marks the
final one.  A message of the group may be cut into segments of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import GROUP_FIELDS, MESSAGE_COLUMNS, MESSAGE_SCHEMA
from .segments import MAX_MESSAGE_BYTES, assemble_segments

# Error codes of groups that can not be delivered.
INCOMPLETE_MESSAGE_GROUP = "INCOMPLETE_MESSAGE_GROUP"
CONFLICTING_MESSAGES = "CONFLICTING_MESSAGES"

_COLUMNS = [*MESSAGE_COLUMNS, *[f.name for f in GROUP_FIELDS], "error"]


def with_group_columns(df: DataFrame) -> DataFrame:
    """The message schema, ``msg_seq``, ``last_in_group`` and ``error``; null
    where ``df`` has no such column."""
    fields = [*MESSAGE_SCHEMA.fields, *GROUP_FIELDS]
    have = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
    error = F.col("error") if "error" in df.columns else F.lit(None).cast("string").alias("error")
    return df.select(*have, error)


def message_group_states(msgs: DataFrame) -> DataFrame:
    """(group_id, error): what becomes of each group, null for a whole one.

    Two partial aggregates over digests: by number, which finds messages that
    were delivered again and such that differ, then by group.  No payload moves.
    """
    facts = F.struct(F.coalesce(F.md5("payload"), F.lit("")).alias("digest"), F.coalesce("last_in_group", F.lit(False)).alias("last"))
    one = msgs.groupBy("group_id", "msg_seq").agg(F.min(facts).alias("a"), F.max(facts).alias("b"), F.max(F.col("error").isNotNull()).alias("bad"))
    g = one.groupBy("group_id").agg(
        F.max(F.col("a") != F.col("b")).alias("conflict"),
        F.max("bad").alias("bad"),
        F.count(F.lit(1)).alias("n"),
        F.min("msg_seq").alias("first"),
        F.max("msg_seq").alias("end"),
        F.count_if(F.col("a.last")).alias("n_last"),
        F.max(F.when(F.col("a.last"), F.col("msg_seq"))).alias("last_at"),
    )
    whole = (F.col("first") == 1) & (F.col("end") == F.col("n")) & (F.col("n_last") == 1) & (F.col("last_at") == F.col("end")) & ~F.col("bad")
    return g.select(
        "group_id",
        F.when(F.col("conflict"), CONFLICTING_MESSAGES)
        .when(F.coalesce(whole, F.lit(False)), F.lit(None))
        .otherwise(INCOMPLETE_MESSAGE_GROUP)
        .alias("group_error"),
    )


def release_groups(df: DataFrame) -> DataFrame:
    """Messages with msg_seq, last_in_group and ``error``.

    Every message of a whole group has a null error; every one of a group with
    gaps, without a last message or with a broken one is a row with
    ``INCOMPLETE_MESSAGE_GROUP``, of a group with different messages at one
    number a row with ``CONFLICTING_MESSAGES`` (an error of its own stays).  A
    message delivered again is one row, of the least put time and id.  Messages
    of no group, or without a number, pass.

    A group is never collected: its rows are dealt by group and number, and the
    decision joins them as one row a group.  ``in_group_order`` sorts them.
    """
    df = with_group_columns(df)
    grouped = F.col("group_id").isNotNull() & F.col("msg_seq").isNotNull()
    msgs = df.where(grouped)
    judged = msgs.join(message_group_states(msgs).withColumnRenamed("group_id", "of"), F.col("group_id") == F.col("of")).drop("of")
    rest = [c for c in _COLUMNS if c not in ("group_id", "msg_seq", "put_ts", "msg_id")]
    same = ["group_id", "msg_seq", "group_error", F.md5("payload"), "last_in_group", "error"]
    out = judged.groupBy(*same).agg(F.min(F.struct("put_ts", "msg_id", *rest)).alias("m")).select("group_id", "msg_seq", "group_error", "m.*")
    return df.where(~grouped).unionByName(out.withColumn("error", F.coalesce("error", "group_error")).select(*_COLUMNS))


def complete_messages(df: DataFrame, max_message_bytes: int = MAX_MESSAGE_BYTES) -> DataFrame:
    """Only complete logical messages, of complete groups: segments are joined
    up by ``(group_id, msg_seq)`` first (``assemble_segments``), then groups are
    released.  A message whose segments are not complete is an error row, and so
    is every other message of its group."""
    df = with_group_columns(df)
    key = F.concat_ws("/", "group_id", F.coalesce(F.col("msg_seq").cast("string"), F.lit("")))
    cut = df.drop("error").withColumn("of_group", F.col("group_id")).withColumn("group_id", F.when(F.col("seg_offset").isNotNull(), key))
    whole = assemble_segments(cut, max_message_bytes).withColumn("group_id", F.col("of_group"))
    return release_groups(whole)


def in_group_order(df: DataFrame) -> DataFrame:
    """Rows dealt by ranges of (group, number) and sorted: a group's messages
    follow each other, over several partitions where it is large."""
    order = [F.asc_nulls_first("group_id"), F.asc_nulls_first("msg_seq")]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)
