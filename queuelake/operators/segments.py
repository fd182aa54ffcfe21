"""Reassembly of segmented messages (deliver only complete logical messages).

Segments of one logical message share ``group_id``; ``seg_offset`` is the
byte offset of the segment in the message and ``last_segment`` marks the
final one.  Unsegmented messages (``group_id`` null) pass through without a
shuffle; only segmented ones are grouped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import MESSAGE_COLUMNS, MESSAGE_SCHEMA

# Error codes of groups that can not be delivered.
INCOMPLETE_GROUP = "INCOMPLETE_GROUP"
CONFLICTING_SEGMENTS = "CONFLICTING_SEGMENTS"
GROUP_TOO_LARGE = "GROUP_TOO_LARGE"

# A value of one row has to fit a JVM array, twice as hexadecimal text.  Larger
# groups come out segment by segment, as error rows.
MAX_MESSAGE_BYTES = 512 * 1024 * 1024


def concat_binary(segs, field: str = "payload"):
    """Concatenate the binary ``field`` of an array of structs in linear time."""
    return F.unhex(F.array_join(F.transform(segs, lambda x: F.coalesce(F.hex(x[field]), F.lit(""))), ""))


def _hash_sum(value: Column) -> Column:
    return F.coalesce(F.sum(F.xxhash64(value).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))


def group_states(seg: DataFrame, max_message_bytes: int) -> DataFrame:
    """(group_id, error): what becomes of each group, null for a message.

    Decided on offsets, lengths, digests and last marks alone, by partial
    aggregates; no payload moves and no group is collected.  Segments that were
    delivered again count once.  A group is complete when the segments that
    start after 0 start where the others end (compared as sums of hashes), its
    first starts at 0, and its only last one ends last.
    """
    facts = F.struct(
        F.coalesce(F.octet_length("payload"), F.lit(0)).cast("long").alias("len"),
        F.coalesce("last_segment", F.lit(False)).alias("last"),
        F.coalesce(F.md5("payload"), F.lit("")).alias("digest"),
    )
    offset = F.coalesce(F.col("seg_offset"), F.lit(-1)).cast("long")
    one = seg.groupBy("group_id", offset.alias("at")).agg(F.min(facts).alias("a"), F.max(facts).alias("b"))
    end = F.col("at") + F.col("a.len")
    g = one.groupBy("group_id").agg(
        F.max(F.col("a") != F.col("b")).alias("conflict"),
        F.sum("a.len").alias("total"),
        F.min("at").alias("first"),
        F.max(end).alias("end"),
        F.sum(F.col("a.last").cast("int")).alias("n_last"),
        F.max(F.when(F.col("a.last"), end)).alias("last_end"),
        F.coalesce(F.sum(F.when(F.col("at") != 0, F.xxhash64("at").cast("decimal(38,0)"))), F.lit(0)).alias("starts"),
        _hash_sum(end).alias("ends"),
    )
    joined_up = F.col("starts") == F.col("ends") - F.xxhash64("end").cast("decimal(38,0)")
    whole = (F.col("first") == 0) & (F.col("n_last") == 1) & (F.col("last_end") == F.col("end")) & (F.col("total") == F.col("end")) & joined_up
    return g.select(
        "group_id",
        F.when(F.col("conflict"), CONFLICTING_SEGMENTS)
        .when(F.col("total") > max_message_bytes, GROUP_TOO_LARGE)
        .when(F.coalesce(whole, F.lit(False)), F.lit(None))
        .otherwise(INCOMPLETE_GROUP)
        .alias("error"),
    )


def assemble_segments(df: DataFrame, max_message_bytes: int = MAX_MESSAGE_BYTES) -> DataFrame:
    """Logical messages in the message schema, with ``error``.

    Nothing is left out: a complete group is one row with a null error; a group
    that is not complete is one row with what arrived and ``INCOMPLETE_GROUP``;
    a group with different bytes at one offset (``CONFLICTING_SEGMENTS``), or
    more bytes than a row can hold (``GROUP_TOO_LARGE``), comes out segment by
    segment and is never collected.  Segments delivered again are taken once,
    whatever their other columns (those of the least put time and id are kept).

    One shuffle of small facts decides; one shuffle of the payloads by
    ``group_id`` assembles, and holds one message at a time.
    """
    other = [c for c in df.columns if c not in MESSAGE_COLUMNS]
    df = df.select(
        *[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in MESSAGE_SCHEMA.fields],
        *other,
    )
    no_error = F.lit(None).cast("string").alias("error")
    plain = df.where(F.col("group_id").isNull()).select(*MESSAGE_COLUMNS, *other, no_error)
    seg = df.where(F.col("group_id").isNotNull())
    seg = seg.join(group_states(seg, max_message_bytes), "group_id")
    apart = F.coalesce(F.col("error").isin(CONFLICTING_SEGMENTS, GROUP_TOO_LARGE), F.lit(False))
    alone = seg.where(apart).select(*MESSAGE_COLUMNS, *other, "error")
    fields = ["put_ts", "msg_id", "msg_type", "correl_id", "last_segment", "payload", *other]
    once = seg.where(~apart).groupBy("group_id", "error", "seg_offset").agg(F.min(F.struct(*fields)).alias("s"))
    grouped = once.groupBy("group_id", "error").agg(F.array_sort(F.collect_list(F.struct("seg_offset", "s"))).alias("segs"))
    segs = F.transform("segs", lambda x: x["s"])
    first = F.get(F.col("segs"), 0)["s"]
    out = grouped.select(
        first["msg_id"].alias("msg_id"),
        first["msg_type"].alias("msg_type"),
        first["correl_id"].alias("correl_id"),
        F.col("group_id"),
        F.lit(None).cast("int").alias("seg_offset"),
        F.lit(None).cast("boolean").alias("last_segment"),
        first["put_ts"].alias("put_ts"),
        concat_binary(segs).alias("payload"),
        *[first[c].alias(c) for c in other],
        F.col("error"),
    )
    return plain.unionByName(out).unionByName(alone)
