"""Chat formatting by multi-party perspective rotation.

For every participant of a dialogue the dialogue is rendered once with that
speaker as the assistant and everybody else as a named user.  The loss mask
covers what the assistant of that rendering says (text and end marker).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURNS_PER_BLOCK = 64
SYSTEM = "system"
UNKNOWN = "unknown"
END = "<|end|>\n"


KEY = ["conv", "no_conv", "tb"]


def _keyed(turns: DataFrame, per_block: int) -> DataFrame:
    """Turns with their dialogue (never null) and tb, the run of ``per_block``
    turn numbers they fall into."""
    return turns.select(
        "conv_id",
        F.coalesce(F.col("conv_id"), F.lit(0)).alias("conv"),
        F.col("conv_id").isNull().alias("no_conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.floor(F.col("turn") / F.lit(per_block)).cast("long"), F.lit(-(2**62))).alias("tb"),
        F.when(F.coalesce(F.col("role"), F.lit("")) == "", UNKNOWN).otherwise(F.col("role")).alias("role"),
        ((F.coalesce(F.col("role"), F.lit("")) != "") & (F.col("role") != SYSTEM)).alias("speaks"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )


def _blocks(t: DataFrame, per_block: int) -> DataFrame:
    """(dialogue, tb, rb) -> ordered turns, at most ``per_block`` of them: rb
    splits a run further where turn numbers repeat, so a dialogue of any length
    never meets in one row.  This is the only shuffle of the texts."""
    place = F.row_number().over(Window.partitionBy(*KEY).orderBy(F.col("turn").asc_nulls_first(), "role", "text")) - 1
    t = t.withColumn("place", place).withColumn("rb", F.floor(F.col("place") / per_block).cast("long"))
    return t.groupBy(*KEY, "conv_id", "rb").agg(F.sort_array(F.collect_list(F.struct("place", "role", "text"))).alias("turns"))


def _starts(t: DataFrame, per_block: int) -> DataFrame:
    """(dialogue, tb, speaker, chars_before, blocks_before): where a run of
    turns starts in each speaker's rendering.  Lengths and counts by role are
    enough, so no text moves."""
    by_role = t.groupBy(*KEY, "role", "speaks").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))
    run = by_role.groupBy(*KEY).agg(F.collect_list(F.struct("role", "n", "chars")).alias("roles"), F.sum("n").alias("n"))
    speakers = by_role.where("speaks").select("conv", "no_conv", F.col("role").alias("speaker")).distinct()

    def size(acc: Column, r: Column) -> Column:
        head, _ = _segment(F.struct(r["role"].alias("role"), F.lit("").alias("text")), F.col("speaker"))
        return acc + r["chars"] + r["n"] * (F.length(head) + F.lit(len(END)))

    both = run.join(speakers, ["conv", "no_conv"])
    sized = both.select(*KEY, "speaker", F.aggregate("roles", F.lit(0).cast("long"), size).alias("size"), F.ceil(F.col("n") / per_block).alias("blocks"))
    before = Window.partitionBy("conv", "no_conv", "speaker").orderBy("tb").rowsBetween(Window.unboundedPreceding, -1)
    return sized.select(
        *KEY, "speaker",
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("chars_before"),
        F.coalesce(F.sum("blocks").over(before), F.lit(0)).alias("blocks_before"),
    )


def _segment(turn: Column, speaker: Column) -> tuple[Column, Column]:
    """Head and body of one turn as ``speaker`` sees it."""
    head = (
        F.when(turn["role"] == speaker, F.lit("<|assistant|>\n"))
        .when(turn["role"] == SYSTEM, F.lit("<|system|>\n"))
        .otherwise(F.concat(F.lit("<|user name="), turn["role"], F.lit("|>\n")))
    )
    return head, F.concat(turn["text"], F.lit(END))


def rotate_perspectives(turns: DataFrame, per_block: int = TURNS_PER_BLOCK) -> DataFrame:
    """One row per dialogue, speaker and block of turns.

    conv_id, speaker, block (from 0), start_char (characters of the rendering
    before this block), n_turns, rendered, mask_spans ("from-to" character
    ranges within ``rendered``, comma-joined, the assistant's words and end
    marker) and n_masked (characters under the mask).  The blocks of a speaker,
    joined in order, are the whole dialogue; one of up to ``per_block`` turns
    is one row.

    Turns are ordered by turn number (null first), then role, then text, so
    ties have one order; repeated rows are kept.  A null text is empty.  A null
    or empty role is rendered as user "unknown" and gets no perspective, nor
    does the system role.  A null conv_id is a dialogue of its own.  An empty
    table gives no rows; other columns are not read.
    """
    t = _keyed(turns, per_block)
    both = _blocks(t, per_block).join(_starts(t, per_block), KEY)

    def add(acc: Column, turn: Column) -> Column:
        head, body = _segment(turn, F.col("speaker"))
        begin = acc["n"] + F.length(head)
        end = begin + F.length(body)
        mine = turn["role"] == F.col("speaker")
        span = F.concat_ws("-", begin.cast("string"), end.cast("string"))
        return F.struct(
            end.alias("n"),
            (acc["masked"] + F.when(mine, F.length(body)).otherwise(0)).alias("masked"),
            F.when(mine, F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"),
        )

    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("masked"), F.array().cast("array<string>").alias("spans"))
    state = both.select(
        *KEY, "conv_id", "speaker", "rb", "chars_before", "blocks_before",
        F.size("turns").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: F.concat(*_segment(t, F.col("speaker")))), "").alias("rendered"),
        F.aggregate("turns", zero, add).alias("mask"),
    )
    run = Window.partitionBy(*KEY, "speaker").orderBy("rb")
    here = F.coalesce(F.sum(F.col("mask.n")).over(run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return state.select(
        "conv_id", "speaker",
        (F.col("blocks_before") + F.col("rb")).cast("long").alias("block"),
        (F.col("chars_before") + here).cast("long").alias("start_char"),
        F.col("n_turns").cast("long").alias("n_turns"),
        "rendered",
        F.array_join("mask.spans", ",").alias("mask_spans"),
        F.col("mask.masked").cast("long").alias("n_masked"),
    )
