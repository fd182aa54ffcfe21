"""XML documents larger than a row: files read in pieces, a record per element.

Spark's text source cuts every file at the end tag of the split element, so a
file is read by as many tasks as it has blocks and no row holds more than what
stands between two end tags.  A second look at the same pieces gives each file's
facts (header blocks, errors) by partial aggregates; they join back by file, with
no hint: small facts are broadcast, else the join splits a hot file (AQE).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import xml as xx

# Fixed value: the pieces of a file do not add up to its length (a compressed file).
LENGTH_MISMATCH = "LENGTH_MISMATCH"


def _first(value: Column, at: Column) -> Column:
    """The first one found, with whether it is masked."""
    return F.min_by(F.struct(value.alias("v"), "masked"), F.when(value != "", at))


def _unmask(value: Column, masked: Column) -> Column:
    return F.when(masked, xx.unmask(value)).otherwise(value)


def read_xml_files(
    spark: SparkSession, path: str, split: str, headers: Sequence[str] | str | None = None, layout: str = "lines", glob: str | None = None
) -> DataFrame:
    """The records that ``split_xml`` gives for each file below ``path`` as one
    message: ``file``, ``block``, ``seq``, ``value`` (UTF-8 bytes), ``error``.

    Records of a file are in order of ``block`` (the offset of the read that found
    them) and ``seq``; no numbering from 0, which would gather a file in one task.
    A file with an error gives one row with a null value, block and seq: the codes
    of ``split_xml``, or ``LENGTH_MISMATCH``.  A comment, CDATA section or
    instruction that holds the split's end tag is ``UNCLOSED_SPAN``.  A header
    block must lie between two end tags of the split (as before the first), else
    it is ``HEADER_MISSING``.  Files are plain UTF-8 text; empty ones give nothing.
    """
    if layout not in ("lines", "raw"):
        raise ValueError("layout must be 'lines' or 'raw'")
    headers = [h.strip() for h in headers.split(",") if h.strip()] if isinstance(headers, str) else list(headers or [])
    if len(set(headers)) != len(headers):
        raise ValueError(f"duplicate header block names in {headers}")
    lines, end, open_re = layout == "lines", xx.end_tag(split), xx.open_tag_regex(split)
    reader = spark.read.option("lineSep", end).option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    pieces = reader.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), F.col("_metadata.file_size").alias("size"),
        F.octet_length("value").alias("bytes"), (xx.normalize_newlines(F.col("value")) if lines else F.col("value")).alias("text"),
    )
    t, found = F.col("text"), F.col("spans")
    pieces = pieces.withColumn("masked", xx.has_spans(t)).withColumn("spans", F.when(F.col("masked"), xx.spans(t)))
    pieces = pieces.withColumns({
        "unfit": F.when(F.col("masked"), xx.span_error(t, found)),
        "text": F.when(F.col("masked"), xx.mask_spans(t, found)).otherwise(t),
    })
    pieces = pieces.withColumn("opens", F.regexp_count(t, F.lit(open_re)))

    at = F.struct("block", "seq")
    heads = [_first(F.regexp_extract(t, xx.element_regex(h, keep_indent=lines), 0), at).alias(f"h{i}") for i, h in enumerate(headers)]
    facts = pieces.groupBy("file").agg(
        F.max("size").alias("size"), F.sum(F.col("bytes") + len(end.encode())).alias("total"), F.max_by("opens", at).alias("last"),
        F.count_if(F.col("opens") == 0).alias("empty"), F.count_if(F.col("opens") > 1).alias("nested"),
        F.max("unfit").alias("unfit"), (~F.max(t.contains("\n"))).alias("single"), *heads,
    )
    # a file that does not end at an end tag has a tail, its last piece
    tail = F.col("total") == F.col("size") + len(end.encode())
    missing = F.lit(False)
    for i in range(len(headers)):
        missing = missing | (F.coalesce(F.col(f"h{i}.v"), F.lit("")) == "")
    error = (
        F.when(~tail & (F.col("total") != F.col("size")), F.lit(LENGTH_MISMATCH))
        .when(F.col("unfit").isNotNull(), F.col("unfit"))
        .when(missing, F.lit(xx.HEADER_MISSING))
        .when(F.col("nested") > F.when(tail & (F.col("last") > 1), 1).otherwise(0), F.lit(xx.NESTED_SPLIT))
        .when(tail & (F.col("last") > 0), F.lit(xx.UNCLOSED_SPLIT))
        .when(F.col("empty") > F.when(tail & (F.col("last") == 0), 1).otherwise(0), F.lit(xx.UNMATCHED_END))
    )

    def fmt(x: Column) -> Column:
        return xx.line_layout(x, F.col("single")) if lines else x

    header = F.concat(F.lit("<root>"), *[F.concat(_unmask(fmt(F.col(f"h{i}.v")), F.col(f"h{i}.masked")), F.lit("\n" if lines else "")) for i in range(len(headers))])
    facts = facts.select("file", "single", error.alias("error"), header.alias("header"))
    # a piece goes on where the one before ended, so it does not begin a line
    whole = F.concat(F.lit(">"), t, F.lit(end))
    records = pieces.where(F.col("opens") > 0).select(
        "file", "block", "seq", "masked", F.regexp_extract(whole, xx.element_regex(split, keep_indent=lines), 0).alias("element")
    )
    value = _unmask(fmt(F.col("element")), F.col("masked"))
    if headers:
        value = F.concat("header", value, F.lit("</root>"))
    good = records.join(facts.where("error is null"), "file").select("file", "block", "seq", value.cast("binary").alias("value"), F.lit(None).cast("string").alias("error"))
    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in (("block", "long"), ("seq", "long"), ("value", "binary"))]
    return good.unionByName(facts.where("error is not null").select("file", *nothing, "error"))


__all__ = ["read_xml_files", "LENGTH_MISMATCH"]
