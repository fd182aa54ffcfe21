"""Record splitters: one message payload -> 0..n records.

Every splitter is a ``DataFrame -> DataFrame`` transform with one contract:
the input has a binary payload column (``payload`` by default); the output
keeps the input's other columns, drops the payload and adds ``pos int``,
``value binary`` and ``error string``.

* a good message gives one row per record, ``pos`` 0..n-1, ``error`` null;
* a message that cannot be split gives exactly one row with ``pos`` null,
  ``value`` = the whole payload and ``error`` set, so the whole message can be
  routed to a dead-letter queue (see ``operators.routing``).

Built-in splitters are native Spark expressions: a projection finds the
records of each message (regex, JSON or line split), one ``posexplode``
generates the rows, and a second projection formats each record.  Both
projections run under whole-stage codegen; the payload is not copied into
every record row (only failed messages carry it), so a message with many
records costs linear, not quadratic, memory traffic.  No shuffle, no Python.
"""

from __future__ import annotations

from typing import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import json as jx
from ..functions import xml as xx
from ..functions.text import decode_payload, encode_text, split_lines_expr
from ..schema import FIXED_WIDTH_FORMAT, JSON_FORMAT, XML_FORMAT

_OUT = ("pos", "value", "error")
_TMP = "__ql_"

# Error codes of any splitter.
NULL_PAYLOAD = "NULL_PAYLOAD"
# The records of a custom splitter: none at all, or a null one among them.
BAD_RECORDS = "BAD_RECORDS"
NULL_RECORD = "NULL_RECORD"


def _kept(df: DataFrame, payload: str) -> list[str]:
    """The columns that a splitter hands on.  One that its own would replace
    raises: nothing is dropped in silence."""
    clash = [c for c in df.columns if c in _OUT and c != payload]
    if clash:
        raise ValueError(f"rename {clash} before splitting: the splitter's own columns are {list(_OUT)}")
    return [c for c in df.columns if c != payload and not c.startswith(_TMP)]


def _emit(
    df: DataFrame,
    records: Column,
    error: Column,
    payload: str,
    element_type: str = "string",
    finish: Callable[[Column], Column] | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Rows from ``records`` (array of ``element_type``), or one error row.

    ``finish`` maps the exploded element to the record bytes; it may use the
    ``carry`` columns (per-message values such as a formatted header).
    """
    keep = _kept(df, payload)
    staged = df.select(*keep, *carry, payload, records.alias("__ql_r"), error.alias("__ql_e"))
    good = F.col("__ql_e").isNull()
    staged = staged.withColumn("__ql_e", F.when(F.col(payload).isNull(), F.lit(NULL_PAYLOAD)).otherwise(F.col("__ql_e")))
    staged = staged.select(*keep, *carry, "__ql_r", "__ql_e", F.when(~good, F.col(payload)).alias("__ql_bad"))
    gen = F.when(good, F.col("__ql_r")).otherwise(F.array(F.lit(None).cast(element_type)))
    # posexplode_outer + a filter on the generated position instead of plain
    # posexplode: for a non-outer explode the optimizer infers a
    # ``size(array) > 0`` filter and pushes it below the projection, which
    # re-evaluates the whole split expression (regex, JSON parse) twice more.
    ex = staged.select(*keep, *carry, F.posexplode_outer(gen).alias("__ql_p", "__ql_x"), "__ql_e", "__ql_bad")
    ex = ex.where(F.col("__ql_p").isNotNull())
    x = F.col("__ql_x")
    value = finish(x) if finish is not None else x
    # The record of a failed message is null.  The error reads it, so a filter
    # on the error stays above the generator instead of running the split again.
    failed = x.isNull()
    return ex.select(
        *keep,
        F.when(~failed, F.col("__ql_p")).cast("int").alias("pos"),
        F.when(failed, F.col("__ql_bad")).otherwise(value.cast("binary")).alias("value"),
        F.when(failed, F.coalesce(F.col("__ql_e"), F.lit(NULL_RECORD))).alias("error"),
    )


def _no_error() -> Column:
    return F.lit(None).cast("string")


def split_lines(df: DataFrame, payload: str = "payload", encoding: str = "UTF-8") -> DataFrame:
    """``FIXED_WIDTH``: one record per line, re-encoded in ``encoding``."""
    return _emit(
        df,
        split_lines_expr(F.col(payload), encoding),
        _no_error(),
        payload,
        finish=lambda x: encode_text(x, encoding),
    )


def split_json(df: DataFrame, split: str | None = None, payload: str = "payload", encoding: str = "UTF-8") -> DataFrame:
    """``JSON``: the whole document as one record, or with ``split`` one record
    per element of the array under key ``split``, which must be the object's
    first key.  Records are cut from the payload: numbers and strings stay as
    they are written, white space between tokens goes.  Scalar elements keep
    their JSON form (``"1"``, ``1``, ``null``).

    Errors (whole message): ``BAD_JSON``, also for single quotes and more than
    ``functions.json.MAX_DEPTH`` levels; ``TRAILING_DATA`` when more follows the
    first value; with ``split`` also ``NOT_OBJECT``, ``SPLIT_KEY_NOT_FIRST``,
    ``DUPLICATE_KEY`` and ``NOT_ARRAY``."""
    staged = df.withColumn("__ql_text", decode_payload(F.col(payload), encoding))
    t = F.col("__ql_text")
    blank = F.trim(t) == ""
    none = F.array().cast("array<string>")
    if not split:
        staged = staged.withColumn("__ql_ok", ~blank & jx.is_document(t))
        ok = F.col("__ql_ok")
        records = F.when(blank, none).otherwise(F.array(F.when(ok, jx.minified(t))))
        return _emit(staged, records, F.when(~blank & ~ok, jx.why_not(t)), payload)
    # the slice and the parse are projected once, then records and error read them
    staged = staged.withColumn("__ql_array", jx.first_array(t))
    array = F.col("__ql_array")
    staged = staged.withColumn("__ql_keys", F.when(array != "", F.json_object_keys(t)))
    staged = staged.withColumn("__ql_good", jx.has_one_first_key(F.col("__ql_keys"), split))
    good, keys = F.col("__ql_good"), F.json_object_keys(t)
    error = (
        F.when(blank | good, F.lit(None))
        .when(~jx.is_document(t), jx.why_not(t))
        .when(keys.isNull(), F.lit(jx.NOT_OBJECT))
        .when((F.size(keys) == 0) | (F.get(keys, 0) != F.lit(split)), F.lit(jx.SPLIT_KEY_NOT_FIRST))
        .when(~jx.has_one_first_key(keys, split), F.lit(jx.DUPLICATE_KEY))
        .otherwise(F.lit(jx.NOT_ARRAY))
    )
    return _emit(staged, F.when(blank, none).when(good, jx.elements(array)), error, payload)


def split_xml(
    df: DataFrame,
    split: str | None = None,
    headers: Sequence[str] | str | None = None,
    layout: str = "lines",
    payload: str = "payload",
    encoding: str = "UTF-8",
) -> DataFrame:
    """``XML``: one record per element named ``split``.

    ``headers`` names blocks (e.g. ``header``) copied into every record, which
    is then wrapped as ``<root>header...record</root>``.  ``layout="lines"``
    formats records like a line-by-line reader (tag-per-line, final newline);
    ``layout="raw"`` hands out the element text exactly as in the payload.
    Without ``split`` the whole document is one record (lines layout: line
    ends normalised to ``\\n`` plus a final one).

    Errors (whole message): ``NESTED_SPLIT`` when an element contains another
    element of the same name, ``UNCLOSED_SPLIT`` when a start tag has no end
    tag, ``UNMATCHED_END`` when an end tag has no start tag,
    ``HEADER_MISSING`` when a header block is absent.  What looks like a tag
    inside a comment, CDATA section or processing instruction is text and stays
    as written in the record around it; one that never ends is ``UNCLOSED_SPAN``,
    and U+0001 (no XML character) beside such spans ``ILLEGAL_CHARACTER``.

    ``encoding`` is the payload's charset; records are UTF-8.
    """
    if layout not in ("lines", "raw"):
        raise ValueError("layout must be 'lines' or 'raw'")
    if isinstance(headers, str):
        headers = [h.strip() for h in headers.split(",") if h.strip()]
    headers = list(headers or [])
    if len(set(headers)) != len(headers):
        raise ValueError(f"duplicate header block names in {headers}")
    lines = layout == "lines"
    text = decode_payload(F.col(payload), encoding)
    if lines:
        text = xx.normalize_newlines(text)
    staged = df.withColumn("__ql_text", text)
    t = F.col("__ql_text")
    empty = F.octet_length(F.col(payload)) == 0

    if not split:
        rec = xx.whole_message(t) if lines else t
        records = F.when(empty, F.array().cast("array<string>")).otherwise(F.array(rec))
        return _emit(staged, records, _no_error(), payload)

    open_re = xx.open_tag_regex(split)
    staged = staged.withColumn("__ql_spans", xx.has_spans(t))
    masked = F.col("__ql_spans")
    staged = staged.withColumn("__ql_found", F.when(masked, xx.spans(t)))
    staged = staged.withColumns({
        "__ql_unfit": F.when(masked, xx.span_error(t, F.col("__ql_found"))),
        "__ql_text": F.when(masked, xx.mask_spans(t, F.col("__ql_found"))).otherwise(t),
    })
    carry = ["__ql_spans"]
    staged = staged.withColumn("__ql_tail", xx.after_last_end(t, split))
    tail = F.col("__ql_tail")
    body = xx.up_to_last_end(t, tail)
    if lines:
        staged = staged.withColumn("__ql_single", ~t.contains("\n"))
        carry.append("__ql_single")
        # indentation only exists in multi-line messages: skip that part of
        # the pattern for one-line ones
        found = F.when(
            F.col("__ql_single"), F.regexp_extract_all(body, F.lit(xx.element_regex(split, keep_indent=False)), 0)
        ).otherwise(F.regexp_extract_all(body, F.lit(xx.element_regex(split, keep_indent=True)), 0))
    else:
        found = F.regexp_extract_all(body, F.lit(xx.element_regex(split, keep_indent=False)), 0)
    staged = (
        staged.withColumn("__ql_m", found)
        .withColumn("__ql_nlit", xx.start_tag_upper_bound(t, split))
        .withColumn("__ql_nend", xx.count_literal(t, xx.end_tag(split)))
    )

    def fmt(x: Column) -> Column:
        return xx.line_layout(x, F.col("__ql_single")) if lines else x

    # header blocks: found and formatted once per message, not per record
    hdr_cols = [F.regexp_extract(xx.up_to_last_end(t, xx.after_last_end(t, h)), xx.element_regex(h, keep_indent=lines), 0) for h in headers]
    if hdr_cols:
        staged = staged.select("*", *[c.alias(f"__ql_h{i}") for i, c in enumerate(hdr_cols)])
        hdr_cols = [F.col(f"__ql_h{i}") for i in range(len(hdr_cols))]
        parts: list[Column] = [F.lit("<root>")]
        for hc in hdr_cols:
            parts.append(fmt(hc))
            if lines:
                parts.append(F.lit("\n"))
        staged = staged.withColumn("__ql_hdr", F.concat(*parts))
        carry.append("__ql_hdr")
    m = F.col("__ql_m")
    nested = F.exists(m, lambda x: F.regexp_count(x, F.lit(open_re)) > 1)
    # Every match ends at an end tag and holds at least one start tag.  So a
    # message is good iff #start tags == #matches == #end tags; the literal
    # count of "<tag" bounds the start tags from above, and only when it
    # disagrees do the exact (regex) counts and the nesting check run.
    n_end = F.col("__ql_nend")
    exact_ok = (F.regexp_count(t, F.lit(open_re)) == F.size(m)) & (n_end == F.size(m))
    error = (
        F.when((F.col("__ql_nlit") == F.size(m)) & (n_end == F.size(m)), _no_error())
        .when(exact_ok, _no_error())
        .when(nested, F.lit(xx.NESTED_SPLIT))
        .when(F.regexp_count(tail, F.lit(open_re)) > 0, F.lit(xx.UNCLOSED_SPLIT))
        .otherwise(F.lit(xx.UNMATCHED_END))
    )
    if hdr_cols:
        missing = F.lit(False)
        for hc in hdr_cols:
            missing = missing | (hc == "")
        error = F.when(missing, F.lit(xx.HEADER_MISSING)).otherwise(error)

    error = F.when(F.col("__ql_unfit").isNotNull(), F.col("__ql_unfit")).otherwise(error)

    def record(x: Column) -> Column:
        whole = F.concat(F.col("__ql_hdr"), fmt(x), F.lit("</root>")) if hdr_cols else fmt(x)
        return F.when(masked, xx.unmask(whole)).otherwise(whole)

    return _emit(staged, m, error, payload, finish=record, carry=carry)


# --------------------------------------------------------------------------
# dispatch and the registry of custom splitters

Splitter = Callable[..., DataFrame]

_REGISTRY: dict[str, Splitter] = {}


def register_splitter(name: str, fn: Splitter) -> None:
    """Make ``fn`` available as ``fileFormat=name``.

    ``fn(df, payload="payload", **options)`` must follow the splitter
    contract; ``python_splitter`` builds one from a per-message function.
    """
    _REGISTRY[name.strip().upper()] = fn


def splitter_names() -> list[str]:
    return sorted(_REGISTRY)


def get_splitter(name: str) -> Splitter:
    try:
        return _REGISTRY[(name or XML_FORMAT).strip().upper()]
    except KeyError:
        raise ValueError(f"unknown fileFormat {name!r}; registered: {splitter_names()}") from None


def split_records(df: DataFrame, fileFormat: str = XML_FORMAT, payload: str = "payload", **options) -> DataFrame:
    """Dispatch on ``fileFormat`` (default ``XML``, case-insensitive)."""
    return get_splitter(fileFormat)(df, payload=payload, **options)


def _xml(df: DataFrame, payload: str = "payload", split=None, headers=None, layout="lines", encoding="UTF-8", **_):
    return split_xml(df, split=split, headers=headers, layout=layout, payload=payload, encoding=encoding)


def _json(df: DataFrame, payload: str = "payload", split=None, encoding="UTF-8", **_):
    return split_json(df, split=split, payload=payload, encoding=encoding)


def _lines(df: DataFrame, payload: str = "payload", encoding="UTF-8", **_):
    return split_lines(df, payload=payload, encoding=encoding)


register_splitter(XML_FORMAT, _xml)
register_splitter(JSON_FORMAT, _json)
register_splitter(FIXED_WIDTH_FORMAT, _lines)


def expression_splitter(records: Callable[[Column], Column]) -> Splitter:
    """Wrap a column expression (payload -> array of string or binary records)
    as a splitter: the fast path for formats that Spark's functions can cut.

    A null array of a payload that is not null is one ``BAD_RECORDS`` row, a null
    among the records one ``NULL_RECORD`` row, each with the whole payload."""

    def splitter(df: DataFrame, payload: str = "payload", **_opts) -> DataFrame:
        staged = df.withColumn("__ql_found", records(F.col(payload)))
        found = F.col("__ql_found")
        error = F.when(found.isNull(), BAD_RECORDS).when(F.exists(found, lambda x: x.isNull()), NULL_RECORD)
        return _emit(staged, found, error, payload)

    return splitter


def _python_records(func: Callable[[bytes], Iterable[bytes]], payload: bytes | None):
    """(pos, value, error) of one message: all its records or one error."""
    if payload is None:
        return [(None, None, NULL_PAYLOAD)]
    try:
        records = func(payload)
        if records is None:
            return [(None, payload, BAD_RECORDS)]
        records = list(records)
        if any(r is None for r in records):
            return [(None, payload, NULL_RECORD)]
        return [(j, bytes(r), None) for j, r in enumerate(records)]
    except Exception as exc:  # the whole message becomes one error row
        return [(None, payload, f"{type(exc).__name__}: {exc}")]


def python_splitter(func: Callable[[bytes], Iterable[bytes]], out_rows: int = 65_536) -> Splitter:
    """Wrap a per-message Python function as a splitter (the slow path).

    Runs in ``mapInArrow``: whole Arrow batches cross into Python, the input
    columns are repeated with ``take`` per record, and an exception raised by
    ``func`` becomes that message's error row.  Output batches hold at most
    ``out_rows`` records.  Spark still partitions the messages; nothing
    is gathered on the driver.
    """

    def splitter(df: DataFrame, payload: str = "payload", **_opts) -> DataFrame:
        from ..session import ship_package

        ship_package(df.sparkSession)
        base = df.select(*_kept(df, payload), payload)
        in_schema = base.schema
        out_fields = [f for f in in_schema.fields if f.name not in ("value", payload)]
        out_schema = T.StructType(
            out_fields
            + [
                T.StructField("pos", T.IntegerType()),
                T.StructField("value", T.BinaryType()),
                T.StructField("error", T.StringType()),
            ]
        )
        names = [f.name for f in out_fields]

        def run(batches):
            import pyarrow as pa

            def emit(batch, idx, pos, vals, errs):
                take = pa.array(idx, type=pa.int64())
                cols = [batch.column(batch.schema.get_field_index(n)).take(take) for n in names]
                cols += [
                    pa.array(pos, type=pa.int32()),
                    pa.array(vals, type=pa.binary()),
                    pa.array(errs, type=pa.string()),
                ]
                return pa.RecordBatch.from_arrays(cols, names=names + ["pos", "value", "error"])

            for batch in batches:
                data = batch.column(batch.schema.get_field_index(payload)).to_pylist()
                idx, pos, vals, errs = [], [], [], []
                for row, p in enumerate(data):
                    for out in _python_records(func, p):
                        idx.append(row)
                        pos.append(out[0])
                        vals.append(out[1])
                        errs.append(out[2])
                        if len(idx) >= out_rows:  # bounded output batches
                            yield emit(batch, idx, pos, vals, errs)
                            idx, pos, vals, errs = [], [], [], []
                if idx:
                    yield emit(batch, idx, pos, vals, errs)

        return base.mapInArrow(run, out_schema)

    return splitter


def _checked(handler: type) -> type:
    """``handler`` with whole messages: all its rows, or one error row."""

    class Checked(handler):
        def eval(self, payload: bytes):
            if payload is None:
                yield None, None, NULL_PAYLOAD
                return
            payload = bytes(payload)
            try:
                rows = handler.eval(self, payload)
                rows = None if rows is None else [(*r, None)[:3] for r in rows]
            except Exception as exc:
                rows, error = [], f"{type(exc).__name__}: {exc}"
            else:
                error = BAD_RECORDS if rows is None else NULL_RECORD if any(v is None and e is None for _, v, e in rows) else None
            if error is None:
                yield from rows
            else:
                yield None, payload, error

    return Checked


def udtf_splitter(tvf) -> Splitter:
    """Wrap a Python UDTF as a splitter.

    ``tvf`` is a ``@udtf`` whose ``eval(payload)`` yields ``(pos, value)``
    rows, or ``(pos, value, error)`` rows when it reports bad messages itself.
    A null payload, a null value, an ``eval`` that gives nothing at all and an
    exception are one error row each, with the whole payload.  Applied per
    message with a lateral join; like ``python_splitter`` it is the slow path
    for formats the built-in expressions cannot express.
    """

    def splitter(df: DataFrame, payload: str = "payload", **_opts) -> DataFrame:
        from ..session import ship_package

        ship_package(df.sparkSession)
        keep = _kept(df, payload)
        checked = F.udtf(_checked(tvf.func), returnType="pos int, value binary, error string")
        out = df.withColumnRenamed(payload, "__ql_payload").select(*keep, "__ql_payload").lateralJoin(checked(F.col("__ql_payload").outer()))
        return out.select(*keep, "pos", "value", "error")

    return splitter


__all__ = [
    "split_lines",
    "split_json",
    "split_xml",
    "split_records",
    "register_splitter",
    "get_splitter",
    "splitter_names",
    "expression_splitter",
    "python_splitter",
    "udtf_splitter",
]
