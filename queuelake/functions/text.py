"""Column expressions for payload text: decoding, encoding and line splitting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..options import normalize_charset

# Fixed value: the line terminators of a Java line scanner, as a Java regex.
LINE_TERMINATOR = "\\r\\n|[\\n\\r\\u2028\\u2029\\u0085]"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def decode_payload(payload: str | Column, encoding: str = "UTF-8") -> Column:
    """Binary payload -> string.

    UTF-8 goes through ``make_valid_utf8`` so undecodable bytes become U+FFFD
    instead of failing the task.  Other charsets use ``decode``; sessions that
    need replacement for those set ``spark.sql.legacy.codingErrorAction``.
    """
    enc = normalize_charset(encoding)
    p = _c(payload)
    if enc == "UTF-8":
        return F.make_valid_utf8(p.cast("string"))
    return F.decode(p, enc)


def encode_text(text: str | Column, encoding: str = "UTF-8") -> Column:
    enc = normalize_charset(encoding)
    t = _c(text)
    if enc == "UTF-8":
        return t.cast("binary")
    return F.encode(t, enc)


def split_lines_expr(payload: str | Column, encoding: str = "UTF-8") -> Column:
    """array<string> of the decoded lines, line scanner semantics.

    Empty payload -> no line; a final terminator does not start a new line;
    blank lines in between are kept.  (Splitters re-encode each line in
    ``encoding`` after exploding.)
    """
    p = _c(payload)
    text = decode_payload(p, encoding)
    return F.when(F.octet_length(p) == 0, F.array().cast("array<string>")).otherwise(_lines(text))


# The single-character line terminators other than LF.
_OTHER_TERMINATORS = ["\r", "\u2028", "\u2029", "\u0085"]


def _lines(text: Column) -> Column:
    """Split ``text`` into lines without a regex in the common case.

    The final terminator is cut by looking at the last one or two
    characters; a text whose only terminator is ``\\n`` is split on that
    literal (Java's single-character fast path).  Only texts containing
    ``\\r``, U+2028, U+2029 or U+0085 take the regex split.
    """
    n = F.char_length(text)
    last = F.substring(text, -1, 1)
    cut = (
        F.when(text.endswith("\r\n"), F.lit(2))
        .when(last.isin("\n", *_OTHER_TERMINATORS), F.lit(1))
        .otherwise(F.lit(0))
    )
    body = F.when(cut == 0, text).otherwise(F.substring(text, F.lit(1), n - cut))
    exotic = F.lit(False)
    for t in _OTHER_TERMINATORS:
        exotic = exotic | text.contains(t)
    return F.when(exotic, F.split(body, LINE_TERMINATOR, -1)).otherwise(F.split(body, "\n", -1))
