"""Column expressions that cut XML payloads into element records.

No XML parser is involved (the records are parsed afterwards with
``from_xml``): elements are found by a regular expression on the tag name.
Handled: attributes (also with ``>`` in a quoted value), whitespace before
``>``, self-closing tags (skipped), prefix-sharing names such as ``<itemx>``
(not matched).  Tags inside comments, CDATA sections and processing
instructions are text: in messages that hold such spans, their ``<`` is masked by
a character XML does not allow, one for one, while elements are looked for, and
put back into the records.  Out of scope: tags inside a DOCTYPE.

The work is linear in the message.  Elements are looked for only up to the last
end tag, so from every start tag there the search ends at an end tag and goes
on behind it; a start tag stops at the next ``<`` (XML allows none in a tag),
so a quote that is never closed is not searched for through the message.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_NAME = re.compile(r"^[A-Za-z_][\w.\-:]*$")

# Error codes of the XML splitter.
NESTED_SPLIT = "NESTED_SPLIT"
UNCLOSED_SPLIT = "UNCLOSED_SPLIT"
UNMATCHED_END = "UNMATCHED_END"
HEADER_MISSING = "HEADER_MISSING"
UNCLOSED_SPAN = "UNCLOSED_SPAN"
ILLEGAL_CHARACTER = "ILLEGAL_CHARACTER"

# Stands for a "<" that is no markup; XML 1.0 allows it nowhere.
_MASK = "\x01"
# Comments, CDATA sections, processing instructions; one that never ends runs to the end.
_SPAN = r"(?s)<!--.*?(?:-->|\z)|<!\[CDATA\[.*?(?:\]\]>|\z)|<\?.*?(?:\?>|\z)"
_WHOLE_SPAN = r"(?s)^(?:<!--.*-->|<!\[CDATA\[.*\]\]>|<\?.*\?>)\z"


def _quoted(tag: str) -> str:
    if not _NAME.match(tag or ""):
        raise ValueError(f"not an XML element name: {tag!r}")
    return "\\Q" + tag + "\\E"


def open_tag_regex(tag: str) -> str:
    """Start tag of ``tag`` (never a self-closing one)."""
    return "<" + _quoted(tag) + "(?:\\s(?:[^<>\"'/]++|\"[^<\"]*+\"|'[^<']*+'|/(?!>))*+)?>"


def end_tag(tag: str) -> str:
    _quoted(tag)
    return f"</{tag}>"


def count_literal(text: Column, literal: str) -> Column:
    # in bytes: counting characters is a pass over the text
    n = F.octet_length(text) - F.octet_length(F.replace(text, F.lit(literal), F.lit("")))
    return (n / len(literal.encode())).cast("int")


def after_last_end(text: Column, tag: str) -> Column:
    """What follows the last end tag (the whole text without one)."""
    return F.substring_index(text, end_tag(tag), -1)


def up_to_last_end(text: Column, tail: Column) -> Column:
    """The text without its ``tail`` (see ``after_last_end``), cut by bytes."""
    n = F.octet_length(text) - F.octet_length(tail)
    return F.substring(text.cast("binary"), F.lit(1), n).cast("string")


def has_spans(text: Column) -> Column:
    """Whether the text holds a comment, CDATA section or processing instruction
    (the declaration a document begins with apart: no tag fits into it)."""
    declared = F.substring(text, 1, 6).isin("<?xml ", "<?xml\t", "<?xml\r", "<?xml\n")
    instruction = text.contains("<?") & ((F.locate("<?", text, 2) > 0) | (text.startswith("<?") & ~declared))
    return (text.contains("<!") & (text.contains("<!--") | text.contains("<![CDATA["))) | instruction


def spans(text: Column) -> Column:
    """The spans from left to right: what begins inside of one is its text."""
    return F.regexp_extract_all(text, F.lit(_SPAN), 0)


def mask_spans(text: Column, found: Column) -> Column:
    """The text with every ``<`` inside of ``found`` masked but for the one that
    begins a span; as long as it was, character by character."""
    def inside(piece: Column, span: Column) -> Column:
        return F.concat(piece, F.coalesce(F.concat(F.lit("<"), F.translate(F.substring(span, 2, 2**31 - 1), "<", _MASK)), F.lit("")))

    return F.array_join(F.zip_with(F.split(text, _SPAN, -1), found, inside), "")


def unmask(text: Column) -> Column:
    return F.translate(text, _MASK, "<")


def span_error(text: Column, found: Column) -> Column:
    """Why a text with spans can not be masked, or null."""
    last = F.element_at(found, -1)
    return F.when(text.contains(_MASK), F.lit(ILLEGAL_CHARACTER)).when(~last.rlike(_WHOLE_SPAN), F.lit(UNCLOSED_SPAN))


def start_tag_upper_bound(text: Column, tag: str) -> Column:
    """Occurrences of the literal ``<tag``: never fewer than the real start
    tags (it also counts ``<tagx`` and self-closing tags), and computed with a
    plain string replace instead of a regex."""
    _quoted(tag)
    return count_literal(text, "<" + tag)


def element_regex(tag: str, keep_indent: bool) -> str:
    """Whole element, shortest match; optionally with the indentation before it.
    It goes from ``<`` to ``<``: ``.*?`` would try the end tag at every character."""
    indent = "(?:^[ \\t]*)?" if keep_indent else ""
    end = f"/{_quoted(tag)}>"
    return "(?sm)" + indent + open_tag_regex(tag) + f"[^<]*(?:<(?!{end})[^<]*)*+<{end}"


def normalize_newlines(text: Column) -> Column:
    """``\\r\\n`` and lone ``\\r`` -> ``\\n`` (the regex only runs when a ``\\r`` is there)."""
    return F.when(text.contains("\r"), F.regexp_replace(text, "\\r\\n?", "\n")).otherwise(text)


def line_layout(element: Column, single_line: Column) -> Column:
    """Format an element the way a line-by-line XML reader hands it out.

    A one-line message gets a line break between every pair of adjacent tags;
    a multi-line message keeps the element's own lines (with indentation).
    Either way the record ends with a line break.
    """
    return F.concat(
        F.when(single_line, F.replace(element, F.lit("><"), F.lit(">\n<"))).otherwise(element),
        F.lit("\n"),
    )


def whole_message(text: Column) -> Column:
    """One record for the whole document, line ends normalised, final newline."""
    norm = normalize_newlines(text)
    return F.when(norm.endswith("\n"), norm).otherwise(F.concat(norm, F.lit("\n")))
