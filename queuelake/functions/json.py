"""Column expressions that cut JSON payloads into element records.

Elements are sliced from the payload, not parsed and written again: numbers and
strings come out exactly as they went in, only white space between tokens goes.
Spark's parser decides what is JSON; regular expressions give the places.  In
them a string is one token (so brackets and commas inside of strings do not
count), and a container is what lies between balanced brackets, nested to
``MAX_DEPTH`` levels.  Every quantifier is possessive: one pass, no backtracking,
no recursion but for the nesting.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Error codes of the JSON splitter.
BAD_JSON = "BAD_JSON"
NOT_OBJECT = "NOT_OBJECT"
SPLIT_KEY_NOT_FIRST = "SPLIT_KEY_NOT_FIRST"
NOT_ARRAY = "NOT_ARRAY"
TRAILING_DATA = "TRAILING_DATA"
DUPLICATE_KEY = "DUPLICATE_KEY"

#: Deeper payloads are BAD_JSON.
MAX_DEPTH = 100

_WS = "[ \\t\\r\\n]*+"
_STRING = "\"[^\"\\\\\\x00-\\x1F]*+(?:\\\\.[^\"\\\\\\x00-\\x1F]*+)*+\""
# What a document holds outside of strings and brackets: numbers, true, false,
# null, commas, colons, white space.  Spark's parser also takes single quotes,
# which are no JSON.
_BARE = "[-+.0-9eEtrufalsn:, \\t\\r\\n]"
_SCALAR = f"(?:{_STRING}|-?+[0-9][-+.0-9eE]*+|true|false|null)"


@lru_cache
def _container(opening: str = "[\\[{]", closing: str = "[\\]}]", depth: int = MAX_DEPTH) -> str:
    """A balanced container; which bracket closes which is the parser's to check."""
    inner = f"[\\[{{](?:{_BARE}++|{_STRING})*+[\\]}}]"
    for _ in range(depth - 2):
        inner = f"[\\[{{](?:{_BARE}++|{_STRING}|{inner})*+[\\]}}]"
    return f"{opening}(?:{_BARE}++|{_STRING}|{inner})*+{closing}"


def is_single_value(text: Column) -> Column:
    """Whether a text that begins with a JSON value holds nothing else: as the
    only element of an array and as the only member of an object (either alone
    would take a text that closes the bracket itself)."""
    in_array = F.json_array_length(F.concat(F.lit("["), text, F.lit("]")))
    in_object = F.json_object_keys(F.concat(F.lit('{"k":'), text, F.lit("}")))
    return F.coalesce((in_array == 1) & (F.size(in_object) == 1), F.lit(False))


def is_one_container(text: Column) -> Column:
    """Whether the text is one array or object by its brackets and tokens."""
    return text.rlike(f"\\A{_WS}{_container()}{_WS}\\z")


def is_scalar(text: Column) -> Column:
    """Whether the text is one string, number or literal."""
    return text.rlike(f"\\A{_WS}{_SCALAR}{_WS}\\z") & F.get_json_object(F.concat(F.lit("["), text, F.lit("]")), "$").isNotNull()


def is_document(text: Column) -> Column:
    """Whether the text is one strict JSON value."""
    parsed = F.json_object_keys(text).isNotNull() | F.json_array_length(text).isNotNull()
    return F.when(text.rlike(f"\\A{_WS}[\\[{{]"), parsed & is_one_container(text)).otherwise(is_scalar(text))


def why_not(text: Column) -> Column:
    """The error code of a text that is no document (evaluated for such alone)."""
    begins = F.get_json_object(text, "$").isNotNull() & ~text.contains("'")
    return F.when(begins & ~is_single_value(text), F.lit(TRAILING_DATA)).otherwise(F.lit(BAD_JSON))


def has_one_first_key(keys: Column, key: str) -> Column:
    """Whether ``key`` is the first of an object's keys and no other; null keys: no."""
    return F.coalesce((F.get(keys, F.lit(0)) == F.lit(key)) & (F.size(F.array_remove(keys, key)) == F.size(keys) - 1), F.lit(False))


def has_space(text: Column) -> Column:
    return text.contains(" ") | text.contains("\n") | text.contains("\t") | text.contains("\r")


def minified(text: Column) -> Column:
    """A valid document without the white space between its tokens."""
    return F.when(has_space(text), F.regexp_replace(text, f"({_STRING})|[ \\t\\r\\n]++", "$1")).otherwise(text)


def first_array(text: Column) -> Column:
    """The array under the first key of a text that is one object by its brackets
    and tokens, as written; an empty string where it is none."""
    head = f"\\A{_WS}\\{{{_WS}{_STRING}{_WS}:{_WS}"
    rest = f"{_WS}(?:,(?:{_BARE}++|{_STRING}|{_container(depth=MAX_DEPTH - 1)})*+)?+\\}}{_WS}\\z"
    return F.regexp_extract(text, f"{head}({_container('\\[', '\\]', MAX_DEPTH - 1)}){rest}", 1)


def elements(array: Column) -> Column:
    """array<string>: the elements of a valid array's text, as written but for
    white space between tokens.  ``"1"`` keeps its quotes, null is ``null``."""
    body = F.substring(array, F.lit(2), F.length(array) - 2)
    token = f"{_STRING}|{_container(depth=MAX_DEPTH - 2)}|[-+.0-9A-Za-z]++"
    return F.regexp_extract_all(minified(body), F.lit(token), 0)
