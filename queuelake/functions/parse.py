"""Typed views of split records: fixed-width, JSON and XML."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import decode_payload


def fixed_width_columns(
    value: str | Column, layout: Sequence[tuple[str, int, int, str]], encoding: str = "UTF-8"
) -> list[Column]:
    """One column per ``(name, start, length, type)`` (``start`` 1-based, in
    characters): ``substring`` + ``trim`` + ``try_cast`` (bad text -> null)."""
    v = F.col(value) if isinstance(value, str) else value
    text = decode_payload(v, encoding)
    return [F.trim(F.substring(text, start, length)).try_cast(typ).alias(name) for name, start, length, typ in layout]


def parse_fixed_width(
    df: DataFrame, layout: Sequence[tuple[str, int, int, str]], value: str = "value", encoding: str = "UTF-8"
) -> DataFrame:
    return df.select("*", *fixed_width_columns(value, layout, encoding))


def _text(value: str | Column) -> Column:
    v = F.col(value) if isinstance(value, str) else value
    return decode_payload(v)


def json_struct(value: str | Column, schema: str, corrupt: str | None = "_corrupt_record") -> Column:
    opts = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}
    if corrupt:
        opts["columnNameOfCorruptRecord"] = corrupt
    return F.from_json(_text(value), schema, opts)


def xml_struct(value: str | Column, schema: str, corrupt: str | None = "_corrupt_record") -> Column:
    opts = {"mode": "PERMISSIVE"}
    if corrupt:
        opts["columnNameOfCorruptRecord"] = corrupt
    return F.from_xml(_text(value), schema, opts)


def parse_json(df: DataFrame, schema: str, value: str = "value", into: str = "parsed") -> DataFrame:
    """Add struct column ``into`` parsed from JSON records.  Malformed records
    give nulls (and the raw text in ``_corrupt_record`` when the schema has
    that field)."""
    return df.withColumn(into, json_struct(value, schema))


def parse_xml(df: DataFrame, schema: str, value: str = "value", into: str = "parsed") -> DataFrame:
    """Add struct column ``into`` parsed from XML records with ``from_xml``
    (attributes become ``_name`` fields)."""
    return df.withColumn(into, xml_struct(value, schema))
