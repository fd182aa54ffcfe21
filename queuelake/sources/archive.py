"""Archive of raw payloads ("movePath"): every message, to every path."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.message import archive_name
from .fs import write_once


def _or_null(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind).alias(name)


def archive(df: DataFrame, paths: Iterable[str], batch_id: int, data_source: str, reader: str = "reader", owner: str | None = None) -> list[str]:
    """Write the raw messages of one batch to
    ``<path>/reader=<reader>/batch_id=<n>`` for each path, with their archive
    names.  ``reader`` names the queue manager, queue and producer that read
    them, so several readers can share a path.  A finished batch directory is
    skipped, so a replayed batch does not archive twice; one of another
    ``owner`` raises.  Callers persist ``df`` first when there are several
    paths.
    """
    rows = df.select(archive_name(data_source).alias("archive_name"), "msg_id", _or_null(df, "msg_type", "int"), _or_null(df, "correl_id", "binary"), "put_ts", "payload")
    written = []
    for p in paths:
        target = f"{p.strip().rstrip('/')}/reader={reader}/batch_id={int(batch_id)}"
        write_once(rows, target, owner=owner)
        written.append(target)
    return written
