"""Small file-system helpers for idempotent writes on any Hadoop path.

They go through Spark's own Hadoop file systems, so they reach what Spark
reaches.  A call that fails raises: only "not there" counts as absent.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SUCCESS = "_SUCCESS"
OWNER = "_owner"

# Fixed value: a Parquet row group is read by one task, whatever the number of
# splits of its file.  Spark's 128 MB hold a whole file of compressed messages, so a
# batch of few files would keep few cores busy.
ROW_GROUP_BYTES = 4 << 20


class OwnershipError(RuntimeError):
    """A finished target belongs to another reader or checkpoint."""


def _fs(spark: SparkSession, path: str):
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:
        raise RuntimeError("queue logs need a session with direct access to its file systems (not Spark Connect)")
    hp = jvm.org.apache.hadoop.fs.Path(path)
    return hp.getFileSystem(spark._jsc.hadoopConfiguration()), hp  # noqa: SLF001


def local_path(spark: SparkSession, path: str) -> str | None:
    """``path`` as the operating system names it, if it is on a disk that Hadoop's
    local file system reaches; else None."""
    fs, hp = _fs(spark, path)
    uri = fs.makeQualified(hp).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is there; an unreachable file system raises."""
    fs, hp = _fs(spark, path)
    return bool(fs.exists(hp))


def is_finished(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, path.rstrip("/") + "/" + SUCCESS)


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, hp = _fs(spark, path)
    out = fs.create(hp, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, hp = _fs(spark, path)
    if not fs.exists(hp):
        return None
    data = fs.open(hp)
    try:
        return bytes(data.readAllBytes()).decode()
    finally:
        data.close()


def write_once(df: DataFrame, path: str, fmt: str = "parquet", owner: str | None = None, **options) -> bool:
    """Write ``df`` to ``path`` unless an earlier attempt already finished it.

    The rows are written to a hidden folder beside ``path`` and renamed once,
    so readers see all of an append or nothing, and a crashed attempt stays
    hidden.  A finished directory is skipped, not overwritten: rewriting would
    give the files new names and a file source downstream would read them
    twice.  ``owner`` (a stream's checkpoint identity) is kept in the
    directory; a finished one of another owner raises ``OwnershipError``
    instead of losing the rows.  Returns True when this call wrote.
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    if _settled(spark, path, owner):
        return False
    parent, name = path.rsplit("/", 1)
    staging = f"{parent}/_staging-{uuid.uuid4().hex}/{name}"
    w = df.write.format(fmt)
    if fmt == "parquet":
        options = {"parquet.block.size": ROW_GROUP_BYTES, **options}
    for k, v in options.items():
        w = w.option(k, v)
    w.save(staging)
    if owner is not None:
        _write_text(spark, f"{staging}/{OWNER}", owner)
    fs, src = _fs(spark, staging)
    _, dst = _fs(spark, path)
    if fs.exists(dst):  # no append of ours: those arrive finished
        raise RuntimeError(f"{path} exists without {SUCCESS}: remove or finish it first")
    fs.mkdirs(dst.getParent())
    moved = fs.rename(src, dst)
    if not moved and not _settled(spark, path, owner):
        raise RuntimeError(f"could not rename {staging} to {path}")
    fs.delete(src.getParent(), True)
    return bool(moved)


def _settled(spark: SparkSession, path: str, owner: str | None) -> bool:
    """Whether ``path`` is finished, by the same owner."""
    if not is_finished(spark, path):
        return False
    found = _read_text(spark, f"{path}/{OWNER}")
    if owner is not None and found != owner:
        raise OwnershipError(f"{path} was written by {found!r}, not by {owner!r}: use another output, archive or producer name")
    return True
