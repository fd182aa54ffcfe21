"""A message per file: a folder read as a queue, in batch or as a stream.

Spark's ``binaryFile`` source lists and reads the files.  Files beyond a length
that a row can hold come out as error rows; their content is never read, because
the filter on the length is the source's own and their rows do not ask for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import MESSAGE_SCHEMA, MQMT_DATAGRAM

# Fixed value: the error code of a file that is not read.
FILE_TOO_LARGE = "FILE_TOO_LARGE"

MAX_FILE_BYTES = 512 * 1024 * 1024


def _messages(files: DataFrame, payload: Column, error: Column) -> DataFrame:
    # the session's zone gives the wall clock; convert_timezone brings it to UTC
    put = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col("modificationTime").cast("timestamp_ntz"))
    known = {"msg_id": F.col("path"), "msg_type": F.lit(MQMT_DATAGRAM), "put_ts": put, "payload": payload}
    cols = [known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in MESSAGE_SCHEMA.fields]
    return files.select(*cols, F.col("length").alias("n_bytes"), error.cast("string").alias("error"))


# The columns of Spark's binaryFile source.
_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def _read(reader, path: str, glob: str | None, max_file_bytes: int) -> DataFrame:
    reader = reader.format("binaryFile").schema(_FILE_SCHEMA).option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path)
    fits = F.col("length") <= max_file_bytes
    return _messages(files.where(fits), F.col("content"), F.lit(None)).unionByName(_messages(files.where(~fits), F.lit(None), F.lit(FILE_TOO_LARGE)))


def read_files(spark: SparkSession, path: str, glob: str | None = None, max_file_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """One message per file below ``path`` (hidden files apart; ``glob`` matches
    names): the message schema, ``n_bytes`` and ``error``.

    ``msg_id`` is the file's path, ``put_ts`` its modification time (UTC wall
    clock), ``payload`` its bytes.  A file of more than ``max_file_bytes`` has a
    null payload and ``FILE_TOO_LARGE``; drop the error column of the others
    before splitting.  Spark's file sources pass over empty files: they are no
    messages.
    """
    return _read(spark.read, path, glob, max_file_bytes)


def read_files_stream(
    spark: SparkSession, path: str, glob: str | None = None, max_file_bytes: int = MAX_FILE_BYTES, max_files_per_trigger: int | None = None
) -> DataFrame:
    """``read_files`` as a stream: every file once, as it appears; the
    checkpoint logs which files a batch read."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return _read(reader, path, glob, max_file_bytes)


__all__ = ["read_files", "read_files_stream", "FILE_TOO_LARGE", "MAX_FILE_BYTES"]
