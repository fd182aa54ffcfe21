"""Small helpers that the operators share: tables, written intermediates, batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from queuelake.session import ship_package

BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(name: str) -> Column:
    """The column of exactly this name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def row_struct(df: DataFrame, name: str = "row") -> Column:
    """All columns of ``df`` as one struct, so that no name can clash with an
    operator's own; ``from_struct`` takes it apart again."""
    return F.struct(*[column(c) for c in df.columns]).alias(name)


def texts(batch: pa.RecordBatch) -> pa.Array:
    """The texts of a batch, from the column of that name or from ``row``."""
    if "text" in batch.schema.names:
        return batch.column(batch.schema.names.index("text"))
    return batch.column(batch.schema.names.index("row")).field("text")


def from_struct(df: DataFrame, like: DataFrame, name: str = "row") -> DataFrame:
    return df.select(*[F.col(name).getField(c).alias(c) for c in like.columns])


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the cluster; a temporary one only where the
    setting is missing and the session is a local one (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a folder every executor can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-ckpt-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, read back: cuts the lineage and
    outlives any executor.  The folder is fresh, so a retry never mixes runs."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``BATCH_ROWS`` (no copy)."""
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with small batches, so that what a function makes of a
    batch of long texts stays within a worker's memory.  Spark bounds the bytes
    of the batches that it sends; no option of the session is touched."""
    ship_package(df.sparkSession)
    return df.mapInArrow(lambda batches: fn(small_batches(batches)), schema)
