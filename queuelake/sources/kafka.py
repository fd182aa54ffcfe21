"""Sinks for split records: Kafka shape, queue log, parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def refuse_failures(df: DataFrame) -> DataFrame:
    """``df`` as it is, failing at run time on a row whose ``error`` is set."""
    if "error" not in df.columns:
        return df
    failed = F.raise_error(F.concat(F.lit("FAILED_MESSAGE: route failures to a dead-letter queue first: "), F.col("error")))
    return df.where(F.when(F.col("error").isNull(), F.lit(True)).otherwise(failed.cast("boolean")))


def kafka_shape(df: DataFrame, topic: str, key: str | Column | None = None, value: str | Column = "value") -> DataFrame:
    """``(topic, key, value)`` as the Kafka sink expects (binary key/value).

    Rows with an ``error`` are failed messages, not records: they make the query
    fail (``FAILED_MESSAGE``) unless they are routed away first."""
    df = refuse_failures(df)
    k = F.col(key) if isinstance(key, str) else key
    v = F.col(value) if isinstance(value, str) else value
    return df.select(
        F.lit(topic).alias("topic"),
        (k.cast("string").cast("binary") if k is not None else F.lit(None).cast("binary")).alias("key"),
        v.cast("binary").alias("value"),
    )


def kafka_writer(df: DataFrame, topic: str, bootstrap_servers: str, checkpoint: str, key=None, value="value"):
    """A ready ``DataStreamWriter`` for Kafka (append mode, own checkpoint).

    Needs the spark-sql-kafka connector on the classpath; it is not bundled.
    """
    return (
        kafka_shape(df, topic, key, value)
        .writeStream.format("kafka")
        .outputMode("append")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("checkpointLocation", checkpoint)
    )
