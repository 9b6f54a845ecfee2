"""Streaming sources. Both yield one string column ``value``, so everything after
the source is the same in production and in tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_stream(spark: SparkSession, brokers: str, topic: str = "pos_transactions", **options: str) -> DataFrame:
    """The POS topic from its latest offsets. Needs the Spark Kafka package."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .option("failOnDataLoss", "false")
        .options(**options)
        .load()
        .selectExpr("CAST(value AS STRING) AS value")
    )


def json_file_stream(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """JSON lines dropped into a folder."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder)
