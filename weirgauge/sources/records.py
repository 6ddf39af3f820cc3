"""Log records: a Kafka topic, or files that hold the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..contracts import ENVELOPE_SCHEMA, ContractError

STARTS = ("latest", "earliest")


def topic_stream(
    spark: SparkSession, servers: str, topic: str, start: str = "latest", per_batch: int | None = None
) -> DataFrame:
    """Subscribe to one topic; Spark keeps the offsets in the checkpoint.

    ``per_batch`` limits how many records one micro-batch takes.
    """
    if start not in STARTS:
        raise ContractError(f"start must be one of {STARTS}")
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start}
    if per_batch:
        options["maxOffsetsPerTrigger"] = str(per_batch)
    return spark.readStream.format("kafka").options(**options).load()


def file_stream(
    spark: SparkSession,
    path: str,
    schema: str = ENVELOPE_SCHEMA,
    files_per_batch: int | None = None,
    glob: str | None = None,
) -> DataFrame:
    """Parquet files as they arrive in a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def write_topic(records: DataFrame, servers: str) -> None:
    """Send records (topic, value) to Kafka from every task."""
    records.write.format("kafka").option("kafka.bootstrap.servers", servers).save()
