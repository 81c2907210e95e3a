"""Stream sources and the append sink.

Ingest is stateless: decode, route, stamp, append. Repeated and late records are resolved in
silver by the latest-version rule, so no state store is kept. The file sink and its
checkpoint make each input appear once in the target, also after a lost executor or driver.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

# The POS topic.
KAFKA_POS = {"subscribe": "pos-transactions", "startingOffsets": "earliest"}

TRIGGER = {"processingTime": "10 seconds"}


def stream_pos(
    spark: SparkSession,
    fmt: str = "kafka",
    options: "dict | None" = None,
    schema: "T.StructType | None" = None,
    path: "str | None" = None,
) -> DataFrame:
    """POS messages with a ``value`` payload. Kafka by default; tests use a file format.

    Kafka offsets are spread over at least as many tasks as there are cores, so that one busy
    topic partition is not one task.
    """
    defaults = {}
    if fmt == "kafka":
        defaults = {**KAFKA_POS, "minPartitions": spark.sparkContext.defaultParallelism}
    reader = spark.readStream.format(fmt).options(**{**defaults, **(options or {})})
    return (reader if schema is None else reader.schema(schema)).load(path)


def _files(spark: SparkSession, glob: str, archive: "str | None", per_trigger: "int | None"):
    reader = spark.readStream.option("pathGlobFilter", glob)
    if archive:
        # a file is moved only after the checkpoint has it, in a later micro-batch
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.option("maxFilesPerTrigger", per_trigger) if per_trigger else reader


def stream_documents(
    spark: SparkSession,
    path: str,
    archive: "str | None" = None,
    per_trigger: "int | None" = None,
    whole_files: bool = True,
    suffix: str = "*.json",
) -> DataFrame:
    """Drops as they land, one row per document: ``file``, ``text``."""
    return (
        _files(spark, suffix, archive, per_trigger)
        .format("text")
        .option("wholetext", whole_files)
        .load(path)
        .selectExpr("_metadata.file_name AS file", "value AS text")
    )


def stream_rows(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str,
    glob: str,
    archive: "str | None" = None,
    options: "dict | None" = None,
    per_trigger: "int | None" = None,
) -> DataFrame:
    """Row-shaped drops (CSV, parquet, JSON lines) as they land, with their ``_file``."""
    return (
        _files(spark, glob, archive, per_trigger)
        .format(fmt)
        .schema(schema)
        .options(**(options or {}))
        .load(path)
        .selectExpr("_metadata.file_name AS _file", *(f"`{c}`" for c in schema.fieldNames()))
    )


def stream_append(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: "dict | None" = None,
    partition_by: Sequence[str] = ("ingest_date",),
) -> StreamingQuery:
    """Start the append; ``trigger={"availableNow": True}`` stops when the input is used up.

    A target path belongs to one query and one checkpoint. Other writers need their own path:
    readers follow the sink's commit log and do not see files put beside it.
    """
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or TRIGGER))
        .partitionBy(*partition_by)
        .start(path)
    )
