"""Raw file drops of the four channels.

A directory is read as one Spark job with an explicit schema: no loop over files, no
inference pass. Only files directly in the directory are read, so archive and quarantine
folders below it are ignored. ``_file`` keeps the name of the file each row came from.

A JSON drop is one document per file and such a file cannot be split, so a drop must fit one
task. Large deliveries should hold one document per line; read those with
``whole_files=False``, which splits files freely.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind import schemas as S

FILE = "_file"


def _json_drops(spark: SparkSession, path: str, schema: T.StructType, whole_files: bool):
    return (
        spark.read.schema(schema)
        .option("multiLine", whole_files)
        .option("pathGlobFilter", "*.json")
        .option("recursiveFileLookup", False)
        .json(path)
        .withColumn(FILE, F.col("_metadata.file_name"))
    )


def shopify_rows(envelopes: DataFrame) -> DataFrame:
    """Envelope rows -> one row per order node; an empty or missing edge list gives none."""
    return envelopes.select(FILE, F.explode("data.orders.edges").alias("edge")).select(
        FILE, "edge.node.*"
    )


def amazon_rows(envelopes: DataFrame) -> DataFrame:
    """Envelope rows -> one row per order."""
    return envelopes.select(FILE, F.explode("Orders").alias("entry")).select(FILE, "entry.*")


def read_shopify(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    return shopify_rows(_json_drops(spark, path, S.SHOPIFY_DROP, whole_files))


def read_amazon(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    return amazon_rows(_json_drops(spark, path, S.AMAZON_DROP, whole_files))


def read_pos(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """A file holds an array of transactions (each element is one row) or one per line."""
    return _json_drops(spark, path, S.POS_TRANSACTION, whole_files)


def read_distributor(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header. A file whose header differs from the schema ends the read."""
    names = S.DISTRIBUTOR_ROW.fieldNames()
    return (
        spark.read.schema(S.DISTRIBUTOR_ROW)
        .option("header", True)
        .option("enforceSchema", False)
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", False)
        .csv(path)
        .select(F.col("_metadata.file_name").alias(FILE), *names)
    )


def drop_documents(
    spark: SparkSession, path: str, whole_files: bool = True, suffix: str = "*.json"
) -> DataFrame:
    """Drops as text, one row per document: ``file``, ``text``."""
    return (
        spark.read.option("pathGlobFilter", suffix)
        .option("recursiveFileLookup", False)
        .text(path, wholetext=whole_files)
        .select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("text"))
    )


def split_recognised(documents: DataFrame, root: str) -> "tuple[DataFrame, DataFrame]":
    """(documents with the top-level field ``root``, documents without)."""
    found = F.array_contains(F.json_object_keys("text"), root)
    flagged = documents.withColumn("_found", F.coalesce(found, F.lit(False)))
    return flagged.filter("_found").drop("_found"), flagged.filter("not _found").drop("_found")
