"""Tables of the lake."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by name, or a parquet path (anything with a ``/``)."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def is_available(spark: SparkSession, name: str) -> bool:
    """True if the table exists and holds a row; reads one row at most."""
    return spark.catalog.tableExists(name) and not spark.table(name).isEmpty()


def feature_source(df: DataFrame, event_ts: str, created_ts: str) -> DataFrame:
    """Name a source's event and created time the way the feature operators expect."""
    return df.withColumnsRenamed({event_ts: "event_timestamp", created_ts: "created_timestamp"})


def register_view(df: DataFrame, name: str) -> str:
    """Make a frame visible to SQL."""
    df.createOrReplaceTempView(name)
    return name


def align(df: DataFrame, schema) -> DataFrame:
    """Columns of ``schema`` in its order and types; a column the frame lacks is null.

    This is how a table written before a column was added still reads as today's schema.
    """
    have = set(df.columns)
    return df.select(
        *(
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        )
    )
