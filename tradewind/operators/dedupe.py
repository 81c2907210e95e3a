"""Latest version per key, and the uniqueness check."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNORDERABLE = (T.MapType, T.VariantType)

# Keys that need a second look are passed to every task as the buckets their hashes lie in: a list
# of at most so many numbers, whatever the keys. Another key in such a bucket only gets that look too.
KEY_BUCKETS = 1 << 20


def _latest_first(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str]) -> list:
    rest = [
        f.name
        for f in df.schema.fields
        if f.name not in set(keys) | set(latest_by) and not isinstance(f.dataType, _UNORDERABLE)
    ]
    return [F.col(c).desc_nulls_last() for c in [*latest_by, *rest]]


def dedupe_latest(
    df: DataFrame,
    keys: Sequence[str],
    latest_by: Sequence[str] = ("_ingest_time",),
    trim_first: bool = True,
) -> DataFrame:
    """Keep one row per key: the greatest by ``latest_by``.

    Ties are broken by all remaining columns in schema order, greatest first, so the result
    does not depend on partitioning. Rows with a null key count as one key.

    The rank filter is a top-1, which Spark also applies before the shuffle: every map task
    sends at most one row per key, so a hot key costs one row per task. For that a map task sorts
    its whole rows, and wide ones spill. ``trim_first=False`` sends every row as it is read, for
    wide rows of keys that have few versions; a hot key is then sorted by one task, on its disk.
    """
    window = Window.partitionBy(*keys).orderBy(*_latest_first(df, keys, latest_by))
    if trim_first:
        return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
    later = F.lag(F.lit(1)).over(window)
    return df.withColumn("_later", later).filter("_later is null").drop("_later")


def key_bucket(hashed: Column) -> Column:
    """The bucket of a hash: never null, so that a join on it filters nothing before the shuffle."""
    return hashed.bitwiseAND(F.lit(KEY_BUCKETS - 1))


def _elsewhere(df: DataFrame, bucket: Column, buckets: DataFrame) -> DataFrame:
    """Rows whose key lies in none of the buckets. Not an anti join, which Spark would move to before
    the shuffle of the rows, so that the shuffle would run once more."""
    found = df.join(F.broadcast(buckets), bucket == F.col("_bucket"), "left")
    return found.filter("_bucket is null").drop("_bucket")


def in_buckets(df: DataFrame, bucket: Column, buckets: DataFrame) -> DataFrame:
    return df.join(F.broadcast(buckets), bucket == F.col("_bucket"), "left_semi")


def latest_slim(
    df: DataFrame, keys: Sequence[str], latest_by: Sequence[str], slim: Sequence[Column]
) -> DataFrame:
    """``dedupe_latest(df, keys, latest_by).select(*keys, *slim)``, without shuffling whole rows.

    Only the key, the first column of ``latest_by`` and ``slim`` are shuffled. That decides every key but
    those with two rows of the same greatest value. These keys, and others of their buckets, are read
    again and decided on whole rows.
    """
    first = latest_by[0]
    rows = df.select(*keys, F.col(first).alias("_first"), *slim)
    window = Window.partitionBy(*keys).orderBy(*_latest_first(rows, keys, ["_first"]))
    # the order is over all columns, so both uses have the same shuffle and Spark runs it once
    ranked = rows.withColumns(
        {
            "_later": F.lag(F.lit(1)).over(window),
            "_tied": F.lead(F.lit(True), 1, False).over(window)
            & F.lead("_first").over(window).eqNullSafe(F.col("_first")),
        }
    ).filter("_later is null")
    bucket = key_bucket(F.xxhash64(*keys))
    tied = ranked.filter("_tied").select(bucket.alias("_bucket")).distinct()
    decided = _elsewhere(ranked.drop("_first", "_later", "_tied"), bucket, tied)
    again = dedupe_latest(in_buckets(df, bucket, tied), keys, latest_by, trim_first=False)
    return decided.unionByName(again.select(*keys, *slim))


def dedupe_few(
    df: DataFrame, key: str, latest_by: Sequence[str], keep=lambda rows: rows
) -> DataFrame:
    """``dedupe_latest(df, [key], latest_by)`` for rows whose keys mostly differ; rows without a key all stay.

    Hashes of the keys are shuffled instead of the rows. Rows of keys that repeat, and others of their
    buckets, then meet whole. ``df`` is read three times, its shuffles once. ``keep`` gets the list of
    these buckets, to write it for instance, and gives it back.
    """
    hashes = df.groupBy(F.xxhash64(key).alias("_hash")).count()
    repeated = hashes.filter("count > 1").select(key_bucket(F.col("_hash")).alias("_bucket")).distinct()
    repeated = keep(repeated)
    bucket = F.when(F.col(key).isNull(), F.lit(-1)).otherwise(key_bucket(F.xxhash64(key)))
    met = dedupe_latest(in_buckets(df, bucket, repeated), [key], latest_by)
    return _elsewhere(df, bucket, repeated).unionByName(met)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")
