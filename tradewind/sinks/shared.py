"""Where intermediate tables and stream checkpoints go."""

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the one the cluster names in ``spark.checkpoint.dir``.

    A machine-local folder is used only where that is unset and the session itself is local.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tradewind-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def drop_dir(spark: SparkSession, place: str) -> None:
    """Remove a folder that ``shared_dir`` named, once nothing reads it any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Jobs run herein remove their shuffle files when they end, not when the driver next collects garbage.

    For steps whose result is written: a run of many steps then holds the files of one of them at a time.
    """
    before = spark.conf.get(CLEANUP_CONF, None)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_CONF)
        else:
            spark.conf.set(CLEANUP_CONF, before)


def written(make: "Callable[[int], DataFrame]", parts: int, purpose: str) -> DataFrame:
    """The rows of ``make(0)`` to ``make(parts - 1)``, written one part after the other and read back.

    The parts' shuffle files are on disk one part at a time.
    """
    place = ""
    for part in range(parts):
        rows = make(part)
        place = place or shared_dir(rows.sparkSession, purpose)
        with shuffles_freed(rows.sparkSession):
            rows.write.mode("append").option("compression", "zstd").parquet(place)
    return rows.sparkSession.read.schema(rows.schema).parquet(place)
