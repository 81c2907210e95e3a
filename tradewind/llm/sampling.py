"""Bounded samples of labelled rows to fit a classifier on."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UNIT = float(1 << 32)


def chance(key: Column) -> Column:
    """A number in [0, 1) that depends on the key alone; it is no function of the key's crc32."""
    return F.pmod(F.xxhash64(F.coalesce(key.cast("string"), F.lit(""))), F.lit(1 << 32)) / F.lit(
        _UNIT
    )


def sample_by_label(
    rows: DataFrame, key: str, label: str, per_label: "int | dict"
) -> DataFrame:
    """About ``per_label`` rows of each label (a number, or one per label); null labels go.

    A row stays if its key's number is below its label's rate, so a run on the same rows keeps
    the same ones. Collected is a count per label; every label must be one of a small set.
    """
    known = rows.filter(F.col(label).isNotNull())
    counts = known.groupBy(label).count().collect()
    keep = F.lit(False)
    for row in counts:
        wanted = per_label[row[label]] if isinstance(per_label, dict) else per_label
        rate = min(1.0, wanted / row["count"])
        keep = keep | ((F.col(label) == F.lit(row[label])) & (chance(F.col(key)) < F.lit(rate)))
    return known.filter(keep)
