"""Join of rows with repeated keys to a list that holds each key once."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_join(rows: DataFrame, keyed: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join ``keyed`` to ``rows`` on ``keys``, null equal to null; how: left, left_semi, left_anti.

    For lists that come out of an aggregate. On plain equality Spark would join them as the
    aggregate left them, and AQE only splits a hot key where both sides are freshly shuffled.
    Null-safe equality shuffles the list, which is the small side, once more. That also tells
    AQE its true size, so that a short list is broadcast.
    """
    names = {k: f"_key_{k}" for k in keys}
    right = keyed.withColumnsRenamed(names)
    on = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()))
    joined = rows.join(right, on, how)
    return joined.drop(*names.values()) if how == "left" else joined
