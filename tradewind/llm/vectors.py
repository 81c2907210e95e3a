"""What the vector searches share: which vectors take part, and their passage into numpy."""

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null, not empty, and every component a finite number."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False))


def matrix(vectors: pd.Series) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    return np.array(vectors.tolist(), dtype=np.float64)
