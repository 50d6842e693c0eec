"""What the vector operators share: which vectors count, and arrays of them."""

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(column: str = "embedding") -> Column:
    """Whether a vector is neither null nor zero and all its components are finite numbers."""
    vector = F.col(column)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(vectors: pd.Series) -> np.ndarray:
    """Vectors of one length as rows in double precision."""
    return np.array(vectors.tolist(), np.float64)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no square overflows or vanishes."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)
