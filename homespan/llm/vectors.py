"""What the vector operators share: which vectors take part, and matrices of Arrow lists."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null, not empty, and every component a finite number."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & fine, F.lit(False))


def matrix(column: pa.Array, dtype: type = np.float64) -> np.ndarray:
    """Rows of equally long lists without nulls."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(dtype, copy=False)
