"""What the two vector operators share: which vectors take part, and copies."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Not null, not zero, every component present and finite."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equally long lists in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def by_dimension(batch: pa.RecordBatch, column: str):
    """The batch in parts of equally long vectors."""
    sizes = pa.compute.list_value_length(batch.column(column)).to_numpy(zero_copy_only=False)
    for d in np.unique(sizes):
        yield int(d), batch.filter(pa.array(sizes == d))
