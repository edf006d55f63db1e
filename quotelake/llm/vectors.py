"""Vectors as whole numbers, in blocks of bounded bytes, for operators on vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of a block's components at eight each.
BLOCK_BYTES = 2_000_000
#: Components beyond are refused: sums of their products may leave the range of a long.
LARGEST = 2.0**26


def finite(vector: Column) -> Column:
    """Whether there is a vector and all its components are numbers."""
    number = lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False))
    return F.coalesce(F.forall(vector, number), F.lit(False)) & (F.size(vector) > 0)


def usable(df: DataFrame, key: str, vector: str, *others: str) -> DataFrame:
    """The named columns of rows whose vector can be used, the vector as doubles.

    All have one length, that of the row with the smallest key (ties: the smallest
    vector); rows with vectors of another length cannot be compared with them and
    take no part.
    """
    kept = df.select(key, F.col(vector).cast("array<double>").alias(vector), *others).filter(finite(F.col(vector)))
    first = kept.select(F.struct(F.col(key).isNull().alias("none"), key, vector).alias("row")).agg(F.min("row").alias("row"))
    length = first.select(F.size(F.col(f"row.{vector}"))).collect()[0][0]
    return kept.filter(F.size(vector) == F.lit(max(length or 0, 0)))


def whole(values: pa.Array, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of each component, a row for each vector."""
    flat = np.asarray(values.flatten(), np.float64)
    found = np.floor(scale * flat)
    if len(found) and not np.abs(found).max() <= LARGEST:
        raise ValueError(f"components beyond {LARGEST / scale:g} are not supported")
    return found.astype(np.int64).reshape(len(values), -1 if len(values) else 0)


def rows_per_block(length: int) -> int:
    return max(1, BLOCK_BYTES // (8 * max(1, length)))
