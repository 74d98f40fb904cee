"""Vector columns as numpy matrices, for the operators on embeddings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from rivulet.llm.util import by_value


def vector_column(df: DataFrame, name: str) -> Column:
    """The column as an array of float or double."""
    kind = df.schema[name].dataType
    if not isinstance(kind, ArrayType):
        raise TypeError(f"{name} is {kind.simpleString()}, not an array of numbers")
    held = isinstance(kind.elementType, (FloatType, DoubleType))
    return F.col(f"`{name}`") if held else F.col(f"`{name}`").cast("array<double>")


def finite(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(row numbers, matrix)`` by length, of the rows whose vector is there
    and has finite entries only; the entries as doubles."""
    n = len(column)
    if not n:
        return
    off = column.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    v = pc.cast(column.values, pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(v))])
    size = np.diff(off)
    ok = column.is_valid().to_numpy(zero_copy_only=False) & (bad[off[1:]] == bad[off[:-1]])
    for length in np.unique(size[ok]).tolist():
        rows = np.flatnonzero(ok & (size == length))
        yield rows, v[off[rows][:, None] + np.arange(length)]


def floors(matrix: np.ndarray, scale: float) -> np.ndarray:
    """``floor(scale * entry)`` as 64-bit integers; an entry that does not fit
    62 bits is an error, as an overflow in SQL is."""
    x = np.floor(scale * matrix)
    if x.size and not np.abs(x).max() < 2.0 ** 62:
        raise OverflowError("a vector entry times the scale does not fit 64 bits")
    return x.astype(np.int64)


by_value(__name__)
