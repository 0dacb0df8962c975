"""Embedding vectors as exact integers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is there and has only finite components."""
    finite = F.forall(vector.cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def quantized(vector: Column, scale: int, most: int) -> Column:
    """Each component x as the integer floor(scale * x), x as double. A magnitude over `most`
    raises an error: what is computed from it would leave a long."""

    def number(x):
        y = F.floor(scale * x)
        return F.when(F.abs(y) <= most, y).otherwise(F.raise_error(F.lit(f"a vector component is over {most / scale}"))).cast("int")

    return F.transform(vector.cast("array<double>"), number)


def matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of a list column as an int64 matrix, with zeros after shorter lists."""
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    sizes = np.diff(offsets)
    width = int(sizes.max(initial=0)) if width is None else width
    if (sizes == width).all():
        return flat.reshape(len(sizes), width).astype(np.int64)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = flat
    return out
