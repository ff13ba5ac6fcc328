"""Small helpers for vector tables: finite rows, numpy views of Arrow batches, written tables."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stressframe.session import ensure_checkpoint_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder and read again."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def usable(vec: Column) -> Column:
    """A vector with at least one component, all of them present and finite."""
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce((F.size(vec) > 0) & fine, F.lit(False))


def matrix(column) -> np.ndarray:
    """Rows of a list column of one length, without nulls, as doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def raw_matrix(column, dtype) -> np.ndarray:
    """Rows of a binary column of one length as a numpy matrix."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), dtype).reshape(len(rows), -1)


def raw_column(rows: np.ndarray) -> pa.Array:
    """The bytes of every matrix row as a binary column."""
    rows = np.ascontiguousarray(rows)
    n, width = len(rows), rows.shape[1] * rows.itemsize
    offsets = pa.py_buffer((np.arange(n + 1, dtype=np.int64) * width).tobytes())
    return pa.Array.from_buffers(pa.large_binary(), n, [None, offsets, pa.py_buffer(rows.tobytes())]).cast(pa.binary())
