"""Vectors as whole numbers, for operators whose results are integers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lists(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list per row of a matrix."""
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel(), kind))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The rows of a list column as a matrix; all lists have ``width`` elements."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _whole(batch: pa.RecordBatch, scale: float, limit: int) -> pa.RecordBatch:
    batch = batch.filter(pc.is_valid(batch.column(2)))
    column = batch.column(2)
    sizes = pc.list_value_length(column).to_numpy().astype(np.int64)
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    good = np.ones(len(sizes), bool)
    good[row[~np.isfinite(x)]] = False
    x = np.clip(np.floor(x[good[row]] * scale), -limit, limit).astype(np.int32)
    offsets = np.concatenate([[0], np.cumsum(sizes[good])]).astype(np.int32)
    kept = batch.filter(pa.array(good))
    return pa.RecordBatch.from_arrays(
        [kept.column(0), kept.column(1), pa.ListArray.from_arrays(pa.array(offsets), pa.array(x))], ["vec_id", "label", "v"]
    )


def whole_numbers(embeddings: DataFrame, scale: float, limit: int) -> DataFrame:
    """``vec_id, label, v`` of the usable rows, ``v`` being floor(scale * x) of each component.

    Null vectors and those with null or non-finite components are left out. Numbers
    beyond ``limit`` either way count as the limit, so that distances and products fit.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("v", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(lambda batches: (_whole(batch, scale, limit) for batch in batches), schema)


def common_size(rows: DataFrame) -> int | None:
    """The size that most vectors have, the smaller one of a tie; None without rows."""
    sizes = rows.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n"))
    found = sizes.orderBy(F.desc("n"), "size").first()
    return found and found["size"]
