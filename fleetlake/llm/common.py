"""Helpers the operators share: tables, row keys, Arrow text buffers, word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.session import scratch_path, staged
from fleetlake.sources.paths import remove

#: Bytes of text that numpy works on at a time; a longer document makes a chunk alone.
CHUNK = 1 << 20
#: Words of a shingle.
SHINGLE = 5

_BASE = 0xB504F32D9E3779B9
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def row_keys(text: str = "text") -> tuple[Column, Column]:
    """Two columns that tell rows apart by doc_id and text; equal rows share them.

    A missing doc_id or text counts as a value of its own.
    """
    return (
        F.coalesce(F.col("doc_id"), F.lit(-(2**63) + 1)).cast("long").alias("k1"),
        F.xxhash64(F.col(text), F.col(text).isNull(), F.col("doc_id").isNull()).alias("k2"),
    )


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def extended(df: DataFrame, *fields: tuple[str, T.DataType]) -> T.StructType:
    """The schema of ``df`` with more columns."""
    return T.StructType([*df.schema.fields, *(T.StructField(n, t) for n, t in fields)])


def held_out(modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; a missing id is never held out."""
    digest = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(digest % modulus == remainder, F.lit(False))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows and their offsets; null counts as empty."""
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)
    bounds = bounds[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def chunks(bounds: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold at most ``limit`` bytes, or one row."""
    first, rows = 0, len(bounds) - 1
    while first < rows:
        last = int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(max(n, CHUNK + 1), base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which ``span_hashes`` gives the hash of any stretch of bytes."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data) + 1)[0][: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    raw = (sums[end] - sums[start]) * powers(len(sums))[1][start]
    return mixed(raw + (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*b"0123456789abcdefghijklmnopqrstuvwxyz_"]] = True
_WORD_BYTE[128:] = True


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and where each row's words begin.

    A word is a run of lower-case ASCII letters, digits, underscores and bytes of other
    characters; rows never share one.
    """
    flag = _WORD_BYTE[data]
    first, last = flag.copy(), flag.copy()
    first[1:] &= ~flag[:-1]
    last[:-1] &= ~flag[1:]
    inner = bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(data))]
    first[inner] = flag[inner]
    last[inner - 1] = flag[inner - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, bounds)


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, at = words(data, bounds)
    return span_hashes(prefix_sums(data), starts, ends), at


def shingle_hashes(word: np.ndarray, at: np.ndarray, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words and where each row's begin.

    A row of fewer words has one shingle of all of them, a row without words none.
    """
    counts = np.diff(at)
    base = powers(n + 1)[0]
    full = np.zeros(max(len(word) - n + 1, 0), np.uint64)
    for k in range(n):
        full += word[k : k + len(full)] * base[k]
    made = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    begin = np.concatenate([[0], np.cumsum(made)])
    row = np.repeat(np.arange(len(made)), made)
    source = at[row] + np.arange(len(row)) - begin[row]
    out = full[np.minimum(source, max(len(full) - 1, 0))] if len(full) else np.zeros(len(row), np.uint64)
    for r in np.flatnonzero((counts > 0) & (counts < n)):
        few = word[at[r] : at[r + 1]]
        out[begin[r]] = (few * base[: len(few)]).sum(dtype=np.uint64) + np.uint64(len(few))
    return mixed(out), begin


def lowered(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(column, ""))


def slices(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Chunks of rows with their bytes and offsets."""
    data, bounds = text_buffer(column)
    for first, last in chunks(bounds, limit):
        part = bounds[first : last + 1]
        yield first, last, data[part[0] : part[-1]], part - part[0]


class Scratch:
    """Tables in the shared folder that a job writes on its way, dropped once nothing needs them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._paths: dict[int, tuple[DataFrame, str]] = {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written and read back."""
        path = scratch_path(self.spark, name)
        written = staged(df, path)
        self._paths[id(written)] = written, path
        return written

    def drop(self, *tables: DataFrame) -> None:
        for one in tables:
            remove(self.spark, self._paths.pop(id(one))[1])


def as_long(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))
