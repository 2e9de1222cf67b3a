"""Small helpers shared by the operators that run numpy over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/embeddings.parquet")


def clear_of(df: DataFrame, name: str) -> str:
    """A column name starting with ``name`` that ``df`` lacks, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def as_bytes(text: str | object):
    """The UTF-8 bytes of a text column, null as empty."""
    return F.coalesce(F.col(text).cast("binary") if isinstance(text, str) else text, F.lit(b""))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of a batch's rows with about ``limit`` bytes in ``column``, one row at least."""
    if not batch.num_rows:
        return
    size = np.diff(np.frombuffer(pa_offsets(batch.column(column)), dtype=np.int64))
    ends = np.cumsum(size)
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def pa_offsets(column: pa.Array) -> bytes:
    """The offsets of a binary column as 64-bit integers."""
    wide = column.cast(pa.large_binary())
    offsets = np.frombuffer(wide.buffers()[1], dtype=np.int64)
    return offsets[wide.offset : wide.offset + len(wide) + 1].tobytes()


def added(
    df: DataFrame, text: str, columns: str, make: Callable[[list[bytes]], list[pa.Array]]
) -> DataFrame:
    """``df`` with new columns (a DDL string) that ``make`` computes from the texts' bytes.

    A column of ``df`` with the name of a new one gives way to it. ``make`` gets
    the texts of about a megabyte at a time, null as empty.
    """
    from pyspark.sql.types import StructType  # noqa: PLC0415

    new = StructType.fromDDL(columns)
    names = {f.name.lower() for f in new}
    raw = clear_of(df, "raw_text")
    kept = [c for c in df.columns if c.lower() not in names]
    source = df.select(*[F.col(f"`{c}`") for c in kept], as_bytes(f"`{text}`").alias(raw))
    schema = StructType([f for f in source.schema.fields if f.name != raw] + new.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, raw):
                texts = part.column(raw).to_pylist()
                arrays = [part.column(c) for c in kept] + make(texts)
                yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in schema])

    return source.mapInArrow(run, schema)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every run, one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)
