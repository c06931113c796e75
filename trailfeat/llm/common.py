"""Small helpers that the corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Words of a text are maximal runs of bytes outside this set (``\x20 \x09-\x0D``).
ASCII_SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def slices(batch: pa.RecordBatch, text_index: int, max_bytes: int = 16 << 20,
           column: pa.Array | None = None) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of a slice hold about ``max_bytes`` (one row at least).

    The texts are the column at ``text_index``, or ``column`` where they lie inside a struct.
    """
    n = batch.num_rows
    if n == 0:
        return
    if batch.nbytes <= max_bytes:
        yield batch
        return
    sizes = (batch.column(text_index) if column is None else column).to_pandas().str.len().fillna(0).astype(int).tolist()
    start, size = 0, 0
    for i in range(n):
        size += sizes[i]
        if size >= max_bytes:
            yield batch.slice(start, i + 1 - start)
            start, size = i + 1, 0
    if start < n:
        yield batch.slice(start)


def texts(column: pa.Array) -> list[str]:
    """Python strings of a text column; null is the empty text."""
    return [t if t is not None else "" for t in column.to_pylist()]


def row_struct(df: DataFrame) -> F.col:
    """All columns of ``df`` as one struct, so that working columns cannot clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])
