"""Embeddings as rows of whole numbers, and blocks of them in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import slices

#: Entries as whole numbers stay below this, so that 64 squared differences fit 63 bits.
BOUND = 1 << 27
#: Rows that are worked on at once.
ROWS = 4096


def whole_numbers(vectors: DataFrame, dim: int, scale: int = 1024, shift: int = 0) -> DataFrame:
    """vec_id and x (array<int>): floor(scale * entry) + shift, entries as doubles, of the vectors that have dim entries, none null or not finite; other vectors are left out.

    Repeated rows stay, as do null ids; columns besides vec_id and embedding do not travel, so none can clash. An entry whose number is not below BOUND raises an error, since no distance of it would fit a long.
    """
    number = lambda c: F.floor(c.cast("double") * scale) + shift
    usable = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    fits = lambda x: F.when(F.abs(x) < BOUND, x).otherwise(F.raise_error(F.lit(f"an entry of a vector exceeds {BOUND} as a whole number"))).cast("int")
    rows = vectors.select("vec_id", "embedding").where((F.size("embedding") == dim) & usable)
    return rows.select("vec_id", F.transform("embedding", lambda c: fits(number(c))).alias("x"))


def blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Parts of the batches of (vec_id, x), each with its x as a matrix of 64-bit numbers."""
    for batch in batches:
        for part in slices(batch, ROWS):
            if part.num_rows:
                yield part, part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(part.num_rows, dim)


def totals(rows: DataFrame, kind: str) -> dict[int, object]:
    """Sums of (entry, value) rows by entry. There are as many entries as the caller's matrices have places, whatever the table's size."""
    return {r["entry"]: r["total"] for r in rows.groupBy("entry").agg(F.sum(F.col("value").cast(kind)).alias("total")).collect()}
