"""Vectors as rows of doubles, for the operators on embeddings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIELDS = "vec_id long, label long, dim int, vec binary"


def _usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in batches:
        column = part.column("embedding")
        offsets = column.offsets.to_numpy()
        flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
        sizes = np.diff(offsets)
        vectors = []
        for lo, hi in zip(offsets[:-1], offsets[1:], strict=True):
            v = flat[lo:hi]
            # a null component is NaN here; a norm under- or overflows only at the ends of doubles
            norm = np.sqrt((v * v).sum()) if len(v) else 0.0
            vectors.append(v.tobytes() if norm > 0 and np.isfinite(norm) else None)
        rows = pa.RecordBatch.from_arrays(
            [part.column("vec_id"), part.column("label"), pa.array(sizes, pa.int32()), pa.array(vectors, pa.binary())],
            names=["vec_id", "label", "dim", "vec"],
        )
        yield rows.filter(rows.column("vec").is_valid())


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, label, dim, vec: doubles) of the rows that have a vec_id and a vector with a
    direction: not null, not zero, no null or non-finite component."""
    label = F.col("label").cast("long") if "label" in rows.columns else F.lit(None).cast("long")
    return (
        rows.where("vec_id IS NOT NULL AND embedding IS NOT NULL")
        .select(
            F.col("vec_id").cast("long"),
            label.alias("label"),
            F.col("embedding").cast("array<double>"),
        )
        .mapInArrow(_usable, FIELDS)
    )


def matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(-1, dim)


def norms(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows * rows).sum(axis=1))


def cosines(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Row by row; equal rows give equal values, wherever they lie."""
    return (one * other).sum(axis=1) / (norms(one) * norms(other))
