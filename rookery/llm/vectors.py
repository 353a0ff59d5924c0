"""Small pieces shared by the vector operators of this round: sound rows, exact matrices, sums that cross tasks."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOTALS = "row int, place int, total decimal(38,0)"
_TOTALS = pa.schema([("row", pa.int32()), ("place", pa.int32()), ("total", pa.decimal128(38, 0))])


def sound(vectors: DataFrame, key: str, vector: str, *others: str) -> DataFrame:
    """(id, vec, others): vectors as doubles, without those that are null, empty or hold null or non-finite entries.

    Only vectors of one length can be compared: those of the length that most rows have take part, the longer on a tie.
    """
    values = F.col(vector).cast("array<double>")
    finite = ~F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = vectors.where(F.size(vector) > 0).where(finite).select(
        F.col(key).cast("long").alias("id"), values.alias("vec"), *others
    )
    usual = kept.groupBy(F.size("vec").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    return kept.where(F.size("vec") == (usual["dims"] if usual else 0))


def integers(scale: int):
    """Column of floor(scale * x); what a long cannot hold becomes its end."""
    return F.transform("vec", lambda x: F.floor(x * scale).cast("long"))


def matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """The equally long lists of a column as rows."""
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def as_longs(values: np.ndarray) -> pa.Array:
    """Integers of any size as a long column, null where a long cannot hold them."""
    if values.dtype != object:
        return pa.array(values, pa.int64())
    return pa.array([int(v) if abs(v) < 2**63 else None for v in values], pa.int64())


def totals_batch(totals: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row for each entry of a matrix of integers of any size, its zeros left out."""
    rows, places = np.nonzero(totals)
    values = [Decimal(int(v)) for v in totals[rows, places]]
    yield pa.RecordBatch.from_arrays(
        [pa.array(rows, pa.int32()), pa.array(places, pa.int32()), pa.array(values, pa.decimal128(38, 0))], schema=_TOTALS
    )


def summed(parts: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    """Exact entry-wise sum of the tasks' matrices, as Python integers; the driver gets one row for each entry."""
    out = np.zeros(shape, object)
    found = parts.groupBy("row", "place").agg(F.sum("total").alias("total")).toArrow()
    for row, place, total in zip(*(found.column(c).to_pylist() for c in ("row", "place", "total"))):
        out[row, place] = int(total)
    return out
