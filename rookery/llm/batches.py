"""Small pieces shared by the Arrow operators: slices of bounded size and null-safe text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

SLICE_BYTES = 2 << 20
ENCODED_BYTES = 6 << 20


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the named string column holds about ``limit`` bytes at most (one long row stays whole)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        start = held = 0
        for row, size in enumerate(lengths.tolist()):
            if held and held + size > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The strings of a column, null as empty."""
    return batch.column(column).fill_null("").to_pylist()


def packed(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """A binary column of the raw bytes of ``values`` between successive starts."""
    offsets = pa.py_buffer((starts * values.itemsize).astype(np.int32))
    return pa.BinaryArray.from_buffers(pa.binary(), len(starts) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(values))])
