"""Small helpers for functions that Spark applies to Arrow batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Text of one slice; a single longer text makes a slice of its own.
SLICE_BYTES = 8 << 20


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of ``column``, so that memory does not follow batch sizes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            yield batch.slice(start, end - start)


def as_bytes(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The UTF-8 bytes of each text; null is empty."""
    return pc.fill_null(batch.column(column).cast(pa.binary()), b"").to_pylist()


def as_text(batch: pa.RecordBatch, column: str) -> list[str]:
    """Each text; null is empty."""
    return pc.fill_null(batch.column(column), "").to_pylist()
