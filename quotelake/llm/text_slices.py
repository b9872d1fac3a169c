"""Arrow batches in parts of bounded text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 * 1024 * 1024


def slices(batch: pa.RecordBatch, column: int, most: int | None = None) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most ``most`` bytes of a column (``SLICE_BYTES``), a row at least."""
    most = most or SLICE_BYTES
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
    part = (np.cumsum(sizes, dtype=np.int64) - sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)
