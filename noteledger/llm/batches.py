"""Arrow batches cut by the bytes they hold."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def by_bytes(batches: Iterator[pa.RecordBatch], column: str, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of about ``size`` bytes of a text column, one row at least."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(lengths) - lengths) // size
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(batch)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)
