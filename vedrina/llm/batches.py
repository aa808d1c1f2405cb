"""Arrow batches in parts of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A part has about this many bytes of text, or one longer text.
PART_BYTES = 1 << 20


def parts(batches: Iterator[pa.RecordBatch], text: int, most: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in order, cut where the text column (by its place) reaches ``most`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes) // most
        starts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [batch.num_rows]])
        for start, end in zip(starts[:-1], starts[1:]):
            yield batch.slice(int(start), int(end - start))
