"""Arrow batches in small slices, so that Python objects exist for a few rows at a time."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa

ROWS = 256


def sliced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def values(array: pa.Array) -> Iterator:
    for at in range(0, len(array), ROWS):
        yield from array.slice(at, ROWS).to_pylist()
