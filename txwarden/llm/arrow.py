"""Arrow batches cut into pieces of bounded size, so that a task's memory does not depend on the batch setting."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# A piece ends at this many bytes of text; one longer text is a piece of its own.
PIECE_BYTES = 1 << 20


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column end to end, and where each text starts (n + 1 values). Null is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    if len(texts) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    where = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data, np.uint8)[where[0] : where[-1]], where - where[0]


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with at most PIECE_BYTES of text (one text at least), with its bytes and starts."""
    for batch in batches:
        data, starts = text_bytes(column(batch, text))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(starts, starts[first] + PIECE_BYTES, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first), data[starts[first] : starts[last]], starts[first : last + 1] - starts[first]
            first = last
