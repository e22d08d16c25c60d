"""Passing over texts in Arrow batches, in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc

# Text per piece. What a function makes of a piece is a small multiple of this.
PIECE_BYTES = 4 << 20


def pieces(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches with their texts (column ``text`` by position; null becomes empty)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        start, size = 0, 0
        for at, more in enumerate(sizes):
            size += more
            if size >= PIECE_BYTES or at == len(sizes) - 1:
                piece = batch.slice(start, at + 1 - start)
                yield piece, [t or "" for t in piece.column(text).to_pylist()]
                start, size = at + 1, 0
