"""What the workers of several operators share: slices of Arrow batches, and memos of words that are bounded in bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Rows and bytes of text of a slice; bytes that an entry of a memo takes besides its word and value.
SLICE_ROWS, SLICE_BYTES, ENTRY_BYTES = 256, 1 << 20, 160


def slices(batch: pa.RecordBatch, column: str, rows: int = SLICE_ROWS, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, in slices of at most `rows` rows with `size` bytes in `column`, or of one longer row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(ends):
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, min(lo + rows, int(np.searchsorted(ends, before + size, "right"))))
        yield batch.slice(lo, hi - lo)
        lo = hi


class Memo(dict):
    """Bytes by word, for words met in a second batch: words met once are most of all, and only leave a mark."""

    def __init__(self, marks: int = 1 << 22):
        super().__init__()
        self.met, self.marked, self.held = bytearray(marks), 0, 0

    def remember(self, fresh: dict) -> None:
        """Takes words that were met before, and marks the others as met. A mark may stand for several words, which only
        lets one in early."""
        if self.marked > len(self.met) // 2:
            self.met, self.marked = bytearray(len(self.met)), 0
        met, marks = self.met, len(self.met)
        for w, raw in fresh.items():
            at = hash(w) % marks
            if met[at]:
                self[w] = raw
                self.held += ENTRY_BYTES + len(w) + len(raw)
            else:
                met[at] = 1
                self.marked += 1

    def bound(self, most: int, most_bytes: int) -> None:
        """Forgets all words where there are over `most` or they hold over `most_bytes`."""
        if len(self) > most or self.held > most_bytes:
            self.clear()
            self.held = 0
