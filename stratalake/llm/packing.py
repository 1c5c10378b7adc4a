"""Packing token sequences: first-fit decreasing with a tournament tree of bin capacities, in randomised groups of documents.

A document gives as many whole sequences as it fills; the rest of it is an item. The items of a group are placed, largest
first, each in the first bin that has room: a tournament tree holds the largest free capacity below each node, so that
the bin is found by walking down once. Cutting is free, so the gaps that are left are then filled from the emptiest bins,
and what remains of a group, less than one sequence, is cut at powers of two, which are not padded.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import stored
from .token_output import END, encoder_of

#: Ids of a sequence, and ids and documents of a group on average; bytes of ids that a task packs, about.
CAPACITY, GROUP_TOKENS, GROUP_ROWS, TASK_BYTES = 2048, 1 << 20, 8192, 64 << 20


class Tournament:
    """Free capacities of bins; a node of the tree holds the larger of the two below it."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.free = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """Takes `size` from the first bin that has it, and returns the bin; one bin per item is always enough."""
        free, at = self.free, 1
        while at < self.leaves:
            at *= 2
            if free[at] < size:
                at += 1
        chosen = at - self.leaves
        free[at] -= size
        while at > 1:
            at //= 2
            free[at] = max(free[2 * at], free[2 * at + 1])
        return chosen


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """The items of each bin, by number; ties by number."""
    tree, bins = Tournament(len(sizes), capacity), []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = tree.place(sizes[i])
        if at == len(bins):
            bins.append([])
        bins[at].append(i)
    return bins


def top_up(bins: list[list[list[int]]], capacity: int) -> list[list[list[int]]]:
    """The bins, of pieces [document, start, length], with gaps filled by the ends of pieces in the emptiest bins: all are
    full then but one, which comes last."""
    fill = lambda b: sum(p[2] for p in b)
    bins = sorted(bins, key=fill, reverse=True)
    lo, hi = 0, len(bins) - 1
    gap = capacity - fill(bins[0]) if bins else 0
    while lo < hi:
        if not gap:
            lo += 1
            gap = capacity - fill(bins[lo])
            continue
        doc, start, length = piece = bins[hi][-1]
        taken = min(gap, length)
        bins[lo].append([doc, start + length - taken, taken])
        gap -= taken
        if taken == length:
            bins[hi].pop()
            hi -= not bins[hi]
        else:
            piece[2] -= taken
    return bins[: hi + 1]


def at_powers(pieces: list[list[int]]) -> list[list[list[int]]]:
    """The pieces cut into sequences whose lengths are the powers of two that add up to theirs, largest first."""
    left, out = sum(p[2] for p in pieces), []
    queue = [list(p) for p in reversed(pieces)]
    while left:
        room = size = 1 << left.bit_length() - 1
        out.append([])
        while room:
            doc, start, length = queue.pop()
            taken = min(room, length)
            out[-1].append([doc, start, taken])
            room -= taken
            if taken < length:
                queue.append([doc, start + taken, length - taken])
        left -= size
    return out


def pack(lengths: list[int], capacity: int = CAPACITY, fill: bool = True) -> list[list[list[int]]]:
    """Sequences of pieces [document, start, length] of documents with so many ids each. With `fill`, gaps are filled and the
    last sequence is cut at powers of two; else documents are cut only where they are longer than a sequence."""
    whole = [[[d, lo, capacity]] for d, n in enumerate(lengths) for lo in range(0, n - capacity + 1, capacity)]
    rest = [[d, n - n % capacity, n % capacity] for d, n in enumerate(lengths) if n % capacity]
    bins = [[list(rest[i]) for i in b] for b in first_fit_decreasing([r[2] for r in rest], capacity)]
    if fill and bins:
        bins = top_up(bins, capacity)
        if sum(p[2] for p in bins[-1]) < capacity:
            bins[-1:] = at_powers(bins[-1])
    return whole + bins


def padded(n: int, capacity: int = CAPACITY) -> int:
    """The length to which a sequence of n ids is padded."""
    return n if n & (n - 1) == 0 else capacity


def encode(docs: DataFrame, tokenizer: str, split_on_space: bool) -> DataFrame:
    """Rows (doc_id, n, width, ids) of docs (doc_id, text): the ids of each whole text and the end id, little-endian."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = encoder_of(tokenizer, split_on_space), struct.pack("<I", END)
        for batch in batches:
            for piece, found in encoder.encode_rows(batch):
                raw = [np.frombuffer(r + end, "<u4").astype(f"<u{encoder.width}").tobytes() for r in found]
                n = pa.array([len(r) // encoder.width for r in raw], pa.int64())
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), n, pa.array([encoder.width] * len(raw), pa.int32()), pa.array(raw, pa.binary())], ["doc_id", "n", "width", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, width int, ids binary")


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack_documents(
    docs: DataFrame, tokenizer: str, split_on_space: bool = False, capacity: int = CAPACITY, fill: bool = True,
    group_tokens: int = GROUP_TOKENS, group_rows: int = GROUP_ROWS, with_ids: bool = False,
) -> DataFrame:
    """One row per piece of a document of docs (doc_id, text): doc_id, start (its document's ids before it), length, ids_crc32
    (of the piece's ids as unsigned 32-bit integers), doc_tokens (with the end id), sequence_id and offset (its place in
    the sequence); with_ids adds the ids themselves as an array.

    Every whole text is encoded once and its ids are written to the shared folder; from there each row is dealt to a group
    by a hash of its id and place, so that equal rows and rows of one id spread over all groups, and groups have about
    group_tokens ids and group_rows rows at most. A task packs one group after the other and holds one at a time; groups don't know each other,
    so a lost executor costs its own. A document much longer than a group makes its group that much longer.

    Null and empty texts are documents of the end id alone. Null ids and repeated rows are packed as any other row, each by
    itself. An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    encoded = stored(encode(docs, tokenizer, split_on_space), "encoded")
    total = encoded.agg(F.count("*").alias("rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("ids")).first()
    groups = max(1, -(-total.ids // group_tokens), -(-total.rows // group_rows))
    tasks = min(groups, max(4 * spark.sparkContext.defaultParallelism, 2 * total.ids // TASK_BYTES))
    dealt = encoded.withColumn("row", F.monotonically_increasing_id()).withColumn("g", F.pmod(F.xxhash64("doc_id", "row"), F.lit(groups)))
    dealt = dealt.repartition(tasks, "g").sortWithinPartitions("g", "row").select("g", "doc_id", "width", "ids")

    def packed(g: int, ids: list, documents: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        rows = []
        for number, sequence in enumerate(pack([len(d) for d in documents], capacity, fill)):
            offset = 0
            for d, start, length in sequence:
                mine = documents[d][start : start + length].astype("<u4")
                rows.append((ids[d], start, length, zlib.crc32(mine.tobytes()), len(documents[d]), g << 32 | number, offset, *([mine] if with_ids else ())))
                offset += length
        kinds = [pa.int64()] * 7 + [pa.list_(pa.int64())] * with_ids
        for lo in range(0, len(rows), 4096):
            columns = zip(*rows[lo : lo + 4096])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, ids, documents = None, [], []
        for batch in batches:
            for g, doc, width, raw in zip(*(batch.column(c) for c in ("g", "doc_id", "width", "ids"))):
                if g.as_py() != group:
                    if documents:
                        yield from packed(group, ids, documents)
                    group, ids, documents = g.as_py(), [], []
                ids.append(doc.as_py())
                documents.append(np.frombuffer(raw.as_py(), f"<u{width.as_py()}"))
        if documents:
            yield from packed(group, ids, documents)

    schema = PIECES + ", ids array<long>" * with_ids
    names = [c.split()[0] for c in schema.split(", ")]
    return dealt.mapInArrow(run, schema)


def sequences(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row per sequence of pack_documents(): sequence_id, n_pieces, n_tokens, padding."""
    n = F.col("n_tokens")
    found = pieces.groupBy("sequence_id").agg(F.count("*").alias("n_pieces"), F.sum("length").alias("n_tokens"))
    return found.withColumn("padding", F.when(n.bitwiseAND(n - 1) == 0, F.lit(0)).otherwise(F.lit(capacity) - n).cast("long"))
