"""Near-duplicates by SimHash, found through a segment-popcount embedding.

A fingerprint's 64 bits are 32 segments of two bits, and its embedding holds the number of set bits of each segment in
unary form, so that the Manhattan distance of two embeddings is the number of bits in which they differ. It never
exceeds the Hamming distance. The segments are dealt into G groups; fingerprints within distance D agree in the
embedding of G - D groups at least. Each choice of so many groups is a grid whose cells are the embedding's values there,
so all pairs within reach share a cell of some grid. That is the range join under the Manhattan distance: each differing
segment adds one or two to the distance, so of embeddings at most D apart D segments differ at most, which lie in D of
the G groups at most; and the grid over the others holds both in one cell. Within every cell, however large, the Manhattan
bound is tested first, then the Hamming distance.

Only distinct fingerprints are joined, so copies cost nothing. Cells of more than BLOCK members are parted into blocks
and each pair of blocks is a task's work of bounded size; from a cell come the links of a spanning forest, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import looked_up, stored
from .components import components

#: Words of a shingle, seed of its hash, most differing bits of a link, members of a block, cells whose pairs are all emitted.
SHINGLE, SEED, DISTANCE, BLOCK, SMALL = 4, 42, 4, 2048, 16
LOW = 0x5555555555555555
#: For each byte, its bits spread over the bytes of a 64-bit integer.
SPREAD = np.array([sum(1 << 8 * i for i in range(8) if b >> i & 1) for b in range(256)], np.uint64)


def fingerprint_of(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The fingerprints of documents whose shingle hashes stand one after the other, counts[i] of them for document i."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    n = counts[full]
    pieces = -(-n // 255)  # a byte counts to 255
    starts = np.repeat(np.cumsum(n) - n, pieces) + 255 * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    first = np.cumsum(pieces) - pieces
    for byte in range(8):
        part = np.add.reduceat(SPREAD[(hashes >> np.uint64(8 * byte)).astype(np.uint8)], starts)
        bits = np.add.reduceat(part.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
        out[full] |= np.packbits(bits * 2 > n[:, None], axis=1, bitorder="little")[:, 0].astype(np.uint64) << np.uint64(8 * byte)
    return out


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """The SimHash of each whole text as a long (its 64 bits, signed).

    Words are runs of characters other than space and tab to carriage return, A-Z in lower case; the shingles are all
    runs of `shingle` words, repeats included, or the whole sequence where there are fewer words. A bit is 1 if it is set
    in over half of the shingles' XXH64 values. Null, empty and blank texts have fingerprint 0.
    """

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        digest, join = xxhash.xxh64_intdigest, b" ".join
        for batch in batches:
            out = []
            texts = batch.tolist()
            for lo in range(0, len(texts), 256):
                hashes, counts = [], []
                for t in texts[lo : lo + 256]:
                    w = (t or "").encode("utf-8", "replace").lower().split()
                    if 0 < len(w) < shingle:
                        got = [digest(join(w), SEED)]
                    else:
                        got = [digest(join(s), SEED) for s in zip(*(w[i:] for i in range(shingle)))]
                    hashes.append(np.array(got, np.uint64))
                    counts.append(len(got))
                out.append(fingerprint_of(np.concatenate(hashes), np.array(counts)))
            yield pd.Series(np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64))

    return run(text)


def embedding(bits: Column) -> Column:
    """The popcount of each two-bit segment in unary form: the segment's bits with the set ones moved down."""
    a, b = bits.bitwiseAND(LOW), F.shiftrightunsigned(bits, 1).bitwiseAND(LOW)
    return a.bitwiseOR(b).bitwiseOR(F.shiftleft(a.bitwiseAND(b), 1))


def grids(groups: int, distance: int) -> list[int]:
    """The masks of the grids: the segments of every choice of groups - distance groups, as a signed 64-bit integer."""
    edges = [32 * g // groups for g in range(groups + 1)]
    masks = [sum(3 << 2 * s for s in range(a, b)) for a, b in zip(edges, edges[1:])]
    chosen = (sum(c) for c in combinations(masks, groups - distance))
    return [m - (1 << 64) if m >> 63 else m for m in chosen]


def unary_of(members: np.ndarray) -> np.ndarray:
    """embedding() of whole arrays."""
    low = np.uint64(LOW)
    a, b = members & low, members >> np.uint64(1) & low
    return a | b | (a & b) << np.uint64(1)


def forest(members: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all members within reach of each other, one less than the members of each class."""
    unary = unary_of(members)
    left, a, b = np.arange(len(members)), [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(unary[left] ^ unary[at]) <= distance  # the Manhattan bound
            near[near] = np.bitwise_count(members[left[near]] ^ members[at]) <= distance
            if near.any():
                found = left[near]
                left = left[~near]
                queue.extend(found.tolist())
                a.append(np.full(len(found), at))
                b.append(found)
    none = [np.zeros(0, np.int64)]
    return members[np.concatenate(a or none)], members[np.concatenate(b or none)]


def linked(flat: np.ndarray, offsets: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within cells whose members stand one after the other in flat."""
    a, b, size = [], [], np.diff(offsets)
    for m in np.unique(size[size > 1]):
        at = offsets[:-1][size == m]
        if m > 64:
            for lo in at:
                x, y = forest(flat[lo : lo + m], distance)
                a.append(x), b.append(y)
            continue
        i, j = np.triu_indices(m, 1)
        for lo in range(0, len(at), step := max(1, 2_000_000 // len(i))):
            cells = flat[at[lo : lo + step, None] + np.arange(m)]
            unary = unary_of(cells)
            k, p = np.nonzero(np.bitwise_count(unary[:, i] ^ unary[:, j]) <= distance)  # the Manhattan bound
            x, y = cells[k, i[p]], cells[k, j[p]]
            near = np.bitwise_count(x ^ y) <= distance
            if m <= SMALL:
                a.append(x[near]), b.append(y[near])
            else:
                for c in np.unique(k[near]):
                    x, y = forest(cells[c], distance)
                    a.append(x), b.append(y)
    none = [np.zeros(0, np.uint64)]
    return np.concatenate(a or none), np.concatenate(b or none)


def links(prints: DataFrame, distance: int = DISTANCE, groups: int | None = None) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp, long, each once) that give the same classes as all pairs
    with at most `distance` differing bits. `groups` sets the grids' fineness; by default more groups for more rows,
    so that the members of a cell stay few.
    """
    n = prints.count()
    if groups is None:
        groups = distance + (2 if n < 3_000_000 else 3 if n < 300_000_000 else 4)
    masks = grids(groups, distance)
    cells = prints.select("fp", embedding(F.col("fp")).alias("e")).select(
        "fp", F.posexplode(F.array(*[F.col("e").bitwiseAND(F.lit(m)) for m in masks])).alias("grid", "cell")
    )
    many = cells.groupBy("grid", "cell").agg(F.count("*").alias("n")).where("n > 1")
    many = many.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks").cast("long")).cast("int")
    paired = (
        looked_up(cells, many, ["grid", "cell"], n * len(masks)).withColumn("own", own)
        .select("fp", "grid", "cell", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .groupBy("grid", "cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
        .agg(F.sort_array(F.collect_set("fp")).alias("members"))
        .select("members")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            a, b = linked(lists.values.to_numpy(zero_copy_only=False).view(np.uint64), lists.offsets.to_numpy().astype(np.int64), distance)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return paired.mapInArrow(run, "a long, b long")


def classes(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Rows (doc_id, text_hash, fp, root, component_id), one for each row of docs (doc_id, text).

    Fingerprints link at `distance` or fewer differing bits; component_id is the smallest doc_id reachable over links, a
    document itself and those with its fingerprint included. Null ids are passed over for the smallest; a component of
    null ids only has a null component_id. Empty and null texts share fingerprint 0, which links like any other. Rows of a
    fingerprint that very many documents share, or of a class of very many fingerprints, are not gathered.
    """
    prints = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), fingerprint(F.col("text")).alias("fp")), "prints")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "distinct")
    found = components(links(distinct.select("fp"), distance)).withColumnRenamed("node", "fp")
    linked = stored(distinct.join(found, "fp"), "linked")  # each fingerprint stands once on both sides
    named = linked.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n"))
    together = looked_up(linked.withColumnRenamed("n", "rows"), named, ["root"], linked.count()).select("fp", F.col("rows").alias("n"), "root", "component_id")
    alone = distinct.join(linked.select("fp"), "fp", "left_anti").select("fp", "n", F.col("fp").alias("root"), F.col("least").alias("component_id"))
    return looked_up(prints, stored(together.unionByName(alone), "rooted"), ["fp"], prints.count())


def deduplicate(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """docs with one row of each class: the one with the smallest doc_id, and of its rows that with the least text hash.

    Classes are those of classes(); all columns stay. A class of null ids only keeps the row with the least text hash;
    of equal rows one stays.
    """
    found = stored(classes(docs.select("doc_id", "text"), distance), "classes")
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("first"))
    first = stored(first.select("first.doc_id", "first.text_hash").withColumnsRenamed({"doc_id": "_stratalake_keep_id", "text_hash": "_stratalake_keep_hash"}), "kept")
    tagged = docs.withColumn("_stratalake_row_hash", F.xxhash64("text"))
    kept = tagged.join(first, tagged["doc_id"].eqNullSafe(first["_stratalake_keep_id"]) & (tagged["_stratalake_row_hash"] == first["_stratalake_keep_hash"]), "left_semi")
    if not found.groupBy("doc_id", "text_hash").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", "_stratalake_row_hash"])
    return kept.drop("_stratalake_row_hash")
