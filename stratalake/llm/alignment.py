"""Cross-tokenizer alignment: which tokens of two tokenizers cover common bytes of a text.

Both sides cut the same bytes (a space and the text) into tokens. In batches of documents laid end to end, pandas'
merge_asof, keyed by document, finds for each token's start the other side's token that covers it. The union of both
directions is every overlapping pair, and starts that are equal on both sides part the tokens into groups.

Pairs of a document, in order, are a path on which every step moves on by a token of A, of B, or of both, so two bits
each keep them beside the ids. Pairs are counted over the corpus by the tasks; a document is then scored against the
counts, which are sent to all tasks up to a bound and joined by a shuffle beyond it.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .batches import slices
from .common import looked_up, stored

#: Bytes of text aligned at a time, distinct pairs that a task holds before it unites them, distinct pairs sent to all tasks.
TEXT_BYTES, TASK_PAIRS, SENT_PAIRS = 1 << 19, 1 << 21, 4_000_000
#: Fixed value: the pattern by which byte-level vocabularies of this kind cut a text before they merge.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters on whose kinds two libraries may differ; texts with one are left to the vocabulary's own.
RARE = re.compile(r"[^\x00-\x1b\x20-\u024f\u2010-\u2027\u2030-\u205e]")


def byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 stands for itself, the other bytes
    in order for the characters from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or b >= 161 and b != 173]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Sides:
    """Both tokenizers, with the bytes of each token."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a_path), SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        byte, entries = byte_of_character(), self.a.get_vocab()
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.a_bytes[i] = bytes(byte[c] for c in entry) if all(c in byte for c in entry) else entry.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]
        self.lengths = tuple(np.array([len(x) for x in of], np.int64) for of in (self.a_bytes, self.b_bytes))
        self.plain = self.merger(json.loads(self.a.to_str()))
        self.names = np.array([b"%d%s" % (i, end) for of, ends in ((self.a_bytes, b",|"), (self.b_bytes, b",;")) for i in range(len(of)) for end in (ends[:1], ends[1:])], object)

    def merger(self, spec: dict):
        """An encoder with side A's own vocabulary that is several times as fast; None unless that is byte-level, leaves texts as
        they are and numbers its entries in the order of their merges, so that both give the same ids."""
        cut = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or cut.get("type") != "ByteLevel" or cut["add_prefix_space"] or not cut["use_regex"] or spec["model"]["type"] != "BPE":
            return None
        import tiktoken

        entries = spec["model"]["vocab"]
        made = [entries["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
        special = {t["id"] for t in spec["added_tokens"]}
        if made != list(range(256, 256 + len(made))) or set(entries.values()) - special != set(range(256 + len(made))):
            return None
        return tiktoken.Encoding("side_a", pat_str=PATTERN, mergeable_ranks={self.a_bytes[i]: i for i in entries.values() if i not in special}, special_tokens={})

    def encode_a(self, text: str) -> list[int]:
        """Ids of a space and the text."""
        if self.plain is None or RARE.search(text):
            return self.a.encode(" " + text, add_special_tokens=False).ids
        return self.plain.encode_ordinary(" " + text)

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids on both sides; none for empty texts and those that one side doesn't give back byte by byte."""
        none, at = np.zeros(0, "<u4"), [i for i, t in enumerate(texts) if t]
        a, b = [none] * len(texts), [none] * len(texts)
        for i, y in zip(at, self.b.encode([texts[i] for i in at], num_threads=1)):
            whole = (" " + texts[i]).encode("utf-8", "surrogatepass")
            if b"".join(map(self.b_bytes.__getitem__, y)) == whole:
                x = self.encode_a(texts[i])
                if self.plain is not None or b"".join(map(self.a_bytes.__getitem__, x)) == whole:  # plain: texts stay as they are
                    a[i], b[i] = np.array(x, "<u4"), np.array(y, "<u4")
        return a, b


@lru_cache(maxsize=1)
def sides_of(a_path: str, b_path: str) -> Sides:
    """The tokenizers of this worker process."""
    return Sides(a_path, b_path)


class Links(NamedTuple):
    """Overlaps of documents laid end to end: for each, the places of its two tokens; and the tokens at which groups begin."""

    a: np.ndarray
    b: np.ndarray
    a_first: np.ndarray
    b_first: np.ndarray


def overlaps(a_start: np.ndarray, a_doc: np.ndarray, b_start: np.ndarray, b_doc: np.ndarray) -> Links:
    """All pairs of tokens with common bytes, in order, by merge_asof in both directions. Starts rise over all documents."""
    left = pd.DataFrame({"at": a_start, "doc": a_doc, "a": np.arange(len(a_start)), "a_at": a_start})
    right = pd.DataFrame({"at": b_start, "doc": b_doc, "b": np.arange(len(b_start)), "b_at": b_start})
    covers_a = pd.merge_asof(left, right, on="at", by="doc")  # the token of B over each start of A
    covers_b = pd.merge_asof(right, left, on="at", by="doc")
    both = (covers_a["at"] == covers_a["b_at"]).to_numpy()
    more = (covers_b["at"] != covers_b["a_at"]).to_numpy()  # where starts are equal, the other direction has the pair
    a = np.r_[covers_a["a"].to_numpy(), covers_b["a"].to_numpy()[more]].astype(np.int64)
    b = np.r_[covers_a["b"].to_numpy(), covers_b["b"].to_numpy()[more]].astype(np.int64)
    order = np.argsort(a + b, kind="stable")  # every step of the path raises the sum
    return Links(a[order], b[order], covers_a["a"].to_numpy()[both], covers_a["b"].to_numpy()[both].astype(np.int64))


def group_text(names: np.ndarray, a: np.ndarray, b: np.ndarray, links: Links, a_size: int) -> np.ndarray:
    """The tokens of both sides in the order of groups, A before B, as ids with the mark that follows each."""
    a_last, b_last = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    a_last[np.r_[links.a_first[1:] - 1, len(a) - 1]] = 1
    b_last[np.r_[links.b_first[1:] - 1, len(b) - 1]] = 1
    a_sizes, b_sizes = np.diff(np.r_[links.a_first, len(a)]), np.diff(np.r_[links.b_first, len(b)])
    out = np.empty(len(a) + len(b), object)
    out[np.arange(len(a)) + np.repeat(links.b_first, a_sizes)] = names[2 * a.astype(np.int64) + a_last]
    out[np.arange(len(b)) + np.repeat(links.a_first + a_sizes, b_sizes)] = names[2 * (a_size + b.astype(np.int64)) + b_last]
    return out


def united(pairs: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs in order, with the sums of their counts."""
    p, c = np.concatenate(pairs), np.concatenate(counts)
    order = np.argsort(p, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(p[order]) != 0])
    return p[order][first], np.add.reduceat(c[order], first)


ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, width int, a binary, b binary, a_moves binary, b_moves binary"
)


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """The alignment of each whole text of docs (doc_id, text), written to the shared folder: rows of ALIGNED, one per row of docs,
    and, with those columns null, rows (pair, pair_n) of the counts of each task. a and b are the ids; a_moves and b_moves
    have a bit per link, set where it moves on to the side's next token, which the first of a document does on both.

    Texts that are null or empty, or that a side does not give back as they are, have no tokens: their counts are 0 and
    groups_sha256 is ''. Null ids and repeated rows are rows like any other; other columns are not read. Tasks hold
    TEXT_BYTES of text at a time, or one longer text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = sides_of(a_path, b_path)
        width = 2 if max(map(len, sides.lengths)) <= 1 << 16 else 4
        pairs, counts, held = [], [], 0
        for batch in batches:
            for piece in slices(batch, "text", 1024, TEXT_BYTES):
                a, b = sides.encode([t or "" for t in piece.column("text").to_pylist()])
                n_a, n_b = (np.array([len(x) for x in of], np.int64) for of in (a, b))
                places = np.arange(len(a))
                flat_a, flat_b, doc_a, doc_b = np.concatenate(a), np.concatenate(b), np.repeat(places, n_a), np.repeat(places, n_b)
                size_a, size_b = sides.lengths[0][flat_a], sides.lengths[1][flat_b]
                links = overlaps(np.cumsum(size_a) - size_a, doc_a, np.cumsum(size_b) - size_b, doc_b)
                n_links, n_groups = (np.bincount(doc_a[x], minlength=len(a)) for x in (links.a, links.a_first))
                moves = [np.diff(x, prepend=-1).astype(bool) for x in (links.a, links.b)]
                names = group_text(sides.names, flat_a, flat_b, links, len(sides.a_bytes)) if len(flat_a) else np.zeros(0, object)
                token_at, link_at, digests, packed = 0, 0, [], [[], []]
                for n, m in zip((n_a + n_b).tolist(), n_links.tolist()):
                    digests.append(hashlib.sha256(b"".join(names[token_at : token_at + n].tolist())[:-1]).hexdigest() if n else "")
                    for k in (0, 1):
                        packed[k].append(np.packbits(moves[k][link_at : link_at + m]).tobytes())
                    token_at, link_at = token_at + n, link_at + m
                if len(links.a):
                    p, c = np.unique(flat_a[links.a].astype(np.int64) << 32 | flat_b[links.b], return_counts=True)
                    pairs.append(p), counts.append(c)
                    held += len(p)
                    if held > TASK_PAIRS:
                        p, c = united(pairs, counts)
                        pairs, counts, held = [p], [c], len(p) // 2
                ids = [[x.astype(f"<u{width}").tobytes() for x in of] for of in (a, b)]
                columns = [piece.column("doc_id"), *[pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, n_links)], pa.array(digests), pa.array(np.full(len(a), width, np.int32)), *[pa.array(x, pa.binary()) for x in (*ids, *packed)]]
                yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(a), pa.int64()), pa.nulls(len(a), pa.int64())], schema=whole)
        if pairs:
            p, c = united(pairs, counts)
            for lo in range(0, len(p), 100_000):
                mine = p[lo : lo + 100_000]
                yield pa.RecordBatch.from_arrays([*[pa.nulls(len(mine), f.type) for f in whole][:-2], pa.array(mine), pa.array(c[lo : lo + 100_000])], schema=whole)

    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    schema = ALIGNED + ", pair long, pair_n long"
    whole = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in schema.split(", "))])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(rows.mapInArrow(run, schema), "aligned", compression="zstd")


def documents(aligned: DataFrame) -> DataFrame:
    return aligned.where("groups_sha256 IS NOT NULL").drop("pair", "pair_n")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """How many links of the corpus hold each pair of ids linked: pair (A's id * 2^32 + B's), n."""
    return aligned.where("pair IS NOT NULL").groupBy("pair").agg(F.sum("pair_n").alias("n"))


class Path(NamedTuple):
    """Links of some documents: their ids, those of each link, where each document's begin, and the groups of links."""

    a: np.ndarray
    b: np.ndarray
    a_at: np.ndarray
    b_at: np.ndarray
    ends: np.ndarray


def paths(rows: pa.RecordBatch) -> Path:
    n = rows.column("n_links").to_numpy()
    moves = [[np.unpackbits(np.frombuffer(x.as_py(), np.uint8), count=m) for x, m in zip(rows.column(c), n.tolist())] for c in ("a_moves", "b_moves")]
    ids = [np.concatenate([np.frombuffer(x.as_py(), f"<u{w.as_py()}").astype(np.int64) for x, w in zip(rows.column(c), rows.column("width"))]) for c in ("a", "b")]
    a_at, b_at = (np.cumsum(np.concatenate(m), dtype=np.int64) - 1 for m in moves)
    return Path(*ids, a_at, b_at, np.cumsum(n))


def links(aligned: DataFrame) -> DataFrame:
    """One row per link of each document: doc_id, a_place, b_place (tokens counted from 0), a_id, b_id, group_no."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "a", 64, TEXT_BYTES):
                for doc, one in zip(rows.column("doc_id"), (rows.slice(i, 1) for i in range(rows.num_rows))):
                    p = paths(one)
                    group = np.cumsum((np.diff(p.a_at, prepend=-1) > 0) & (np.diff(p.b_at, prepend=-1) > 0)) - 1
                    for lo in range(0, len(p.a_at), 100_000):
                        x, y = p.a_at[lo : lo + 100_000], p.b_at[lo : lo + 100_000]
                        yield pa.RecordBatch.from_arrays([pa.array([doc.as_py()] * len(x), pa.int64()), *map(pa.array, (x, y, p.a[x], p.b[y], group[lo : lo + 100_000]))], ["doc_id", "a_place", "b_place", "a_id", "b_id", "group_no"])

    return documents(aligned).mapInArrow(run, "doc_id long, a_place long, b_place long, a_id long, b_id long, group_no long")


def score(aligned: DataFrame, most_sent: int = SENT_PAIRS) -> DataFrame:
    """documents(aligned) as doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: how many of a document's links
    have a count that no pair with the same id of B exceeds, and the sum of the counts of its links.

    The distinct pairs are counted: up to most_sent of them go to all tasks, and documents stay where they are. Beyond
    that, each document's distinct pairs are joined to the counts (looked_up, which leaves very frequent pairs in place), and the highest counts of B's
    ids, one row for each id of the vocabulary, are sent.
    """
    known = stored(pair_counts(aligned), "pairs")
    columns, rows = ["n_a", "n_b", "n_groups", "n_links"], documents(aligned)
    if known.limit(most_sent + 1).count() > most_sent:
        return scored_by_join(rows, known)
    table = known.toPandas().sort_values("pair")
    pair, n = table["pair"].to_numpy(np.int64), table["n"].to_numpy(np.int64)
    best = np.zeros(int((pair & 0xFFFFFFFF).max()) + 1 if len(pair) else 0, np.int64)
    np.maximum.at(best, pair & 0xFFFFFFFF, n)
    shared = aligned.sparkSession.sparkContext.broadcast((pair, n, best))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = shared.value
        for batch in batches:
            for some in slices(batch, "a", 1024, TEXT_BYTES):
                p = paths(some)
                b = p.b[p.b_at]
                count = n[np.searchsorted(pair, p.a[p.a_at] << 32 | b)]
                sums = [np.r_[0, np.cumsum(x, dtype=np.int64)][np.r_[0, p.ends]] for x in (count == best[b], count)]
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), *[some.column(c) for c in columns], *[pa.array(np.diff(s)) for s in sums], some.column("groups_sha256")], SCORED)

    return rows.mapInArrow(run, ", ".join(f"{c} {'string' if c == SCORED[-1] else 'long'}" for c in SCORED))


SCORED = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def scored_by_join(rows: DataFrame, known: DataFrame) -> DataFrame:
    """score() for any number of distinct pairs. A row is known by its place in the stored table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "a", 64, TEXT_BYTES):
                p = paths(some)
                doc = np.repeat(some.column("row").to_numpy(), np.diff(p.ends, prepend=0))
                found = pd.DataFrame({"row": doc, "pair": p.a[p.a_at] << 32 | p.b[p.b_at]}).value_counts().reset_index(name="times")
                yield pa.RecordBatch.from_arrays([pa.array(found[c].to_numpy()) for c in ("row", "pair", "times")], ["row", "pair", "times"])

    placed = rows.withColumn("row", F.monotonically_increasing_id())
    each = placed.mapInArrow(run, "row long, pair long, times long")
    total = known.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    b_id = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    best = known.groupBy(b_id.alias("b_id")).agg(F.max("n").alias("best"))
    judged = known.withColumn("b_id", b_id).join(F.broadcast(best), "b_id").select("pair", "n", F.col("n").alias("count"), (F.col("n") == F.col("best")).alias("is_best"))
    sums = looked_up(each, judged, ["pair"], total).groupBy("row").agg(F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    return placed.join(sums, "row", "left").fillna(0, ["n_best", "count_sum"]).select(*SCORED)
