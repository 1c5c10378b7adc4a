"""Quality scores: random-indexing word vectors pooled per document, then a two-layer network.

Random indexing: every word has a sparse random index vector, and its context vector is the sum of the index vectors of
the words around it, over the whole corpus. Words and their shapes (letters as a or A, digits as 0, runs as one, other
marks as they are) are hashed to BUCKETS rows, so the table of vectors has a fixed size whatever the corpus holds: tasks
sum it up, the sums are combined, and the finished table is sent to all tasks. A document is the mean and the spread of
its words' and shapes' vectors; the network's output is calibrated by a temperature fitted on rows kept back.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import fold, labelled_sample, streamed

#: Rows and length of the table of vectors, entries of an index vector other than 0, words to each side, words remembered.
BUCKETS, DIM, ENTRIES, REACH, MEMO = 1 << 13, 24, 4, 2, 400_000
#: Most labelled documents that the network is fitted on, hidden units, passes, step, L2 weight, decision.
SAMPLE, HIDDEN, EPOCHS, STEP, L2, GOOD = 8000, 32, 60, 0.01, 1e-3, 0.3


@lru_cache(maxsize=1)
def index_vectors() -> np.ndarray:
    rng, out = np.random.default_rng(11), np.zeros((BUCKETS, DIM), np.int8)
    for row in out:
        row[rng.choice(DIM, ENTRIES, replace=False)] = rng.choice([-1, 1], ENTRIES)
    return out


class Shapes(dict):
    """What stands for each character in a word's shape."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = found = ("A" if c.isupper() else "a") if c.isalpha() else "0" if c.isdigit() else c
        return found


class Words:
    """Numbers of words and of their shapes, remembered by each worker."""

    def __init__(self):
        self.memo: dict[str, int] = {}
        self.shapes, self.run = Shapes(), re.compile(r"(.)\1+", re.DOTALL)

    def number(self, word: str) -> int:
        shape = self.run.sub(r"\1", word.translate(self.shapes))
        return zlib.crc32(b"w" + word.encode("utf-8", "replace")) % BUCKETS << 16 | zlib.crc32(b"s" + shape.encode("utf-8", "replace")) % BUCKETS

    def numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of all words and of all shapes, one text after the other, and the number of words of each text."""
        memo, split = self.memo, [t.split() for t in texts]
        if len(memo) > MEMO:
            memo.clear()
        words = list(chain.from_iterable(split))
        found = list(map(memo.get, words))
        if None in found:
            for i, x in enumerate(found):
                if x is None:
                    w = words[i]
                    found[i] = memo[w] = memo.get(w) or self.number(w)
        both = np.array(found, np.int64)
        return both >> 16, both & 0xFFFF, np.array([len(s) for s in split], np.int64)


@lru_cache(maxsize=1)
def words_of_worker() -> Words:
    """The memo of this worker process, which later tasks find filled."""
    return Words()


def gathered(rows: np.ndarray, vectors: np.ndarray, into: np.ndarray) -> None:
    """Adds vectors[i] to into[rows[i]]."""
    if len(rows):
        order = np.argsort(rows.astype(np.int16), kind="stable")
        at = rows[order]
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        into[at[first]] += np.add.reduceat(vectors[order], first, axis=0, dtype=np.int32)


def context_table(docs: DataFrame) -> np.ndarray:
    """The context vectors of all words and shapes of docs (text): one row per bucket, of unit length or 0.

    Every whole text of every document is read. A task gives at most BUCKETS rows of whole numbers, so that the sums do
    not depend on the order in which they are taken.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, index, total, seen = words_of_worker(), index_vectors(), np.zeros((BUCKETS, DIM), np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            texts = [t or "" for t in batch.text]
            for lo in range(0, len(texts), 128):
                word, shape, n = words.numbers(texts[lo : lo + 128])
                doc, vec = np.repeat(np.arange(len(n)), n), index[word] + index[shape]
                around = np.zeros((len(word), DIM), np.int8)  # at most 2 * REACH * 2 in size
                for d in range(1, REACH + 1):
                    apart = np.flatnonzero(doc[d:] != doc[:-d])
                    before, after = vec[:-d].copy(), vec[d:].copy()
                    before[apart] = after[apart] = 0
                    around[d:] += before
                    around[:-d] += after
                for rows in (word, shape):
                    gathered(rows, around, total)
                    seen += np.bincount(rows, minlength=BUCKETS)
        at = np.flatnonzero(seen)
        yield pd.DataFrame({"b": at.astype(np.int32), "n": seen[at]} | {f"v{i}": total[at, i] for i in range(DIM)})

    columns = [f"v{i}" for i in range(DIM)]
    rows = docs.select("text").mapInPandas(run, "b int, n long, " + ", ".join(f"{c} long" for c in columns)).groupBy("b").agg(*[F.sum(c).alias(c) for c in ("n", *columns)]).toPandas().sort_values("b")
    table = np.zeros((BUCKETS, DIM), np.float32)
    if len(rows):
        sums, n = rows[columns].to_numpy(float), rows.n.to_numpy(float)
        mean = sums / n[:, None]
        centred = mean - np.average(mean, axis=0, weights=n)
        table[rows.b] = centred / np.maximum(np.linalg.norm(centred, axis=1, keepdims=True), 1e-9)
    return table


def pooled(texts: list[str], words: Words, table: np.ndarray) -> np.ndarray:
    """The features of documents: mean and spread of their words' and of their shapes' vectors; zeros without words."""
    word, shape, n = words.numbers(texts)
    out = np.zeros((len(texts), 4 * DIM), np.float32)
    full = np.flatnonzero(n)
    if len(full):
        first = (np.cumsum(n) - n)[full]
        size = n[full][:, None].astype(np.float32)
        parts = []
        for rows in (word, shape):
            v = table[rows]
            mean = np.add.reduceat(v, first, axis=0) / size
            parts += [mean, np.sqrt(np.maximum(np.add.reduceat(v * v, first, axis=0) / size - mean * mean, 0))]
        out[full] = np.concatenate(parts, axis=1)
    return out


class Network(NamedTuple):
    shift: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(((x - self.shift) / self.scale) @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -35, 35)))


def train(x: np.ndarray, y: np.ndarray, kept_back: np.ndarray) -> Network:
    """A hidden layer of rectifiers and a logistic output, by Adam; the temperature is fitted on the rows kept back."""
    fit = ~kept_back
    shift, scale = x[fit].mean(axis=0), x[fit].std(axis=0) + 1e-3
    z, t, rng = (x[fit] - shift) / scale, y[fit], np.random.default_rng(5)
    share = np.clip(t.mean(), 1e-3, 1 - 1e-3)
    p = [rng.normal(0, (2 / z.shape[1]) ** 0.5, (z.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.array(np.log(share / (1 - share)))]
    m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(z))
        for lo in range(0, len(z), 128):
            at = order[lo : lo + 128]
            h = np.maximum(z[at] @ p[0] + p[1], 0)
            d = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -35, 35))) - t[at]) / len(at)
            back = d[:, None] * p[2] * (h > 0)
            grads = [z[at].T @ back + L2 * p[0], back.sum(axis=0), h.T @ d + L2 * p[2], d.sum()]
            step += 1
            for i, g in enumerate(grads):
                m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.999 * v[i] + 0.001 * g * g
                p[i] = p[i] - STEP * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    net = Network(shift.astype(np.float32), scale.astype(np.float32), p[0].astype(np.float32), p[1].astype(np.float32), p[2].astype(np.float32), float(p[3]), 1.0)
    check = kept_back if kept_back.any() and 0 < y[kept_back].mean() < 1 else fit
    logits = net.logits(x[check]).astype(float)
    loss = lambda c: np.logaddexp(0, -logits / c * (2 * y[check] - 1)).mean()
    return net._replace(temperature=float(min(np.geomspace(0.25, 8, 61), key=loss)))


def score_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, out: str = "quality_score") -> DataFrame:
    """docs with a score from 0 to 1 in column `out` (replacing one of that name): how likely the label 1 is.

    The word vectors come from all texts; the network is fitted on at most `sample` rows of `labels` (doc_id, quality), with
    at most SAMPLE_BYTES of text (common.labelled_sample), whose crc32(doc_id as text) mod 5 is not 0, a fifth of them kept back for the temperature. Documents with a null id
    are scored, never learned from; doc_id, lang and source are no inputs. Null, empty and blank texts share one
    score, that of no words. Labels of one kind only give all documents that kind's smoothed share. Rows and other
    columns stay.
    """
    spark = docs.sparkSession
    table = context_table(docs.select("text"))
    words, x, y, ids, some = Words(), [np.zeros((0, 4 * DIM), np.float32)], [], [], []
    for r in streamed(labelled_sample(docs, labels.where(fold(F.col("doc_id"), 5).isin(1, 2, 3, 4)), "quality", sample)):
        some.append(r.text or "")
        y.append(float(r.label > 0))
        ids.append(r.doc_id)
        if len(some) == 64:
            x.append(pooled(some, words, table))
            some = []
    if some:
        x.append(pooled(some, words, table))
    y, net = np.array(y, float), None
    if len(y) and 0 < y.mean() < 1:
        net = train(np.concatenate(x).astype(float), y, np.array([zlib.crc32(b"back" + str(i).encode()) % 5 == 0 for i in ids]))
    model = spark.sparkContext.broadcast((table, net, float((y.sum() + 0.5) / (len(y) + 1))))

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table, net, share = model.value
        words = words_of_worker()
        for batch in batches:
            texts = [t or "" for t in batch.tolist()]
            found = [np.full(len(texts[lo : lo + 256]), share) if net is None else net.probability(pooled(texts[lo : lo + 256], words, table)) for lo in range(0, len(texts), 256)]
            yield pd.Series(np.concatenate(found or [np.zeros(0)]).astype(float))

    return docs.withColumn(out, run(F.col("text")))
