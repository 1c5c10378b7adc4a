"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of one to LONGEST characters, in lower case, are hashed to BUCKETS features. Document frequencies are counted
over all documents that may be learned from; the regression is trained with follow-the-regularised-leader and elastic-net
penalties on a bounded sample of them and calibrated by a temperature fitted on a part of the sample kept back.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import SAMPLE_BYTES, fold, within_bytes

#: Hashed features, characters of the longest n-gram, characters handled at a time.
BUCKETS, LONGEST, PIECE = 1 << 15, 3, 400_000
#: Most documents that the regression is trained on, passes and steps at least, and the rates and penalties of the leader.
SAMPLE, PASSES, UPDATES, ALPHA, BETA, L1, L2 = 4000, 3, 8000, 1.0, 1.0, 1e-4, 1e-4
UNKNOWN = "und"


def hashed(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For pieces of the texts, whole texts each: features of all n-grams, and where each text's begin, with the end.

    N-grams lie within a text. A text with a space before and after it has n-grams that mark where words begin and end.
    """
    part: list[np.ndarray] = []
    size = 0
    for i, t in enumerate(texts):
        code = np.frombuffer((" " + " ".join(t.lower().split()) + " ").encode("utf-32-le", "replace"), "<u4")
        part.append(code)
        size += len(code)
        if size >= PIECE or i == len(texts) - 1:
            data = np.concatenate(part).astype(np.uint64)
            n = np.array([len(p) for p in part])
            mixed, found = np.zeros(len(data), np.uint64), []
            for k in range(LONGEST):
                mixed = (mixed[: len(data) - k] if k else mixed) * np.uint64(0x9E3779B97F4A7C15) + data[k:] + np.uint64(k + 1)
                found.append(((mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)).astype(np.int64) % BUCKETS)
            ends, gathered, counts = np.cumsum(n), [], []
            starts = ends - n
            for a, b in zip(starts, ends):
                mine = [f[a : b - k] for k, f in enumerate(found)]
                gathered += mine
                counts.append(sum(map(len, mine)))
            yield np.concatenate(gathered), np.r_[0, np.cumsum(counts)]
            part, size = [], 0


def frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of docs (text) each feature occurs, and how many docs there are. A task gives one row per feature."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for features, cut in hashed([t or "" for t in batch.text]):
                for a, b in zip(cut[:-1], cut[1:]):
                    here = np.zeros(BUCKETS, bool)
                    here[features[a:b]] = True
                    total += here
                    n += 1
        at = np.flatnonzero(total)
        yield pd.DataFrame({"f": np.r_[at, -1], "n": np.r_[total[at], n]})

    rows = docs.select("text").mapInPandas(run, "f long, n long").groupBy("f").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(BUCKETS)
    known = rows[rows.f >= 0]
    out[known.f] = known.n
    return out, int(rows.n[rows.f < 0].sum())


class Model(NamedTuple):
    names: list[str]
    weights: np.ndarray  # features x languages, with the inverse document frequency in them
    bias: np.ndarray
    temperature: float

    def probabilities(self, texts: list[str]) -> np.ndarray:
        out = []
        for features, cut in hashed(texts):
            sums = np.add.reduceat(self.weights[features], cut[:-1], axis=0)
            out.append(sums / np.diff(cut)[:, None] + self.bias)
        z = np.concatenate(out or [np.zeros((0, len(self.names)))]).astype(float) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def leader(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights (features x classes) and bias by follow-the-regularised-leader, one document after the other."""
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))
    weigh = lambda z, n: np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    rng = np.random.default_rng(3)
    for _ in range(max(PASSES, UPDATES // len(rows))):
        for i in rng.permutation(len(rows)):
            f, x, y = rows[i]
            w = weigh(z[f], n[f])
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y] -= 1
            g = x[:, None] * p
            z[f] += g - (np.sqrt(n[f] + g * g) - np.sqrt(n[f])) / ALPHA * w
            n[f] += g * g
    w = weigh(z, n)
    return w[:BUCKETS], w[BUCKETS]


def train(texts: list[str], langs: list[str], kept_back: np.ndarray, inverse: np.ndarray) -> Model:
    names = sorted(set(langs))
    number = {name: i for i, name in enumerate(names)}
    rows = []
    at = iter(langs)
    for features, cut in hashed(texts):
        for a, b in zip(cut[:-1], cut[1:]):
            f, count = np.unique(features[a:b], return_counts=True)
            rows.append((np.r_[f, BUCKETS], np.r_[count / (b - a) * inverse[f], 1.0], number[next(at)]))
    fit = [r for r, back in zip(rows, kept_back) if not back] or rows
    weights, bias = leader(fit, len(names))
    check = [r for r, back in zip(rows, kept_back) if back] or rows
    z = np.array([x[:-1] @ weights[f[:-1]] + bias for f, x, _ in check])
    y = np.array([r[2] for r in check])

    def loss(c: float) -> float:
        s = z / c - (z / c).max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]).mean())

    return Model(names, (weights * inverse[:, None]).astype(np.float32), bias.astype(np.float32), float(min(np.geomspace(0.02, 8, 81), key=loss)))


def fit(docs: DataFrame, sample: int = SAMPLE, most_bytes: int = SAMPLE_BYTES) -> Model | None:
    """A model from docs (doc_id, text, lang), null languages left out; None without any, or if no text is within most_bytes. Document frequencies cover all
    of docs, the regression at most `sample` of them with `most_bytes` of text, chosen by a hash of the id, one row per id:
    that whose text has the least hash."""
    docs = docs.where(F.col("lang").isNotNull())
    found, n = frequencies(docs)
    if not n:
        return None
    inverse = np.log((1 + n) / (1 + found)) + 1
    chosen = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("doc_id").alias("_h")).distinct().orderBy("_h", "_id").limit(sample).select("_id")
    row = F.min_by(F.struct("text", "lang"), F.struct(F.xxhash64("text"), "lang")).alias("row")
    found = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).groupBy("doc_id").agg(row).select("doc_id", "row.text", "row.lang")
    rows = sorted(within_bytes(found, most_bytes).collect(), key=lambda r: r.doc_id)
    if not rows:
        return None
    back = np.array([zlib.crc32(b"back" + str(r.doc_id).encode()) % 5 == 0 for r in rows])
    return train([r.text or "" for r in rows], [str(r.lang) for r in rows], back, inverse)


def identify(docs: DataFrame, sample: int = SAMPLE, out: str = "language") -> DataFrame:
    """docs with a struct (lang_pred, score) in column `out`, which replaces one of that name.

    Learned from are documents whose crc32(doc_id as text) mod 4 is not 2, with a language and an id. Texts that are null or
    have no letter are `und` with score 0; so is every text if there was nothing to learn from. lang, source and doc_id
    are no inputs of a prediction. Rows and other columns stay.
    """
    model = fit(docs.where(fold(F.col("doc_id"), 4).isin(0, 1, 3)).select("doc_id", "text", "lang"), sample)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.tolist()]
            if model is None:
                yield pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": [0.0] * len(texts)})
                continue
            p = model.probabilities(texts)
            yield pd.DataFrame({"lang_pred": np.array(model.names, object)[p.argmax(axis=1)] if len(p) else [], "score": p.max(axis=1) if len(p) else []})

    text = F.col("text")
    known = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    predicted = run(text)
    return docs.withColumn(out, F.struct(F.when(known, predicted["lang_pred"]).otherwise(UNKNOWN).alias("lang_pred"), F.when(known, predicted["score"]).otherwise(0.0).alias("score")))
