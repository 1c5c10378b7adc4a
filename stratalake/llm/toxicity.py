"""Toxicity by a linear-chain conditional random field over words.

Training documents carry a label each. Words are labelled from these: those that, as a whole or by their beginning, stand
in far more toxic documents than chance has it, near copies counted once, are tagged toxic there; all words of clean
documents are tagged clean; the other words of toxic documents have no label. On these tokens a two-tag chain is trained:
emissions are weights of hashed features of the word, transitions link neighbours, and the tags of unlabelled words are summed out by
the same forward-backward that gives the marginals. Marginals then give each word's probability, from which come
offsets and, by a logistic fit on the documents' own labels, a document's score.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import fold, labelled_sample, streamed

#: Most labelled documents that the model is fitted on, hashed features, words of a training sequence, words remembered and hashed at a time.
SAMPLE, FEATURES, SEQUENCE, MEMO, HASHED = 6000, 1 << 16, 64, 120_000, 16_384
#: Lengths of the beginnings of a word; documents, their share, odds and standard deviations that a unit of the lexicon needs.
PREFIXES, LEAST_DOCS, LEAST_SHARE, ODDS, SIGMAS = (4, 5, 6, 7, 8), 4, 0.02, 4.0, 5.0
FEATURES_EACH, MARKS = 1 + len(PREFIXES), 1 << 22
#: Steps of training on 512 sequences each, step size, L2 weight.
UPDATES, STEP, L2 = 600, 0.5, 1e-5
#: Marginal from which a word is reported, score from which a document counts as toxic, least marginal that a score looks at.
TAGGED, REJECT, LEAST_MARGINAL = 0.5, 0.7, 0.05
#: Log-odds that hold a labelled word to its tag in training.
HELD = 40.0
#: Hash of what stands before a word's beginning.
PREFIX_START = zlib.crc32(b"p")
TRIM = b".,;:!?\"'()[]{}*#%&$|<>-_"


class Model(NamedTuple):
    weights: np.ndarray  # of features, for tag toxic against clean
    transitions: np.ndarray  # [from, to]
    document: np.ndarray  # bias and weights of the document's features


def units(word: bytes) -> list[int]:
    """Hashes of what stands for a word: itself in lower case without marks around it, and its beginnings (of bytes)."""
    w = word.lower().strip(TRIM)
    return [zlib.crc32(b"w" + w)] + [zlib.crc32(b"p" + w[:k]) for k in PREFIXES if k < len(w)]


def features(word: bytes) -> list[int]:
    """Features of a word, always FEATURES_EACH of them: those of its units, then of none."""
    found = [1 + u % (FEATURES - 1) for u in units(word)]
    return found + [0] * (FEATURES_EACH - len(found))


def features_of(words: Iterable[bytes]) -> np.ndarray:
    """The features() of each word, a row each. Hashes of longer beginnings go on from those of shorter ones."""
    crc, of, flat, least, most = zlib.crc32, FEATURES - 1, [], PREFIXES[0], PREFIXES[-1]
    none, start = [[0] * (FEATURES_EACH - k) for k in range(FEATURES_EACH + 1)], crc(b"w")
    for word in words:
        w = word.lower().strip(TRIM)
        row, n = [1 + crc(w, start) % of], len(w)
        if n > least:
            h, done = PREFIX_START, 0
            for k in PREFIXES if n > most else [k for k in PREFIXES if k < n]:
                h, done = crc(w[done:k], h), k
                row.append(1 + h % of)
        flat += row
        flat += none[len(row)]
    return np.array(flat, np.int64).reshape(-1, FEATURES_EACH)


class Vocabulary:
    """The words of the sample by number, with the features of each, a hash of its form in lower case without marks around it
    and, for the lexicon, its units' hashes."""

    def __init__(self):
        self.number: dict[bytes, int] = {}
        self.features, self.marks, self.forms = array("i"), array("i"), array("q")

    def read(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "replace").split()
        for w in words:
            if w not in self.number:
                self.number[w] = len(self.number)
                self.features.extend(features(w))
                self.forms.append(form(w))
                marks = [u % MARKS for u in units(w)] if w.strip(TRIM) else []
                self.marks.extend(marks + [-1] * (FEATURES_EACH - len(marks)))
        return np.array([self.number[w] for w in words], np.int32)


def form(word: bytes) -> int:
    """A hash of a word in lower case without marks around it."""
    w = word.lower().strip(TRIM)
    return zlib.crc32(b"f" + w) << 20 ^ zlib.crc32(b"g" + w)


def apart(documents: list[np.ndarray], overlap: float = 0.6) -> list[np.ndarray]:
    """Those of the documents that don't share most of their units with one kept before: copies count once."""
    kept: list[set[int]] = []
    out = []
    for d in documents:
        mine = set(d.tolist())
        if mine and all(len(mine & k) < overlap * min(len(mine), len(k)) for k in kept):
            kept.append(mine)
            out.append(d)
    return out


def lexicon(documents: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """A mask over units of those that mark toxic documents: they stand in LEAST_DOCS and LEAST_SHARE of these at least,
    near copies counted once, ODDS times as often as in clean ones, and SIGMAS standard deviations more often.

    A document is the array of its different units."""
    found, clean = np.zeros(MARKS, np.int32), np.zeros(MARKS, np.int32)
    toxic = apart([d for d, y in zip(documents, labels) if y])
    for d in toxic:
        found[d] += 1
    for d, y in zip(documents, labels):
        if not y:
            clean[d] += 1
    chance = (clean + np.float32(0.5)) / max(1, int((labels == 0).sum())) * len(toxic)
    return (found >= max(LEAST_DOCS, LEAST_SHARE * len(toxic))) & (found >= ODDS * chance) & (found - chance >= SIGMAS * np.sqrt(np.maximum(chance, 0.5)))


def forward_backward(emit: np.ndarray, length: np.ndarray, trans: np.ndarray, pairs: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of the toxic tag (rows x steps) and, if asked for, expected transitions, of padded sequences in descending length.

    The messages are kept as log-odds of the two tags, so nothing under- or overflows.
    """
    rows, steps = emit.shape
    a, b = np.zeros((steps, rows)), np.zeros((steps, rows))
    active = np.searchsorted(-length, -np.arange(steps), "left")  # rows longer than the step
    t00, t01, t10, t11 = trans[0, 0], trans[0, 1], trans[1, 0], trans[1, 1]
    e = np.ascontiguousarray(emit.T)
    a[0] = e[0]
    for t in range(1, steps):
        n = active[t]
        x = a[t - 1, :n]
        a[t, :n] = np.logaddexp(t01, t11 + x) - np.logaddexp(t00, t10 + x) + e[t, :n]
    for t in range(steps - 2, -1, -1):
        n = active[t + 1]
        x = b[t + 1, :n] + e[t + 1, :n]
        b[t, :n] = np.logaddexp(t10, t11 + x) - np.logaddexp(t00, t01 + x)
    marginal = 1 / (1 + np.exp(-np.clip(a + b, -60, 60)))
    pair = np.zeros((2, 2))
    if pairs and steps > 1:
        left, right = a[:-1], b[1:] + e[1:]
        inside = np.arange(1, steps)[:, None] < length[None, :]
        parts = np.stack([np.full_like(left, t00), t01 + right, t10 + left, t11 + left + right])
        parts = np.exp(parts - parts.max(axis=0))
        pair = ((parts / parts.sum(axis=0)) * inside).sum(axis=(1, 2)).reshape(2, 2)
    return marginal.T, pair


def train_chain(ids: np.ndarray, known: np.ndarray, tags: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions by AdaGrad on the conditional likelihood; ids are word numbers, known[i] word i's features. A tag is
    1, 0, or -1 where there is no label: the likelihood sums over the tags that agree with the labels, so its gradient is
    what the chain expects where it is held to them, less what it expects where it is free."""
    w, trans = np.zeros(FEATURES), np.zeros((2, 2))
    gw, gt = np.full(FEATURES, 1e-2), np.full((2, 2), 1.0)
    rng = np.random.default_rng(7)
    w_bias = -3.0
    for _ in range(UPDATES):
        at = rng.choice(len(ids), min(512, len(ids)), replace=False)
        at = at[np.argsort(-length[at], kind="stable")]
        grad, d = gradient(ids[at], known, tags[at], length[at], w, trans, w_bias)
        grad, d = grad - L2 * w, d / len(at) - 1e-3 * trans
        gw += grad * grad
        w += STEP * grad / np.sqrt(gw)
        gt += d * d
        trans += STEP * d / np.sqrt(gt)
    # every word has as many features: the bias goes into them evenly
    return w + w_bias / known.shape[1], trans


def gradient(ids: np.ndarray, known: np.ndarray, tags: np.ndarray, n: np.ndarray, w: np.ndarray, trans: np.ndarray, w_bias: float) -> tuple[np.ndarray, np.ndarray]:
    """Of the log-likelihood of sequences in descending length n, by weights and by transitions."""
    x = known[ids]
    inside = np.arange(x.shape[1])[None, :] < n[:, None]
    emit = w[x].sum(axis=2) + w_bias
    marginal, pair = forward_backward(emit, n, trans, True)
    partly = (tags < 0).any(axis=1)  # with words that have no label
    seen, y = pairs_of(tags[~partly], inside[~partly]), np.maximum(tags, 0).astype(float)
    if partly.any():
        held = np.where(tags[partly] < 0, emit[partly], np.where(tags[partly] > 0, HELD, -HELD))
        y[partly], more = forward_backward(held, n[partly], trans, True)
        seen = seen + more
    error = (y - marginal) * inside
    return np.bincount(x[inside].ravel(), np.repeat(error[inside], x.shape[2]), FEATURES), seen - pair


def pairs_of(tags: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """How often each tag follows each."""
    first, second = tags[:, :-1][inside[:, 1:]].astype(int), tags[:, 1:][inside[:, 1:]].astype(int)
    return np.bincount(2 * first + second, minlength=4)[:4].reshape(2, 2).astype(float)


class Tagger:
    """Marginals of whole texts under a chain; each worker remembers the emissions of the words it met."""

    def __init__(self, weights: np.ndarray, transitions: np.ndarray):
        self.weights, self.transitions, self.memo = weights, transitions, {}

    def emissions(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        """The emissions of the words of each text. All words of the texts are looked up once, and those not met before are hashed
        together."""
        memo = self.memo
        if len(memo) >= MEMO:
            memo.clear()
        here = set(chain.from_iterable(texts))
        known = dict(zip(here, map(memo.get, here)))
        new = [w for w, x in known.items() if x is None]
        for lo in range(0, len(new), HASHED):
            some = new[lo : lo + HASHED]
            known.update(zip(some, self.weights[features_of(some)].sum(axis=1).tolist()))
        memo.update((w, known[w]) for w in new[: MEMO - len(memo)])
        get = known.__getitem__
        return [np.fromiter(map(get, words), np.float64, len(words)) for words in texts]

    def marginals(self, texts: list[str]) -> tuple[list[np.ndarray], list[list[bytes]]]:
        """For each text, the toxic marginals of its words, and the words."""
        split = [t.encode("utf-8", "replace").split() for t in texts]
        return self.of_emissions(self.emissions(split)), split

    def of_emissions(self, emit: list[np.ndarray]) -> list[np.ndarray]:
        """The marginals of sequences. Those of like length run side by side."""
        out: list[np.ndarray] = [np.zeros(0)] * len(emit)
        order = sorted((i for i in range(len(emit)) if len(emit[i])), key=lambda i: -len(emit[i]))
        lo = 0
        while lo < len(order):
            longest, hi = len(emit[order[lo]]), lo + 1
            while hi < len(order) and (hi - lo + 1) * longest <= 400_000 and 2 * len(emit[order[hi]]) >= longest:
                hi += 1
            rows = order[lo:hi]
            length = np.array([len(emit[i]) for i in rows])
            padded = np.zeros((len(rows), longest))
            for k, i in enumerate(rows):
                padded[k, : length[k]] = emit[i]
            found, _ = forward_backward(padded, length, self.transitions)
            for k, i in enumerate(rows):
                out[i] = found[k, : length[k]]
            lo = hi
        return out


def summary(marginal: np.ndarray, forms: Callable[[int], int]) -> list[float]:
    """A document's features: bias, log-odds that some word is toxic (a noisy or over its different words), once with
    a cap, and length. forms(i) is the form of word i."""
    best: dict[int, float] = {}
    for i in np.flatnonzero(marginal >= LEAST_MARGINAL):
        w, p = forms(i), float(marginal[i])
        best[w] = max(p, best.get(w, 0.0))
    some = 1e-3 - float(np.log1p(-np.minimum(np.array(list(best.values())), 1 - 1e-6)).sum())
    odds = some + float(np.log(-np.expm1(-some)))
    return [1.0, min(odds, 6.0), min(odds, 60.0), float(np.log1p(len(marginal)))]


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 0.1) -> np.ndarray:
    """Newton's method; weights other than the bias are drawn to 0."""
    w, pull = np.zeros(x.shape[1]), np.full(x.shape[1], l2)
    pull[0] = 1e-3
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pull), x.T @ (p - y) + pull * w)
    return w


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from at most `sample` rows of `labels` (doc_id, toxic) whose documents are in docs, chosen by a hash, with at most
    SAMPLE_BYTES of text (common.labelled_sample), and from all their sequences of words.

    These are the bounds of what the driver holds, as numbers of words; texts pass through it a partition at a time. With no
    labelled document, or labels of one kind only, every score is that kind's smoothed share.
    """
    vocabulary, numbers, y = Vocabulary(), [], []
    for r in streamed(labelled_sample(docs, labels, "toxic", sample)):
        numbers.append(vocabulary.read(r.text or ""))
        y.append(float(r.label > 0))
    y = np.array(y, float)
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        return Model(np.zeros(FEATURES), np.zeros((2, 2)), np.array([np.log(share / (1 - share)), 0, 0, 0]))
    known, marks = (np.array(x, np.int32).reshape(-1, FEATURES_EACH) for x in (vocabulary.features, vocabulary.marks))
    forms = np.array(vocabulary.forms, np.int64)
    del vocabulary
    distinct = []
    for n in numbers:
        own = np.unique(marks[np.unique(n)])
        distinct.append(own[own >= 0])
    toxic_units = lexicon(distinct, y)
    toxic_word = (toxic_units[marks] & (marks >= 0)).any(axis=1)
    del distinct, marks
    weights, transitions = train_chain(*sequences(numbers, y, toxic_word, known))
    tagger, rows, emission = Tagger(weights, transitions), [], weights[known].sum(axis=1)
    for lo in range(0, len(numbers), 256):
        some = numbers[lo : lo + 256]
        rows += [summary(m, forms[n].__getitem__) for m, n in zip(tagger.of_emissions([emission[n] for n in some]), some)]
    return Model(weights.astype(np.float32), transitions, logistic(np.array(rows), y))


def sequences(numbers: list[np.ndarray], y: np.ndarray, toxic_word: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """train_chain()'s arguments: documents as sequences of SEQUENCE words, with tags by the lexicon. A toxic document
    without any word of the lexicon says nothing about its words, and is left out if others are there."""
    parts = []
    for n, label in zip(numbers, y):
        if label and not toxic_word[n].any() and toxic_word.any():
            continue
        parts += [(n[lo : lo + SEQUENCE], label) for lo in range(0, len(n), SEQUENCE)]
    ids, tags, length = np.zeros((len(parts), SEQUENCE), np.int32), np.zeros((len(parts), SEQUENCE), np.int8), np.zeros(len(parts), np.int64)
    for k, (n, label) in enumerate(parts):
        ids[k, : len(n)], length[k] = n, len(n)
        if label:
            tags[k, : len(n)] = np.where(toxic_word[n], 1, -1)
    return ids, known, tags, length


def tag(text: Column, model: Model, spark) -> Column:
    """A struct (score, spans) of each whole text: spans are the runs of words with a marginal of TAGGED or more, as
    (start, end, probability) in code points. Null, empty and blank texts have no spans and a score all the same."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("score double, spans array<struct<start:int,end:int,probability:double>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        tagger, word = Tagger(model.weights.astype(float), model.transitions), re.compile(r"[^\x20\x09-\x0D]+")
        for batch in batches:
            texts = [t or "" for t in batch.tolist()]
            scores, spans = [], []
            for lo in range(0, len(texts), 1024):
                for text, marginal, words in zip(texts[lo : lo + 1024], *tagger.marginals(texts[lo : lo + 1024])):
                    scores.append(1 / (1 + np.exp(-float(np.dot(summary(marginal, lambda i: form(words[i])), model.document)))))
                    found: list[dict] = []
                    if len(marginal) and marginal.max() >= TAGGED:
                        last = -2
                        for k, m in enumerate(word.finditer(text)):
                            if marginal[k] >= TAGGED:
                                if last == k - 1:
                                    found[-1] |= {"end": m.end(), "probability": max(found[-1]["probability"], float(marginal[k]))}
                                else:
                                    found.append({"start": m.start(), "end": m.end(), "probability": float(marginal[k])})
                                last = k
                    spans.append(found)
            yield pd.DataFrame({"score": scores, "spans": spans})

    return run(text)


def score_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, out: str = "toxicity") -> DataFrame:
    """docs with the struct of tag() in column `out`, which replaces one of that name; rows and other columns stay.

    A score looks at the words whose marginal is LEAST_MARGINAL or more: for each different one the largest marginal, all
    of them by a noisy or; words below that add nothing.

    The model is fitted on documents whose crc32(doc_id as text) mod 3 is not 1; documents with a null id are never
    learned from. doc_id, lang and source are no inputs of a score.
    """
    learn = labels.where(fold(F.col("doc_id"), 3).isin(0, 2))
    model = fit(docs.select("doc_id", "text"), learn, sample)
    return docs.withColumn(out, tag(F.col("text"), model, docs.sparkSession))
