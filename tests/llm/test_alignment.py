import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from stratalake.llm import alignment as al, queries

from .conftest import prose

A, B = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
TEXTS = [None, "", " ", "  two  spaces  ", "tab\tand\nlines\n\n\nend \n", "\r\n x \x0b\x0cy", "don't 'tis it's'll x'ta,", "0 00 a0b 1.5% $#@!", "<|endoftext|> x <s> </s> <unk> <0x41>", "É é Ü ß ñ", "W̊ é 𝒳 漢字 ﬁ K ſ", "a\x85b\xa0c d　e\x1cf", "▁under▁ ▁", "a​b ﻿c", "internationalization antidisestablishmentarianism", prose(1), prose(2, 4000), "x" * 3000, "\U0001f600\U0001f468‍\U0001f469 ok", "naïve café — “quoted” …"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=B)


def cuts(text, libraries):
    """Tokens (id, first byte, end) of both sides, or none."""
    a, b = libraries
    if not text:
        return [], []
    sides = al.sides_of(A, B)
    out = []
    for ids, of in ((a.encode(" " + text, add_special_tokens=False).ids, sides.a_bytes), (b.encode(text), sides.b_bytes)):
        if b"".join(of[i] for i in ids) != (" " + text).encode():
            return [], []
        at, found = 0, []
        for i in ids:
            found.append((i, at, at + len(of[i])))
            at += len(of[i])
        out.append(found)
    return out


def brute(rows, libraries):
    cut = [(doc, *cuts(t, libraries)) for doc, t in rows]
    linked = [[(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]] if len(a) < 5000 else fast(a, b) for _, a, b in cut]
    count = Counter(p for of in linked for p in of)
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = []
    for (doc, a, b), of in zip(cut, linked):
        ends = sorted({x[2] for x in a} & {y[2] for y in b})
        groups, lo = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(x[0]) for x in side if lo < x[2] <= end) for side in (a, b)) if len(a) < 5000 else "")
            lo = end
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a and len(a) < 5000 else "" if not a else None
        out.append((doc, len(a), len(b), len(ends), len(of), sum(count[p] == best[p[1]] for p in of), sum(count[p] for p in of), digest))
    return out


def fast(a, b):
    out, j = [], 0
    for i, lo, hi in a:
        while b[j][2] <= lo:
            j += 1
        k = j
        while k < len(b) and b[k][1] < hi:
            out.append((i, b[k][0]))
            k += 1
    return out


def check(got, want):
    key = lambda r: tuple(map(str, r))
    got = sorted((tuple(r) for r in got), key=key)
    want = sorted(want, key=key)
    assert [g[:-1] for g in got] == [w[:-1] for w in want]
    assert all(g[-1] == w[-1] for g, w in zip(got, want) if w[-1] is not None)


def test_encoding_equals_the_libraries(libraries):
    sides = al.Sides(A, B)
    latin = "".join(map(chr, range(1, 0x250)))
    for lo in range(0, 0x250, 7):
        t = " ".join(latin[i : i + 3] + latin[lo : lo + 9] for i in range(0, 0x250, 5))
        assert sides.encode_a(t) == libraries[0].encode(" " + t, add_special_tokens=False).ids
    for _ in range(1):
        a, b = sides.encode([t or "" for t in TEXTS])
        for t, x, y in zip(TEXTS, a, b):
            want = cuts(t, libraries)
            assert x.tolist() == [i for i, _, _ in want[0]] and y.tolist() == [i for i, _, _ in want[1]], t
            assert sides.encode_a(t or "x") == libraries[0].encode(" " + (t or "x"), add_special_tokens=False).ids, t
    assert sum(len(x) > 0 for x in a) > 12 and sides.plain is not None
    own = al.Sides(A, B)
    own.plain = None
    assert all(x.tolist() == y.tolist() for x, y in zip(own.encode([t or "" for t in TEXTS])[0], a))


@pytest.mark.parametrize("most", [al.SENT_PAIRS, 0])
def test_equals_brute_force(spark, libraries, monkeypatch, most):
    monkeypatch.setattr(al, "TEXT_BYTES", 200)
    monkeypatch.setattr(al, "TASK_PAIRS", 50)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "null id here"), (3, "again"), (3, "again")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, pair string, n_a int").repartition(3)
    check(al.score(al.align(docs, A, B), most).collect(), brute(rows, libraries))


def test_hot_pairs(spark, libraries, monkeypatch):
    import stratalake.llm.common as common

    monkeypatch.setattr(common, "HOT_ROWS", 20)
    rows = [(i, f"the same words {i % 7}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(al.score(al.align(docs, A, B), 0).collect(), brute(rows, libraries))


def test_links(spark, libraries):
    rows = [(1, "internationalization of tokens\nand lines"), (2, None), (3, prose(5, 30))]
    got = al.links(al.align(spark.createDataFrame(rows, "doc_id long, text string"), A, B)).collect()
    for doc, text in rows:
        a, b = cuts(text, libraries)
        want = sorted((i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x[1] < y[2] and y[1] < x[2])
        mine = sorted((r.a_place, r.b_place) for r in got if r.doc_id == doc)
        assert mine == want and all(a[r.a_place][0] == r.a_id and b[r.b_place][0] == r.b_id for r in got if r.doc_id == doc)
        assert len({r.group_no for r in got if r.doc_id == doc}) == len({x[2] for x in a} & {y[2] for y in b})


def test_empty_table(spark, empty):
    for most in (al.SENT_PAIRS, 0):
        assert al.score(al.align(empty, A, B), most).count() == 0
    blank = empty.sparkSession.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    for most in (al.SENT_PAIRS, -1):
        assert sorted(tuple(r)[:7] for r in al.score(al.align(blank, A, B), most).collect()) == [(1, 0, 0, 0, 0, 0, 0), (2, 0, 0, 0, 0, 0, 0)]


def test_query(spark, data, libraries):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    check(queries.op11_token_alignment(spark, data).collect(), brute(rows, libraries))
