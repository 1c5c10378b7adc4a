import random
import struct
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer
from pyspark.sql import functions as F

from stratalake.llm import packing as p, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_first_fit(sizes, capacity):
    bins, free = [], []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = next((b for b, f in enumerate(free) if f >= sizes[i]), len(bins))
        if at == len(bins):
            bins.append([]), free.append(capacity)
        bins[at].append(i)
        free[at] -= sizes[i]
    return bins


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 64, 65, 500])
def test_tournament_equals_a_scan(n):
    for seed in range(5):
        r = random.Random(seed)
        sizes = [r.choice([r.randrange(1, 101), 100, 50, 1]) for _ in range(n)]
        assert p.first_fit_decreasing(sizes, 100) == plain_first_fit(sizes, 100)


@pytest.mark.parametrize("fill", [True, False])
def test_pieces_tile_documents(fill):
    for seed in range(60):
        r = random.Random(seed)
        lengths = [r.choice([0, 1, r.randrange(1, 40), r.randrange(1, 400), 64, 128]) for _ in range(r.randrange(0, 40))]
        got = p.pack(lengths, 64, fill)
        taken = sorted((d, start, n) for s in got for d, start, n in s)
        at = [0] * len(lengths)
        for d, start, n in taken:
            assert n > 0 and start == at[d]
            at[d] += n
        assert at == lengths and all(sum(n for _, _, n in s) <= 64 for s in got)
        if fill:
            assert all(p.padded(sum(n for _, _, n in s), 64) == sum(n for _, _, n in s) for s in got)


def check(spark, docs, **options):
    library = Tokenizer.from_file(PATH)
    want = sorted((str(r.doc_id), library.encode(r.text or "", add_special_tokens=False).ids + [p.END]) for r in docs.select("doc_id", "text").collect())
    pieces = p.pack_documents(docs, PATH, with_ids=True, **options).collect()
    for r in pieces:
        assert r.length == len(r.ids) > 0 and r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(r.ids)}I", *r.ids))
    sequences = {}
    for r in pieces:
        sequences.setdefault(r.sequence_id, []).append(r)
    for of in sequences.values():
        at = 0
        for r in sorted(of, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= options.get("capacity", p.CAPACITY)
    by = {}
    for r in pieces:
        by.setdefault(str(r.doc_id), []).append(r)
    assert sum(r.length for r in pieces) == sum(len(w) for _, w in want) and sorted(by) == sorted({i for i, _ in want})
    for i, of in by.items():
        own = [w for j, w in want if j == i]
        if len(own) == 1:
            assert [x for r in sorted(of, key=lambda r: r.start) for x in r.ids] == own[0] and {r.doc_tokens for r in of} == {len(own[0])}
        else:
            assert sorted(x for r in of for x in r.ids) == sorted(x for w in own for x in w)
    return pieces


@pytest.mark.parametrize("options", [{}, {"group_rows": 2, "capacity": 64}, {"fill": False, "capacity": 128}, {"group_tokens": 100}])
def test_odd_rows(spark, odd, empty, options):
    check(spark, odd.withColumn("ids", F.lit("clash")).withColumn("sequence_id", F.lit(1)), **options)
    assert p.pack_documents(empty, PATH, **options).count() == 0


def test_query(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    got = queries.op12_sequence_packing(spark, data)
    library = Tokenizer.from_file(PATH)
    want = {r.doc_id: library.encode(r.text or "", add_special_tokens=False).ids + [p.END] for r in docs.collect()}
    rows = got.collect()
    for r in rows:
        ids = want[r.doc_id][r.start : r.start + r.length]
        assert r.doc_tokens == len(want[r.doc_id]) and r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
    assert sum(r.length for r in rows) == sum(map(len, want.values()))
    assert p.sequences(got).agg(F.sum("padding")).first()[0] == 0
    assert len({r.sequence_id for r in rows}) < sum(map(len, want.values())) / 2048 + 12


def test_equal_rows_spread_over_groups(spark):
    docs = spark.range(3000).select(F.lit(5).cast("long").alias("doc_id"), F.lit("the same words again").alias("text"))
    got = p.pack_documents(docs, PATH, group_rows=100)
    groups = got.groupBy(F.shiftright("sequence_id", 32).alias("g")).count().collect()
    assert len(groups) == 30 and max(r["count"] for r in groups) < 200 and got.agg(F.sum("length")).first()[0] == 3000 * 5
