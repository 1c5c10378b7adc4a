import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stratalake.llm import common as s_common, queries, simhash as s
from stratalake.llm.components import components

from .conftest import prose


def plain_fingerprint(text, k=4):
    w = [x for x in re.split("[\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if x]
    shingles = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(nodes, near):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    nodes = list(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if near(a, b):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {n: root(n) for n in nodes}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("block,groups", [(2048, 6), (2048, 7), (8, 5), (8, 6)])
def test_links_give_the_classes_of_all_pairs(spark, monkeypatch, block, groups):
    monkeypatch.setattr(s, "BLOCK", block)
    r = random.Random(block + groups)
    prints = {r.getrandbits(64) for _ in range(150)} | {0, 1, 3, (1 << 64) - 1}
    for _ in range(4):
        x = r.getrandbits(64)
        for _ in range(60):
            prints.add(x)
            for b in r.sample(range(64), r.choice([1, 2, 3, 4, 5])):
                x ^= 1 << b
    df = spark.createDataFrame([(signed(x),) for x in prints], "fp long").repartition(3)
    got = {r.node % (1 << 64): r.root % (1 << 64) for r in components(s.links(df, groups=groups)).collect()}
    want = plain_classes(sorted(prints), lambda a, b: (a ^ b).bit_count() <= 4)
    classes = lambda m: {frozenset(x for x in prints if m.get(x, x) == v) for v in {m.get(x, x) for x in prints}}
    assert classes(got) == classes(want)


def test_bound_never_exceeds_the_distance(spark):
    r = np.random.default_rng(1)
    rows = [(int(a), int(a) ^ (1 << int(b)) ^ (1 << int(c)) if int(b) < 63 and int(c) < 63 else int(a)) for a, b, c in zip(r.integers(0, 1 << 62, 200), r.integers(0, 64, 200), r.integers(0, 64, 200))]
    df = spark.createDataFrame(rows, "a long, b long")
    over = df.where(F.bit_count(s.embedding(F.col("a")).bitwiseXOR(s.embedding(F.col("b")))) > F.bit_count(F.col("a").bitwiseXOR(F.col("b"))))
    assert over.count() == 0


def test_forest_is_sparse():
    members = np.arange(16, dtype=np.uint64)  # all within four bits
    a, b = s.forest(members, 4)
    assert len(a) == 15


@pytest.mark.parametrize("edges,want", [([], {}), ([(1, 1)], {}), ([(5, 3), (3, 9), (None, 2)], {3: 3, 5: 3, 9: 3}), ([(i, i + 1) for i in range(60)], {i: 0 for i in range(61)}), ([(0, i) for i in range(1, 40)] + [(100, 101)] * 2, {i: 0 for i in range(40)} | {100: 100, 101: 100})])
def test_components(spark, edges, want):
    got = components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.root for r in got.collect()} == want


def test_fingerprints(spark):
    texts = [None, "", " \n", "one", "One TWO three", "a b c d", "a b c d e A b", "É 𝒳 ß w x y", prose(1, 3000), "same " * 700]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r.f % (1 << 64) for r in df.select("text", s.fingerprint(F.col("text")).alias("f")).collect()] == [plain_fingerprint(t) for t in texts]


def test_odd_rows(spark, odd, empty):
    got = s.classes(odd.select("doc_id", "text")).collect()
    assert len(got) == odd.count()
    by = {}
    for r in got:
        by.setdefault(r.fp, set()).add(r.component_id)
    assert all(len(v) == 1 for v in by.values()) and by[0] == {3}  # null and blank texts
    kept = s.deduplicate(odd)
    assert kept.columns == odd.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert ids == ["1", "2", "2", "3", "6", "9", "None"]
    assert s.classes(empty.select("doc_id", "text")).count() == 0 and s.deduplicate(empty).count() == 0


def test_query(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").collect()
    prints = {r.doc_id: plain_fingerprint(r.text) for r in docs}
    roots = plain_classes(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    got = queries.op7_simhash_near_dedup(spark, data).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.fingerprint, r.component_id) == ("%016x" % prints[r.doc_id], roots[r.doc_id])




def test_hot_fingerprint_and_class_are_not_gathered(spark, monkeypatch):
    """One text for most rows and one class of many fingerprints: their rows stay in the tasks that hold them."""
    monkeypatch.setattr(s_common, "HOT_ROWS", 20)
    rows = spark.range(4000).select(F.col("id").alias("fp"), F.lit(7).alias("v")).withColumn("fp", F.when(F.col("fp") % 4 > 0, F.lit(0).cast("long")).otherwise(F.col("fp"))).repartition(8)
    found = rows.groupBy("fp").agg(F.count("*").alias("n")).withColumn("component_id", F.col("fp"))
    got = s_common.looked_up(rows, found, ["fp"], 4000)
    assert got.columns == ["fp", "v", "component_id"] and got.count() == 4000 and got.where("fp <> component_id").count() == 0
    hot = got.where("fp = 0").groupBy(F.spark_partition_id()).count().collect()
    assert len(hot) >= 8 and max(r["count"] for r in hot) < 600
    edges = spark.createDataFrame([(0, i) for i in range(1, 300)] + [(i, i + 1000) for i in range(1, 300)], "a long, b long")
    assert {r.root for r in components(edges).collect()} == {0}


def test_bound_is_tested_in_large_cells():
    r = np.random.default_rng(5)
    members = np.unique(np.r_[r.integers(0, 1 << 63, 100, dtype=np.uint64), np.uint64(1) << np.arange(60, dtype=np.uint64)])
    a, b = s.linked(members, np.array([0, len(members)]), 4)
    assert (np.bitwise_count(a ^ b) <= 4).all()
    want = plain_classes(members.tolist(), lambda x, y: (x ^ y).bit_count() <= 4)
    assert len(a) == len(members) - len(set(want.values()))
