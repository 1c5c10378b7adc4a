import math
import re
from collections import Counter

import regex
from pyspark.sql import functions as F

from stratalake.llm import queries, rules

from .conftest import prose, same_rows

SPACES = "[\x20\x09-\x0d]+"


def plain(t):
    t = t or ""
    w = [x for x in re.split(SPACES, t) if x]
    tri = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(t.count(c) for c in "#*$%&|<>"), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "base_failed": len(w) < 50 or 100 * len(covered) > 50 * len(w)}


def test_base_counts(spark, odd, empty):
    texts = [None, "", "a b c", "a b c a b c", "x a b c y a b c z", "a a a a", "l\nl\n \n\nl\r\nl", "𝒳 é #*$%&|<>\x0b\x0c", "a b  ", prose(1) + "\n" + prose(1), "w " * 3000, prose(2, 20_000)]
    df = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, n_words int")
    for r in rules.base_counts(df).collect():
        want = plain(r.text)
        assert {k: r[k] for k in want} == want, r.text
    assert same_rows(odd, rules.base_counts(odd)) and rules.base_counts(empty).count() == 0


def units(t):
    return regex.findall(r"[\p{L}\p{M}\p{N}]+|[^\p{L}\p{M}\p{N}\x20\x09-\x0D]+", t or "")


def test_ratio_against_plain_counts(spark):
    docs = spark.createDataFrame([(1, "good words here"), (2, "bad%% words | here"), (3, "good words"), (4, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, quality int")
    grams = lambda t: [(a,) for a in units(t)] + list(zip(units(t), units(t)[1:])) + ([(units(t)[-1], None)] if units(t) else [])
    target, raw = Counter(), Counter()
    for r in docs.collect():
        raw.update(grams(r.text))
        if r.doc_id in (1, 3):
            target.update(grams(r.text))
    size = rules.SMOOTHING * rules.BUCKETS
    ratio = lambda g: math.log((target[g] + rules.SMOOTHING) / (sum(target.values()) + size)) - math.log((raw[g] + rules.SMOOTHING) / (sum(raw.values()) + size))
    for r in rules.judge(docs, labels).collect():
        g = grams(r.text)
        assert abs(r.llr - (sum(map(ratio, g)) / len(g) if g else 0.0)) < 1e-6


def test_more_text_has_more_buckets(spark, monkeypatch):
    assert [rules.buckets_for(x << 20) for x in (0, 32, 33, 256, 257, 100 << 20)] == [1 << k for k in (13, 13, 14, 14, 15, 21)]
    docs = spark.createDataFrame([(1, "good words here"), (2, "bad%% words | here"), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    monkeypatch.setattr(rules, "BASE_BYTES", 4)  # 33 bytes
    assert len(rules.ratios(docs, labels)) == 4 * rules.BUCKETS == len(rules.ratios(docs, labels.where("false")))
    t, r = 6 + 2 * rules.BUCKETS, 16 + 2 * rules.BUCKETS  # the last unit also counts as a pair with none
    ratio = lambda good, n: math.log((good + 0.5) / t) - math.log((n + 0.5) / r)
    got = {x.doc_id: x.llr for x in rules.judge(docs, labels).collect()}
    want = {1: (3 * ratio(1, 1) + 3 * ratio(1, 2)) / 6, 2: (7 * ratio(0, 1) + 3 * ratio(1, 2)) / 10, 3: 0.0}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_verdicts(spark, odd, empty, labels):
    got = rules.judge(odd.withColumn("llr", F.lit("clash")), labels)
    assert same_rows(odd, got) and all(not r.kept for r in got.where("base_failed").collect())
    assert rules.judge(odd, labels.where("false")).where("llr <> 0").count() == 0 and rules.judge(empty, labels).count() == 0


def test_query_keeps_good_and_drops_bad(spark, data):
    got = queries.op2_quality_rules(spark, data).join(spark.read.parquet(f"{data}/labels.parquet"), "doc_id").where("not base_failed").collect()
    for r in got:
        assert r.kept == (r.quality == 1) or abs(r.llr - rules.THRESHOLD) < 0.1
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    for r in queries.op2_quality_rules(spark, data).collect():
        want = plain(docs[r.doc_id])
        assert {k: r[k] for k in want} == want


def test_target_is_every_trusted_document(spark, monkeypatch):
    docs = spark.range(13_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.col("id")).alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    twice = labels.unionByName(labels.withColumn("quality", F.lit(0)))  # the larger label counts, once
    assert rules.ratios(docs, twice) == [0.0] * rules.BUCKETS  # all is trusted, so both shares agree
    half = labels.where("doc_id % 2 = 0")
    sent = rules.ratios(docs, half)
    monkeypatch.setattr(rules, "MOST_SENT", 10)
    assert rules.ratios(docs, half) == sent != [0.0] * rules.BUCKETS


def test_held_out_verdicts(spark, data):
    """Good documents that are not the target themselves, with the buckets that the text's size gives."""
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    got = rules.judge(docs, labels.where(~held)).where(held & ~F.col("base_failed")).join(labels.where("quality IS NOT NULL").select("doc_id", "quality"), "doc_id").collect()
    right = sum(r.kept and r.quality == 1 for r in got)
    good, kept = sum(r.quality == 1 for r in got), sum(r.kept for r in got)
    assert len(got) > good > 0 and right >= 0.95 * good and right >= 0.95 * kept
