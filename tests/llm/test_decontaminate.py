import random
import re

import pytest
from pyspark.sql import functions as F

from stratalake.llm import decontaminate as d, queries

from .conftest import same_rows

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def plain(texts, items, size=13):
    wins = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - size + 1)) if w else []:
            wins.setdefault(tuple(w[k : k + size]), set()).update([] if i is None else [str(i)])
    out = []
    for t in texts:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in wins:
                    hit |= set(range(k, k + n))
                    found |= wins[tuple(w[k : k + n])]
        out.append((len(w), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize("block", [3, 20_000])
def test_equals_plain_search(spark, block):
    r = random.Random(4)
    text = lambda n, v="ab": " ".join(r.choice(v) + r.choice("12É") for _ in range(n))
    items = [(1, text(20)), (2, text(13)), (3, "A1, b2!"), (4, "zz"), (5, None), (6, ""), (None, text(14)), (3, text(15)), (10, text(20))]
    texts = [text(r.randrange(60)) for _ in range(60)] + [items[0][1] + " end", "Zz; a1-B2", None, "", "x " * 20_000 + items[1][1].upper().replace("É", "É")]
    docs = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, bench string")
    got = d.decontaminate(docs, spark.createDataFrame(items, "item_id long, text string"), block_windows=block).orderBy("doc_id").collect()
    assert [(r.bench.n_words, r.bench.n_hit, r.bench["items"]) for r in got] == plain(texts, items)


def test_odd_rows(spark, odd, empty):
    items = spark.createDataFrame([(1, odd.where("doc_id = 1").first().text)], "item_id long, text string")
    got = d.decontaminate(odd, items)
    assert same_rows(odd, got) and got.where(d.contaminated()).count() == 3
    assert d.decontaminate(odd, items.where("false")).where("bench.n_hit > 0").count() == 0 and d.decontaminate(empty, items).count() == 0


def test_spans_can_be_cut(spark):
    docs = spark.createDataFrame([("-- Keep this; a b c d. And THAT",), ("plain",)], "text string")
    items = spark.createDataFrame([(1, "A B C D")], "item_id long, text string")
    got = d.decontaminate(docs, items).select(d.remove_spans(F.col("text"), F.col("bench.spans")).alias("t")).collect()
    assert [r.t for r in got] == ["-- Keep this; And THAT", "plain"]


def test_filter_keeps_the_plan_small(spark, odd):
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    kept = d.decontaminate(odd, items).where(~d.contaminated())
    assert len(kept._jdf.queryExecution().optimizedPlan().toString()) < 200_000


def test_query(spark, data):
    docs, items = (spark.read.parquet(f"{data}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    want = {r.doc_id: w for r, w in zip(docs, plain([r.text for r in docs], [(i.item_id, i.text) for i in items]))}
    for r in queries.op3_benchmark_decontamination(spark, data).collect():
        n, hit, found = want[r.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(found), hit > 0 and 20 * hit >= n)


def test_plan_is_as_large_for_any_benchmark(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    size = lambda n: len(d.decontaminate(docs, spark.range(n).select(F.col("id").alias("item_id"), F.concat(F.lit("w "), F.col("id")).alias("text")))._jdf.queryExecution().optimizedPlan().toString())
    assert size(2000) < 1.1 * size(20) and size(20) < 20_000


def test_common_window_and_many_items(spark, monkeypatch):
    monkeypatch.setattr(d, "SENT_BYTES", 0)  # all joins shuffle
    items = spark.range(50).select(F.col("id").alias("item_id"), F.lit("a b c").alias("text"))
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit("A b C "), F.col("id")).alias("text"))
    got = d.decontaminate(docs, items).collect()
    assert len(got) == 300 and {(r.bench.n_hit, len(r.bench["items"])) for r in got} == {(3, 50)}
