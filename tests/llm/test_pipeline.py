"""The pipeline stage by stage, against plain rules on what each stage was given."""

import zlib
from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from stratalake.llm import mixing
from stratalake.llm.common import stored, table

from .test_decontaminate import plain
from .test_simhash import plain_classes, plain_fingerprint


def test_stages(spark, data):
    data = data.replace("sf0.001", "sf0.01")  # labels enough to learn from
    docs = table(spark, data, "documents")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, data), name)
        kept[name] = (before.collect(), docs.collect())
        if name != "tokens":
            assert docs.columns == columns
    before, after = kept["toxicity"]
    toxic = {r.doc_id for r in table(spark, data, "labels").where("toxic = 1").collect()}
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    clean = {r.doc_id for r in table(spark, data, "labels").where("toxic = 0").collect()}
    assert len(gone & toxic) > 0.5 * len(toxic) and len(gone & clean) <= 0.02 * len(clean) and set(after) <= set(before)
    before, after = kept["near_copies"]
    prints = {r.doc_id: plain_fingerprint(r.text) for r in before}
    roots = plain_classes(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    assert sorted(r.doc_id for r in after) == sorted(set(roots.values())) and set(after) <= set(before)
    before, after = kept["decontamination"]
    found = plain([r.text for r in before], [(r.item_id, r.text) for r in table(spark, data, "benchmark").collect()])
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r, (n, hit, _) in zip(before, found) if not (hit > 0 and 20 * hit >= n))
    before, after = kept["mixing"]
    copies = Counter(r.doc_id for r in after)
    assert max(copies.values()) <= 2 and set(after) <= set(before)
    words = lambda rows: sum(len((r.text or "").split()) for r in rows)
    assert abs(words(after) - 1.5 * words(before)) < 0.2 * words(before)
    before, after = kept["tokens"]
    assert sorted(r.doc_id for r in before) == sorted(r.doc_id for r in after)
    assert min(r.start for r in after) == 0 and sum(r.n_tokens for r in after) == max(r.start + r.n_tokens for r in after)


def test_odd_rows(spark, odd, data):
    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, data), name)
        assert docs.count() > 0
    empty = stored(corpus_pipeline.STAGES[-1][1](spark, odd.where("false"), data), "none")
    assert empty.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and empty.agg(F.count("*")).first()[0] == 0
    assert zlib.crc32(b"") == 0


def test_registered():
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and corpus_pipeline.ORACLE_SQL is None


def test_mixing_takes_positioned_passes(spark, odd):
    docs = odd.where("doc_id IS NOT NULL").unionByName(odd.where("doc_id = 1").withColumn("lang", F.lit("de")))
    got = corpus_pipeline.mix_sources(spark, docs, "")
    passes = mixing.training_order(mixing.mix(docs, keep=("lang",))).where("2 * pass_words >= size").orderBy("position")
    want = Counter((r.doc_id, r.lang, r.row_hash) for r in passes.collect())
    rows = got.withColumn("row_hash", F.xxhash64("text")).collect()
    sized = [r for r in rows if (r.text or "").split()]
    assert sum(want.values()) == len(sized) and {(r.doc_id, r.row_hash) for r in sized} == {(d, h) for d, _, h in want}
    assert Counter(r.doc_id for r in rows if not (r.text or "").split()) == {3: 1, 4: 1, 5: 1}
    place = {(r.doc_id, r.row_hash): r.position for r in reversed(passes.collect())}
    firsts = list(dict.fromkeys((r.doc_id, r.row_hash) for r in sized))
    assert [place[k] for k in firsts] == sorted(place[k] for k in firsts)


@pytest.fixture
def clashing(odd):
    """Columns named as working columns might be, and documents' own."""
    return odd.select("doc_id", "text", "lang", "source", *[F.lit(f"own {c}").alias(c) for c in ("_toxicity", "_bench", "_hash", "_id", "_source", "_copies", "_rows", "_n", "fp", "root", "key", "n", "size", "target", "bench", "toxicity", "place", "copies", "w", "m")])


@pytest.mark.parametrize("at", range(5))
def test_clashing_names_empty_tables_and_repeated_rows(spark, clashing, data, at):
    name, stage = corpus_pipeline.STAGES[at]
    docs = stored(clashing.unionByName(clashing), "clashing")
    got = stage(spark, docs, data)
    assert stage(spark, docs.where("false"), data).count() == 0
    if name == "tokens":
        assert got.count() == docs.count()
        return
    assert got.columns == docs.columns and set(map(str, got.collect())) <= set(map(str, docs.collect()))
    ids = Counter(r.doc_id for r in got.collect())
    assert ids[9] == (1 if name == "near_copies" else ids[9]) and ids[9] >= 1


def test_equal_rows_share_no_more_copies_than_passes(spark):
    docs = spark.createDataFrame([(5, "a b c d", "en", "s", None)] * 3 + [(6, "e f g h i j k l", "en", "t", None)], "doc_id long, text string, lang string, source string, n_chars long")
    passes = mixing.training_order(mixing.mix(docs)).where("2 * pass_words >= size").groupBy("doc_id").count().collect()
    got = Counter(r.doc_id for r in corpus_pipeline.mix_sources(spark, docs, "").collect())
    assert got == {r.doc_id: r["count"] for r in passes} and got[5] <= 6
