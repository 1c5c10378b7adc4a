import re

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from stratalake.llm import mixing as m, queries


def test_targets_fill_up(spark):
    rows = [(s, n) for s, n in (("a", 1000), ("b", 100), ("c", 4000), ("d", 10), (None, 300))]
    got = {r.source: r for r in m.source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    budget = 1.5 * sum(n for _, n in rows)
    assert abs(sum(r.target for r in got.values()) - budget) < 1e-6
    assert [got[s].weight for s in ("a", "b", "c", "d", None)] == [5.0, 2.0, 1.0, 5.0, 2.0]
    free = [r for r in got.values() if r.target < 2 * r.source_size - 1e-9]
    assert len({round(r.target / r.weight, 6) for r in free}) <= 1
    assert all(r.target <= 2 * r.source_size + 1e-9 for r in got.values())


def check(spark, docs):
    rows = m.mix(docs).collect()
    size = lambda t: len([x for x in re.split("[\x20\x09-\x0d]+", t or "") if x])
    assert sorted(r.size for r in rows) == sorted(size(r.text) for r in docs.select("text").collect())
    by = {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        assert (r.first_position is None) == (r.taken == 0)
        by.setdefault(r.source, []).append(r)
    for of in by.values():
        assert abs(sum(r.taken for r in of) - of[0].target) <= 1
    again = m.mix(docs.repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    return rows


def test_odd_rows(spark, odd, empty, monkeypatch):
    check(spark, odd)
    monkeypatch.setattr(m, "RUN_ROWS", 2)
    check(spark, odd)
    assert m.mix(empty).count() == 0


def test_runs_do_not_change_the_result(spark, data, monkeypatch):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    a = check(spark, docs)
    monkeypatch.setattr(m, "RUN_ROWS", 7)
    assert sorted(map(str, check(spark, docs))) == sorted(map(str, a))


def test_position_inverts_the_schedule(spark):
    df = spark.range(0, 101).select((F.col("id") / 100).alias("t"), F.explode(F.array(*[F.lit(x) for x in (-0.5, 0.0, 0.5, 1.0)])).alias("b"))
    done = F.col("t") + F.col("b") * (F.col("t") * F.col("t") - F.col("t"))
    assert df.where(F.abs(m.position(done, F.col("b")) - F.col("t")) > 1e-9).count() == 0


def test_training_order(spark, data):
    mixed = m.mix(spark.read.parquet(f"{data}/documents.parquet"))
    order = m.training_order(mixed).collect()
    assert [r.position for r in order] == sorted(r.position for r in order) and 0 <= order[0].position and order[-1].position <= 1
    assert sum(r.pass_words for r in order) == mixed.agg(F.sum("taken").alias("t")).first().t
    early, late = ([r for r in order if (r.position < 0.5) == e and r.ramp > 0] for e in (True, False))
    assert sum(r.pass_words for r in late) > sum(r.pass_words for r in early)


def test_query_matches_sql(spark, data):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{data}/documents.parquet'")
    want = c.execute(m.MIX_SQL).df().sort_values("doc_id").reset_index(drop=True)
    got = queries.op4_source_mixing(spark, data).toPandas().sort_values("doc_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want[got.columns], check_exact=True)


def test_query_follows_training_order(spark, data, monkeypatch):
    whole = queries.op4_source_mixing(spark, data).collect()
    order = m.training_order
    monkeypatch.setattr(m, "training_order", lambda mixed: order(mixed).where("position < 0.5"))
    half = queries.op4_source_mixing(spark, data).collect()
    assert len(half) == len(whole) and 0 < sum(r.taken for r in half) < 0.7 * sum(r.taken for r in whole)


def test_dealt_equals_plain_shares(spark, odd, empty):
    got, order = m.dealt(odd)
    assert sorted((str(r.doc_id), r.row_hash, r.taken) for r in got.collect()) == sorted((str(r.doc_id), r.row_hash, r.taken) for r in m.mix(odd).collect())
    assert got.where("size = 0 AND taken = 0").count() == 4 and [r.position for r in order.collect()] == sorted(r.position for r in order.collect())
    assert m.dealt(empty)[0].count() == 0


def test_ramps_decide_positions_and_order(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    orders, shares = [], []
    for ramps in ((0.5, 0.0, -0.5), (0.0, 0.0, 0.0), (-0.5, 0.0, 0.5)):
        rows = m.training_order(m.mix(docs, ramps=ramps)).collect()
        orders.append([(r.doc_id, r["pass"]) for r in rows])
        first = min(r.source for r in rows if r.source is not None)
        shares.append(sum(r.pass_words for r in rows if r.source == first and r.position < 0.5))
    assert orders[0] != orders[1] != orders[2] and shares[0] < shares[1] < shares[2]
    assert len({frozenset(o) for o in orders}) == 1


def test_equal_rows_and_hot_ids_are_placed_one_by_one(spark, monkeypatch):
    monkeypatch.setattr(m, "RUN_ROWS", 10)
    docs = spark.createDataFrame([(None, "a b c", "s")] * 40 + [(7, f"x{i} y", "s") for i in range(200)] + [(1, "q", "t")], "doc_id long, text string, source string")
    rows = m.mix(docs).collect()
    assert len(rows) == 241 and sorted(r.copy for r in rows if r.doc_id is None) == list(range(40))
    spans = sorted((r.place, r.size) for r in rows if r.source == "s")
    assert spans == [(sum(n for _, n in spans[:i]), n) for i, (_, n) in enumerate(spans)]


def test_every_tenth_of_the_run_has_as_many_words(spark, data):
    """The words that the schedules give by t are t of all; what is read off the passes differs by parts of documents only."""
    docs = spark.read.parquet(f"{data}/documents.parquet")
    for ramps in (m.RAMPS, (3.0, 0.0, -0.5)):
        targets = m.source_targets(docs.select("source", F.size(m.words(F.col("text"))).cast("long").alias("size")), ramps=ramps).collect()
        total = sum(r.target for r in targets)
        assert abs(sum(r.target * r.ramp for r in targets)) < 1e-6 * total and max(abs(r.ramp) for r in targets) <= 1
        rows = m.training_order(m.mix(docs, ramps=ramps)).collect()
        largest = max(r.pass_words for r in rows)
        for tenth in range(1, 10):
            got = sum(r.pass_words for r in rows if r.position < tenth / 10)
            assert abs(got - total * tenth / 10) <= largest * len(targets)


def test_many_equal_rows_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(m, "COPIES", 7)
    docs = spark.createDataFrame([(1, "a b", "s")] * 100 + [(2, "c", "s"), (3, "d e f", "t")], "doc_id long, text string, source string")
    rows = m.mix(docs)
    assert rows.count() == 102 and sorted(r.copy for r in rows.where("doc_id = 1").collect()) == list(range(100))
    parts = m.copied(spark.createDataFrame([("k", 100)], "key string, copies long"), True).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) > 1
