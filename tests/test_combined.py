"""A combined graph brought up to date in steps, against the union as a set."""

import os
import random

import pytest
from pyspark.sql import functions as F

from stratalake.operators import combined
from stratalake.operators.triples import SCHEMA


def table(spark, graphs):
    rows = [(g, s, "http://x/p", o, "literal", None, lang) for g, triples in graphs.items() for s, o, lang in triples]
    return spark.createDataFrame(rows, SCHEMA)


def files(path, kind):
    return {(d, f) for d, _, names in os.walk(f"{path}/{kind}") for f in names if f.endswith(".parquet")}


def holds(at, graphs):
    got = [(r.s, r.o, r.o_lang) for r in at.triples("all").collect()]
    assert len(got) == len(set(got)) and set(got) == {t for ts in graphs.values() for t in ts}
    assert {(r.graph, r.s, r.o, r.o_lang) for r in at.parts().collect()} == {(g, *t) for g, ts in graphs.items() for t in ts}
    assert {r.graph for r in at.digests().collect()} == {g for g in graphs}


def test_one_changed_graph_rewrites_its_own_folders(spark, tmp_path):
    path = f"{tmp_path}/g"
    graphs = {f"cave/{i} ä": {(f"s{i}", str(k), None) for k in range(20)} | {("shared", "x", "en")} for i in range(5)}
    at, report = combined.update(table(spark, graphs), path)
    assert {r.status for r in report.collect()} == {"new"}
    holds(at, graphs)
    before = {k: files(path, k) for k in ("whole", "parts")}
    graphs["cave/2 ä"] |= {("s2", "late", None), ("s1", "0", None)}
    at, report = combined.update(table(spark, graphs), path)
    assert {r.graph for r in report.where("status <> 'same'").collect()} == {"cave/2 ä"}
    holds(at, graphs)
    for k, was in before.items():
        assert len({d for d, _ in was ^ files(path, k)}) == 1
    assert tuple(combined.counts(at, "all").first()) == ("all", 102, 6, 1)
    now = {k: files(path, k) for k in before}
    _, report = combined.update(table(spark, graphs), path)
    assert {r.status for r in report.collect()} == {"same"} and now == {k: files(path, k) for k in before}


def test_a_triple_stays_while_any_graph_states_it(spark, tmp_path):
    path, t, u = f"{tmp_path}/g", ("s", "o", None), ("s", "o", "en")
    steps = [{"a": {t, u}, "b": {t, ("b", "1", None)}, None: {t}}, {"a": {u}}, {"b": {u}}, {None: {u}}, {"a": {("a", "2", None)}}]
    have = {}
    for step in steps:
        have |= step
        holds(combined.update(table(spark, step), path)[0], have)
    have = {"b": {t}}
    at, report = combined.update(table(spark, have), path, complete=True)
    assert {(r.graph, r.status) for r in report.collect()} == {("a", "gone"), (None, "gone"), ("b", "changed")}
    holds(at, have)
    holds(combined.update(table(spark, {"a": {u}}), path)[0], have | {"a": {u}})
    at, _ = combined.update(table(spark, {}), path, complete=True)
    holds(at, {})


@pytest.mark.parametrize("sent", [combined.SENT, 0])
def test_random_steps(spark, tmp_path, monkeypatch, sent):
    monkeypatch.setattr(combined, "SENT", sent)
    random.seed(sent)
    have = {}
    for _ in range(3):
        step = {g: {(f"s{random.randrange(3)}", str(random.randrange(4)), random.choice([None, "en"])) for _ in range(6)} for g in random.sample("abcd", 2)}
        have |= step
        holds(combined.update(table(spark, step), f"{tmp_path}/g")[0], have)


def test_repeats_and_a_run_that_was_cut_off(spark, tmp_path, monkeypatch):
    path, g = f"{tmp_path}/g", {"a": {("s", "1", None), ("x", "1", None)}, "b": {("s", "1", None)}}
    holds(combined.update(table(spark, g).union(table(spark, g)), path)[0], g)
    real, calls = combined.put, []

    def stop(rows, where, mode):
        calls.append(where)
        if len(calls) == stop.at:
            raise RuntimeError("cut off")
        real(rows, where, mode)

    for stop.at, after in ((2, {("y", "1", None)}), (3, {("z", "1", None), ("s", "1", None)})):
        g, calls[:] = g | {"a": after, "b": g["b"] | {("b", str(stop.at), None)}} if stop.at == 3 else g | {"a": after}, []
        monkeypatch.setattr(combined, "put", stop)
        try:
            combined.update(table(spark, g), path)
        except RuntimeError:
            pass
        monkeypatch.setattr(combined, "put", real)
        holds(combined.update(table(spark, g), path)[0], g)


def test_stored_triples_are_not_shuffled_for_a_small_change(spark, tmp_path):
    at, _ = combined.update(table(spark, {"a": {("s", "1", None)}}), f"{tmp_path}/g")
    plan = combined.found_in(table(spark, {"b": {("s", "1", None)}}), at._read("whole"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert combined.content_digests(table(spark, {"a": {("s", "1", None)}})).where(F.col("n") == 1).count() == 1
