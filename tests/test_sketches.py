"""Sketched distinct counts against exact ones."""

import pytest
from pyspark.sql import functions as F

from stratalake.operators import sketches
from stratalake.operators.triples import SCHEMA, graph_counts


def graph(spark, start, stop, name="g"):
    rows = spark.range(start, stop).select(F.lit(name).alias("graph"), F.concat(F.lit("s"), F.col("id") % 5000).alias("s"), F.lit("p").alias("p"), F.col("id").cast("string").alias("o"))
    return rows.select("*", F.lit("literal").alias("o_kind"), *[F.lit(None).cast("string").alias(c) for c in ("o_datatype", "o_lang")])


def test_merged_runs_count_shared_triples_once(spark):
    runs = [sketches.graph_sketches(graph(spark, a, a + 60_000), lg=12) for a in (0, 20_000, 40_000)]
    total = sketches.estimated(sketches.merged(runs[0].union(runs[1]).union(runs[2]), ["graph"], lg=12)).first()
    assert total.n_rows == 180_000 and total.n_predicates == 1
    assert abs(total.n_triples - 100_000) < 4 * sketches.relative_error(12) * 100_000
    assert abs(total.n_subjects - 5000) < 4 * sketches.relative_error(12) * 5000
    assert total.n_triples != 180_000


def test_exact_up_to_the_sketch_and_in_any_grouping(spark):
    both = graph(spark, 0, 4000, "a").union(graph(spark, 2000, 6000, "b")).union(graph(spark, 2000, 6000, "b"))
    kept = sketches.graph_sketches(both, lg=13)
    exact = graph_counts(both)
    rows = sketches.against_exact(sketches.estimated(kept), exact, ["graph"], lg=13).collect()
    assert {r.graph for r in rows} == {"a", "b"} and all(r[f"{c}_within"] for r in rows for c in sketches.GRAPH)
    assert sketches.estimated(sketches.merged(kept, lg=13)).first()[:4] == (12_000, 6000, 5000, 1)
    pairs = spark.createDataFrame([("a", "b"), ("a", "a"), ("a", "none"), (None, "b")], "left string, right string")
    got = {(r.left, r.right): (r.n_triples, r.n_subjects) for r in sketches.shared(kept, pairs).collect()}
    assert got == {("a", "b"): (2000, 3000), ("a", "a"): (4000, 4000)}


def test_a_wrong_or_absent_estimate_is_told(spark):
    exact = spark.createDataFrame([("a", 10), ("b", 10), (None, 10), ("d", 1_000_000), ("e", 1_000_000)], "k string, n long")
    got = spark.createDataFrame([("a", 11), (None, 10), ("d", 1_001_000), ("e", 1_100_000)], "k string, n long")
    assert {r.k: r.n_within for r in sketches.against_exact(got, exact, ["k"]).collect()} == {"a": False, "b": False, None: True, "d": True, "e": False}


def test_nulls_repeats_and_empty_tables(spark):
    rows = [(None, "s", "p", None, "iri", None, None), (None, "s", "p", None, "iri", None, None), (None, None, "p", "s", "iri", None, None), (None, "s", "p", "", "iri", None, None), ("g", "s", None, "x", "iri", None, "en")]
    df = spark.createDataFrame(rows, SCHEMA)
    want = {tuple(r) for r in graph_counts(df).collect()}
    assert {(r.graph, r.n_triples, r.n_subjects, r.n_predicates) for r in sketches.estimated(sketches.graph_sketches(df)).collect()} == want
    assert sketches.graph_sketches(df.limit(0)).count() == 0
    total = sketches.estimated(sketches.merged(sketches.graph_sketches(df.limit(0)))).first()
    assert total.n_triples == 0 and total.n_rows is None


def test_kept_sketches_are_replaced_by_key(spark, tmp_path):
    path = f"{tmp_path}/k"
    sketches.keep(sketches.graph_sketches(graph(spark, 0, 100, "ä b").union(graph(spark, 0, 50, None))), path)
    sketches.keep(sketches.graph_sketches(graph(spark, 90, 120, None).union(graph(spark, 0, 10, "c"))), path)
    got = {r.graph: (r.n_rows, r.n_triples) for r in sketches.estimated(sketches.kept(spark, path)).collect()}
    assert got == {"ä b": (100, 100), None: (30, 30), "c": (10, 10)}
    assert sketches.estimated(sketches.merged(sketches.kept(spark, path))).first().n_triples == 120


@pytest.mark.parametrize("keys", [["graph"], []])
def test_triples_are_not_shuffled(spark, keys):
    plan = sketches.sketched(graph(spark, 0, 100), keys, sketches.GRAPH)._jdf.queryExecution().executedPlan().toString()
    first = plan.split("Exchange")
    assert len(first) == 3 and "partial_theta_sketch_agg" in first[2] and "partial_theta_union_agg" in first[1]


def test_a_group_of_many_tasks(spark):
    rows = graph(spark, 0, 3000).unionByName(graph(spark, 1000, 4000)).repartition(100)
    got = sketches.estimated(sketches.graph_sketches(rows)).collect()
    assert [(r.graph, r.n_rows, r.n_triples) for r in got] == [("g", 6000, 4000)]
    assert sketches.sketched(rows.limit(0), [], {"n": ["s"]}).count() == 0
