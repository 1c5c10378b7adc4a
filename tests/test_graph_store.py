"""Graph text read back, and questions to a stored graph."""

import pytest

from stratalake.dims import iri
from stratalake.operators import graph_queries, sinks, store
from stratalake.operators.triples import SCHEMA
from stratalake.plans import catalog
from stratalake.sources.graph_text import read_graph_text
from stratalake.storage import stored

TURTLE = '''@prefix ex: <http://ex.org/> .
@prefix : <http://ex.org/default#> .
PREFIX xsd: <http://www.w3.org/2001/XMLSchema#>

ex:a a ex:Kind ;   # a comment ; with , marks
    ex:label "one; two, three. <no> # none"@en, "zwei"@de-AT , \'quote "in"\' ;
    ex:n 12, -1.5, 2.5e3, true ;
    ex:typed "POINT(1 2)"^^ex:wkt, "x"^^<http://ex.org/t> ;
    :link <http://ex.org/b#c>, ex:c.d, _:b1 ;
    .

ex:b ex:text "tab\\t nl\\n q\\" bs\\\\n \\u00e9\\uD83D\\uDE00 \\U0001F600 end" .
<http://ex.org/c> ex:long """two
lines "with" quotes .""" .
ex:d ex:p ex:e. ex:f ex:p "" .
'''


def test_statement_ends_within_texts_need_whole_files(spark, tmp_path):
    (tmp_path / "a.ttl").write_text('<a:s> <a:p> """one .\ntwo""" ; # note .\n <a:q> 1 .\n')
    assert sorted(r.o for r in read_graph_text(spark, str(tmp_path / "a.ttl"), whole_files=True).collect()) == ["1", "one .\ntwo"]
    with pytest.raises(Exception, match="neither a triple"):
        read_graph_text(spark, str(tmp_path / "a.ttl")).collect()


def rows(df):
    return sorted((tuple(str(x) for x in r) for r in df.collect()))


def test_turtle(spark, tmp_path):
    (tmp_path / "a.ttl").write_text(TURTLE)
    for whole in (False, True):
        got = {(r.s.removeprefix("http://ex.org/"), r.p.removeprefix("http://ex.org/"), r.o, r.o_kind, r.o_datatype, r.o_lang) for r in read_graph_text(spark, str(tmp_path / "a.ttl"), "g", whole).collect()}
        x = "http://www.w3.org/2001/XMLSchema#"
        assert got == {
            ("a", iri("rdf:type"), "http://ex.org/Kind", "iri", None, None), ("a", "label", "one; two, three. <no> # none", "literal", None, "en"), ("a", "label", "zwei", "literal", None, "de-AT"),
            ("a", "label", 'quote "in"', "literal", None, None), ("a", "n", "12", "literal", x + "integer", None), ("a", "n", "-1.5", "literal", x + "decimal", None), ("a", "n", "2.5e3", "literal", x + "double", None),
            ("a", "n", "true", "literal", x + "boolean", None), ("a", "typed", "POINT(1 2)", "literal", "http://ex.org/wkt", None), ("a", "typed", "x", "literal", "http://ex.org/t", None),
            ("a", "default#link", "http://ex.org/b#c", "iri", None, None), ("a", "default#link", "http://ex.org/c.d", "iri", None, None), ("a", "default#link", "_:b1", "iri", None, None),
            ("b", "text", 'tab\t nl\n q" bs\\n é\U0001f600 \U0001f600 end', "literal", None, None), ("c", "long", 'two\nlines "with" quotes .', "literal", None, None),
            ("d", "p", "http://ex.org/e", "iri", None, None), ("f", "p", "", "literal", None, None),
        }


@pytest.mark.parametrize("text", ["x:a x:b x:c .\n", "<a:s> <a:p> [ <a:q> 1 ] .\n", "<a:s> <a:p> ( 1 2 ) .\n", "<a:s> <a:p> bare .\n", "<a:s> <a:p> <a:x> <a:y> .\n", '<a:s> <a:p> "x"^^q:t .\n', "@prefix q: <a:> .\n@prefix q: <b:> .\nq:a q:b q:c .\n"])
def test_what_is_not_understood_raises(spark, tmp_path, text):
    (tmp_path / "bad.ttl").write_text(text)
    with pytest.raises(Exception, match="neither a triple|DUPLICATED_MAP_KEY|[Dd]uplicate"):
        read_graph_text(spark, str(tmp_path / "bad.ttl")).collect()


def test_prefixes_are_each_files_own_and_splits_keep_statements(spark, tmp_path):
    for name, base in (("a", "http://a/"), ("b", "http://b/")):
        body = "".join(f'x:s{i} x:p "v . {i}" ;\n    x:q x:o{i}, x:r{i} .\n' for i in range(3000))
        (tmp_path / f"{name}.ttl").write_text(f"@prefix x: <{base}> .\n{body}")
    whole = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = read_graph_text(spark, f"{tmp_path}/*.ttl")
        assert got.rdd.getNumPartitions() > 8 and got.count() == 2 * 9000 and got.distinct().count() == 18000
        assert got.where("s LIKE 'http://a/%' AND o_kind = 'iri' AND o LIKE 'http://a/%'").count() == 6000
        assert rows(read_graph_text(spark, f"{tmp_path}/*.ttl", most_files=0)) == rows(got)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", whole)


def carried(plan) -> list[set[str]]:
    """The columns that each explode of a plan copies to all its rows."""
    below = [x for i in range(plan.children().size()) for x in carried(plan.children().apply(i))]
    if plan.nodeName() != "Generate":
        return below
    kept = plan.requiredChildOutput()
    return [{kept.apply(i).name() for i in range(kept.size())}, *below]


def test_long_statements_are_not_copied_to_their_parts(spark, tmp_path):
    n = 5000
    many = " ;\n    ".join(f"<http://x/p> <http://x/o{i}>" for i in range(n))
    (tmp_path / "a.ttl").write_text(f"<http://x/s>\n    {many} .\n<http://x/t> <http://x/p> {', '.join(str(i) for i in range(n))} .\n")
    got = read_graph_text(spark, f"{tmp_path}/a.ttl", "g")
    found = carried(got._jdf.queryExecution().optimizedPlan())
    assert len(found) == 4 and all(c <= {"file", "graph", "prefixes", "s", "p", "verb"} for c in found)
    assert {(r.s, r.o) for r in got.collect()} == {("http://x/s", f"http://x/o{i}") for i in range(n)} | {("http://x/t", str(i)) for i in range(n)}


def graph(spark):
    odd = ['q" b\\ n\n', "", "é\U0001f600", "a ; b , c .", "\x01\x02", "# x", "'''", "tab\t."]
    t = [("g", f"http://x/s{i % 5}", f"http://x/p{i % 3}", o, "literal", ("http://x/t" if i % 2 else None), (None if i % 2 else "en")) for i, o in enumerate(odd * 2)]
    return spark.createDataFrame(t + [("h", "http://x/s1", "http://x/p9", "http://x/o", "iri", None, None)], SCHEMA).distinct()


def test_written_text_is_read_back(spark, tmp_path):
    g = graph(spark)
    sinks.write_subject_blocks(g, f"{tmp_path}/ttl")
    assert rows(read_graph_text(spark, f"{tmp_path}/ttl")) == rows(g)
    sinks.write_ntriples(g, f"{tmp_path}/nt")
    assert rows(read_graph_text(spark, f"{tmp_path}/nt")) == rows(g)
    g.where("false").write.partitionBy("graph").mode("overwrite").parquet(f"{tmp_path}/none")
    (tmp_path / "empty.ttl").write_text("")
    assert read_graph_text(spark, f"{tmp_path}/empty.ttl", "g").count() == 0


def test_tasks_of_stored_and_written_triples_are_bounded(spark, tmp_path, monkeypatch):
    g = graph(spark).coalesce(1)
    n, kept = g.count(), stored(g, "bounded", task_rows=3)
    assert rows(kept) == rows(g) and kept.rdd.getNumPartitions() >= n / 3 and max(kept.rdd.glom().map(len).collect()) <= 3
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        assert kept.sparkSession.conf.get(key) == spark.conf.get(key)
    monkeypatch.setattr(sinks, "TASK_ROWS", 3)
    sinks.write_ntriples(g, f"{tmp_path}/nt")
    assert rows(read_graph_text(spark, f"{tmp_path}/nt")) == rows(g)
    assert len(list(tmp_path.glob("nt/graph=g/*.txt"))) >= (n - 1) / 3


def test_blocks_that_are_read_back_are_short_and_of_bounded_tasks(spark, tmp_path, monkeypatch):
    n, task_rows = 2000, 5000
    spark.range(n).selectExpr("id AS event_id", "timestamp_millis(1704067200000 + id * 60000) AS ts", "id % 7 AS user_id", "'view' AS event_type", "CAST(id % 90 AS DOUBLE) AS value", "'{}' AS props").write.parquet(f"{tmp_path}/d/events.parquet")
    monkeypatch.setattr(sinks, "TASK_ROWS", task_rows)
    monkeypatch.setattr(catalog, "new_dir", lambda spark, name: f"{tmp_path}/{name}")
    got = catalog.read_graph_blocks(spark, f"{tmp_path}/d")
    assert rows(got) == rows(catalog.core_graph(spark, f"{tmp_path}/d")) and got.count() == 19 * n
    files = [f for f in tmp_path.glob("blocks/graph=core/*") if f.is_file() and f.name.startswith("part-")]
    text = sum(len(r.value) for r in spark.read.text(f"{tmp_path}/blocks").collect())
    assert sum(f.stat().st_size for f in files) < text / 10
    assert got.rdd.getNumPartitions() == len(files) >= 19 * n / task_rows


def observations(spark, n=300):
    kind = [("g", f"http://x/s{i}", iri("rdf:type"), iri("sosa:Observation"), "iri", None, None) for i in range(n)]
    values = [("g", f"http://x/s{i}", iri(p), str(i + k), "literal", None, None) for i in range(n) for k, p in enumerate(("sosa:resultTime", "sosa:hasSimpleResult", "own:smoothedValue_rollingMedian", "rdfs:label")) if i % 7 or k]
    hub = [("g", "http://x/hub", iri("own:member"), f"http://x/s{i}", "iri", None, None) for i in range(n)]
    return spark.createDataFrame(kind + values + hub + hub[:5], SCHEMA)


def test_store_answers_as_the_table_does(spark):
    g = observations(spark)
    for wide in (100, 10_000, 2):
        kept = store.write_store(g, wide=wide, buckets=4)
        assert rows(kept.triples()) == rows(g)
        assert rows(store.observations_by_age(kept, "sosa:Observation")) == rows(graph_queries.observations_by_age(g, "sosa:Observation"))
        assert [r.age for r in store.observations_by_age(kept, "sosa:Observation").collect()] == sorted(float(i) for i in range(300) if i % 7)
        assert tuple(store.graph_counts(kept).first()) == ("g", len({tuple(r) for r in g.collect()}), 301, 6)


def test_tasks_that_write_a_store_are_bounded(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(store, "stored", lambda df, name, **k: seen.setdefault(name, stored(df, name, **k)))
    monkeypatch.setattr(store, "TASK_ROWS", 100, raising=False)
    kept = store.write_store(observations(spark).coalesce(1), wide=100, buckets=2)
    assert max(seen["triples"].rdd.glom().map(len).collect()) <= 100 and rows(kept.triples()) == rows(observations(spark))
    assert store.BUCKET_ROWS <= 1_000_000


def test_star_has_no_exchange_and_reads_its_predicates_only(spark, tmp_path):
    kept = store.write_store(observations(spark), f"file://{tmp_path}/s", buckets=4)
    asked = {"age": "sosa:resultTime", "value": "sosa:hasSimpleResult"}
    narrow, wide = kept.of([iri(p) for p in asked.values()])
    plan = graph_queries.star(narrow, asked)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PartitionFilters" in plan and plan.count("IN (") + plan.count(" IN ") >= 1
    assert len(narrow.inputFiles()) <= 8 and wide.count() == 0
    again = store.open_store(spark, f"file://{tmp_path}/s", 4)
    assert rows(store.star(again, asked)) == rows(graph_queries.star(observations(spark), asked))


def test_geometry_joins_send_no_side_to_all_tasks(spark, monkeypatch):
    sites = [("g", f"http://x/s{i}", iri(p), o, "iri", None, None) for i in range(60) for p, o in (("rdfs:label", f"site {i}"), ("geo:hasGeometry", f"http://x/g{i}"))]
    places = [("g", f"http://x/g{i}", iri("geo:asWKT"), f"POINT({i} 0)", "literal", None, None) for i in range(60)]
    members = [("g", f"http://x/{c}", iri("rdfs:member"), f"http://x/s{i}", "iri", None, None) for c in "ab" for i in range(60)]
    g = spark.createDataFrame(sites + places + members, SCHEMA)
    want = sorted((f"http://x/s{i}", f"site {i}", f"POINT({i} 0)") for i in range(60))
    kept = store.write_store(g, wide=20, buckets=2)
    for task_rows in (10, 1_000_000):
        monkeypatch.setattr(graph_queries, "TASK_ROWS", task_rows)
        for distinct, repeats in ((False, 2), (True, 1)):
            for found in (store.sites_with_geometry(kept, distinct), graph_queries.sites_with_geometry(g, distinct)):
                plan = found._jdf.queryExecution().executedPlan().toString()
                assert "Broadcast" not in plan and plan.count("SortMergeJoin") == 3
                assert sorted(map(tuple, found.collect())) == sorted(want * repeats)
                assert task_rows > 10 or found.rdd.getNumPartitions() == 30


def test_empty_store(spark):
    kept = store.write_store(observations(spark).where("false"), buckets=2)
    assert kept.triples().count() == 0 and store.observations_by_age(kept, "sosa:Observation").count() == 0 and store.graph_counts(kept).count() == 0
