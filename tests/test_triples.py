"""Counts that the triple table must have, the questions to it, and its outputs."""

from pyspark.sql import functions as F

from stratalake import dims
from stratalake.operators import graph_queries, series, sinks, smooth, triples


def observations(spark, n, sites=1):
    rows = [(f"{s}_cave", s, e, i, float(i), float(i % 7)) for s in range(sites) for e in (1, 2) for i in range(n)]
    df = spark.createDataFrame(rows, "slug string, site_id long, entity_id long, sample_id long, age_ka double, value double")
    df = smooth.smooth(df, ["slug", "entity_id"], ["age_ka", "sample_id"], "value").withColumns({"depth_mm": F.lit(None).cast("double"), "depth_m": F.col("age_ka")})
    return series.with_sequence(df, ["slug"], ["entity_id", "age_ka", "sample_id"])


def test_core_graph_has_93_and_19_each(spark):
    obs = observations(spark, 12)
    parts = [triples.core_observation_triples(obs.withColumn("value", F.col("value") + d), "core", p, n) for p, n, d in (("CH4", 2, 0), ("d18O", 5, 1))]
    meta = triples.core_metadata(spark, "core", "2024-01-01")
    assert meta.count() == meta.distinct().count() == 93
    whole = triples.union_graphs(meta, *parts)
    assert whole.count() == whole.distinct().count() == 93 + 19 * 48


def test_cave_graph_has_19_and_4_and_12(spark):
    obs, sites = observations(spark, 11, sites=3), 3
    samples = obs.select("slug", F.col("slug").alias("site_name"), "entity_id", F.lit(None).cast("string").alias("entity_name"), "site_id")
    graphs = [triples.cave_observation_triples(obs, "c", "Delta18O"), triples.sample_triples(samples, "c"), triples.cave_context_triples(samples, "c")]
    each = [g.distinct().count() for g in graphs]
    assert each[:2] == [12 * 22 * sites, 4 * 2 * sites]
    assert each[2] == 19 * sites - 13 * (sites - 1)  # the caves share 13 of them
    assert triples.cave_observation_triples(observations(spark, 10), "c", "Delta18O").count() == 10 * 20
    assert triples.cave_observation_triples(obs.withColumn("depth_mm", F.lit(1.0)), "c", "Delta18O").count() == 13 * 22 * sites
    placed = triples.cave_context_triples(samples.withColumns({"lon": F.lit(1.0), "lat": F.lit(2.0)}), "c")
    assert placed.distinct().count() == each[2] + 3 * sites


def sites(spark):
    rows = [(1, 'A "q" \\ n', " POINT(1 2)", 5, 0), (12345, "B", dims.CRS + " POINT(3 4)", 9, None), (3, "C\nD", "POINT(5 6)", 7, 2)]
    return spark.createDataFrame(rows, "site_id long, site_name string, wkt string, n_d18o long, n_d13c long")


def test_site_graph_and_questions(spark):
    g = triples.site_triples(sites(spark), "s")
    assert g.count() == 9 * 3 - 1
    members = g.where(F.col("p") == dims.iri("geo:hasGeometry")).select("s")
    own, everyone = (triples.collection_members(members, "s", c, c, comment=n) for c, n in (("Own", None), (triples.ALL_SITES, "all")))
    assert (own.count(), everyone.count()) == (2 + 3, 3 + 3)
    whole = triples.union_graphs(g, own, everyone)
    assert graph_queries.sites_with_geometry(whole).count() == 6
    assert graph_queries.sites_with_geometry(whole, distinct=True).count() == 3
    assert [(r.name, r.d18o_count) for r in graph_queries.site_counts(whole).collect()] == [("C\nD", 7), ('A "q" \\ n', 5)]


def test_geo_sites(spark):
    df = spark.createDataFrame([("x", "X", 123.35, -75.1)], "name string, label string, lon double, lat double")
    g = triples.geo_site_triples(df, "g", ["own:DrillingSite"])
    assert g.count() == 8 and g.where(F.col("o") == dims.NAMESPACES["geo"] + "Geometry").count() == 0
    wkt = triples.geo_site_triples(df.drop("lon", "lat").withColumn("wkt", F.lit(dims.CRS + " POINT(1 2)")), "g")
    assert wkt.count() == 7 and wkt.where(F.col("o").startswith(dims.CRS + " " + dims.CRS)).count() == 0


def test_star_needs_class_and_all_predicates(spark):
    g = triples.core_observation_triples(observations(spark, 12), "c", "CH4", 2)
    found = graph_queries.observations_by_age(g, "sosa:Observation")
    ages = [r.age for r in found.collect()]
    assert len(ages) == 24 and ages == sorted(ages)
    assert graph_queries.observations_by_age(g, "own:CH4Observation").count() == 0


def test_union_is_a_set(spark):
    a = triples.constants(spark, "a", [("own:X", "rdf:type", "own:Y", None, None), ("own:X", "rdfs:label", "x", None, "en")])
    b = triples.constants(spark, "b", [("own:X", "rdf:type", "own:Y", None, None)])
    assert triples.union_graphs(shared=[a, b], name="all").count() == 2
    assert triples.graph_counts(a.unionByName(a)).first().n_triples == 2


def test_text_outputs(spark, tmp_path):
    g = triples.site_triples(sites(spark), "s")
    sinks.write_ntriples(g, str(tmp_path / "nt"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "nt")).select("value").collect()]
    assert len(lines) == 26 and all(x.endswith(" .") for x in lines) and any('"A \\"q\\" \\\\ n"@en' in x for x in lines) and any('"C\\nD"@en' in x for x in lines)
    sinks.write_subject_blocks(g, str(tmp_path / "ttl"), by_graph=False)
    assert sinks.subject_blocks(g).count() == 6
    sinks.write_graph(g, str(tmp_path / "pq"))
    assert spark.read.parquet(str(tmp_path / "pq")).select(*triples.COLUMNS).exceptAll(g.select(*triples.COLUMNS)).count() == 0
    report = sinks.run_report(("graphs", triples.graph_counts(g)))
    sinks.write_report(report, str(tmp_path / "report"))
    assert {r.measure: r.number for r in spark.read.json(str(tmp_path / "report")).collect()}["n_triples"] == 26.0
    sinks.write_series(g.withColumn("series_id", F.lit("x")), str(tmp_path / "series"))
    assert spark.read.parquet(str(tmp_path / "series")).count() == 26


def test_large_subjects_get_several_blocks(spark):
    links = [("own:D", "own:hasObservation", f"own:O{i}", None, None) for i in range(100)] + [("own:E", "rdf:type", "own:D", None, None)]
    g = triples.constants(spark, "g", links)
    got = sinks.subject_blocks(g, most=10).collect()
    own = [r.block for r in got if r.s.endswith("D")]
    assert 5 < len(own) < 20 and sum(b.count("hasObservation") for b in own) == 100 and max(b.count("hasObservation") for b in own) < 30
    assert len(got) == len(own) + 1 and all(b.endswith(" .") for b in own)


def test_metadata_takes_texts_and_places(spark):
    given = triples.core_metadata(spark, "m", "2020-05-06", texts={"title": "Deep core"}, sources={"CH4": {"creator": "Someone", "unit": "PPM"}}, lon=1.5, lat=-2.0)
    o = {(r.s.removeprefix(dims.BASE), r.p): r.o for r in given.collect()}
    assert given.distinct().count() == 93 and o["Dataset", dims.iri("dct:title")] == "Deep core" and o["Source_Dataset_CH4", dims.iri("dct:creator")] == "Someone"
    assert o["Property_CH4", dims.iri("qudt:unit")] == dims.iri("unit:PPM") and o["Site_Geometry", dims.iri("geo:asWKT")].endswith("POINT(1.500000 -2.000000)")
    assert triples.core_metadata(spark, "m", "2020-05-06", lon=None).count() == 91


def test_graph_counts_grow_in_tasks(spark, monkeypatch):
    g = spark.range(1000).selectExpr("if(id % 9 = 0, null, 'g') graph", "concat('s', id % 50) s", "concat('p', id % 3) p", "concat('o', id % 100) o", "'iri' o_kind", "null o_datatype", "null o_lang").select(*[F.col(c).cast("string") for c in triples.COLUMNS])
    monkeypatch.setattr(triples, "TASK_ROWS", 50, raising=False)
    got = triples.graph_counts(g, 1000)
    assert sorted(map(str, got.collect())) == sorted(map(str, triples.graph_counts(g).collect()))
    assert ", 20), REPARTITION_BY_NUM" in got._jdf.queryExecution().executedPlan().toString()
