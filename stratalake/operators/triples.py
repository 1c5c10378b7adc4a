"""Observations, sites, samples and their context as a subject-predicate-object table.

A triple is a row (graph, s, p, o, o_kind, o_datatype, o_lang); a graph is a set of such rows. Triples of a row come from
one explode of an array of structs, so they need no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..dims import BASE, CRS, POLYORDER, WINDOW, iri
from ..functions import decimal_text, ensure_crs, mint, observation_label, wkt_point
from ..storage import TASK_ROWS

COLUMNS = ("graph", "s", "p", "o", "o_kind", "o_datatype", "o_lang")
SCHEMA = ", ".join(f"{c} string" for c in COLUMNS)
ALL_SITES = "AllSites_Collection"


def text(value: str | Column) -> Column:
    return F.lit(value) if isinstance(value, str) else value


class Triple(NamedTuple):
    """A predicate, and the struct of the whole triple."""

    predicate: str
    column: Column


def link(s: Column, p: str, o: str | Column, base: str = BASE) -> Triple:
    """A triple whose object is an identifier; a plain string is read as prefix:local."""
    return triple(s, p, F.lit(iri(o, base)) if isinstance(o, str) else o, "iri", base=base)


def literal(s: Column, p: str, o: str | Column, datatype: str | None = None, lang: str | None = None, base: str = BASE) -> Triple:
    return triple(s, p, text(o).cast("string"), "literal", iri(datatype, base) if datatype else None, lang, base)


def triple(s: Column, p: str, o: Column, kind: str, datatype: str | None = None, lang: str | None = None, base: str = BASE) -> Triple:
    none = F.lit(None).cast("string")
    return Triple(p, F.struct(
        s.alias("s"), F.lit(iri(p, base)).alias("p"), o.alias("o"), F.lit(kind).alias("o_kind"),
        (F.lit(datatype) if datatype else none).alias("o_datatype"), (F.lit(lang) if lang else none).alias("o_lang"),
    ))


def derived(s: Column, source: str | Column, base: str = BASE) -> Triple:
    """Where a record comes from: one source for all by its name, or a column of each row's own identifier (with_source_file)."""
    return link(s, "prov:wasDerivedFrom", f"own:{source}" if isinstance(source, str) else source, base)


def emitted(df: DataFrame, graph: str | Column, triples: Sequence[Triple]) -> DataFrame:
    """All triples of each row that have a subject and an object."""
    full = F.filter(F.array(*[t.column for t in triples]), lambda t: t["o"].isNotNull() & t["s"].isNotNull())
    return df.select(text(graph).alias("graph"), F.explode(full).alias("t")).select("graph", "t.*")


def constants(spark: SparkSession, graph: str, rows: Sequence[tuple], base: str = BASE) -> DataFrame:
    """A small table of fixed triples, given as (s, p, o, datatype, lang); an object with neither and a prefix is a link."""
    out = []
    for s, p, o, datatype, lang in rows:
        is_link = datatype is None and lang is None and o.startswith(("http://", "https://", *[f"{x}:" for x in ("own", "sosa", "geo", "sf", "crm", "crmsci", "unit", "dct", "dcat")]))
        value = o if not is_link or o.startswith("http") else iri(o, base)
        out.append((graph, s if s.startswith("http") else iri(s, base), iri(p, base), value, "iri" if is_link else "literal", iri(datatype, base) if datatype else None, lang))
    return spark.createDataFrame(out, SCHEMA)


def core_observation_triples(df: DataFrame, graph: str | Column, name: str, digits: int, base: str = BASE, core: str = "IceCore", unit: str = "PPB", source: str | Column = "Source", dataset: str = "Dataset", chronology: str = "Chronology", site: str = "Site") -> DataFrame:
    """19 triples per ice-core observation (seq, age_ka, depth_m, value, median, savgol): its own, the link from the dataset
    and the record of its catalogue entry. A null among the numbers leaves that triple out."""
    s = mint(f"Obs_{name}_%04d", F.col("seq"), base=base)
    number = lambda p, c, d: literal(s, p, decimal_text(F.col(c), d), "xsd:decimal", base=base)
    own = lambda x: f"own:{x}"
    return emitted(df, graph, [
        literal(s, "rdfs:label", observation_label(name, F.col("seq"), F.col("age_ka")), lang="en", base=base),
        link(s, "own:measurementType", own(f"MeasurementType_{name}"), base),
        link(s, "rdf:type", "sosa:Observation", base), link(s, "rdf:type", "crmsci:S4_Observation", base),
        link(s, "sosa:hasFeatureOfInterest", own(core), base), link(s, "sosa:observedProperty", own(f"Property_{name}"), base),
        number("sosa:hasSimpleResult", "value", digits), number("sosa:resultTime", "age_ka", 4), number("own:atDepth_m", "depth_m", 2),
        link(s, "own:ageChronology", own(chronology), base), link(s, "qudt:unit", f"unit:{unit}", base),
        number("own:smoothedValue_rollingMedian", "median", digits), number("own:smoothedValue_savgol", "savgol", digits),
        link(s, "own:smoothingMethod_median", own(f"RollingMedian_w{WINDOW}"), base), link(s, "own:smoothingMethod_savgol", own(f"SavitzkyGolay_w{WINDOW}_p{POLYORDER}"), base),
        derived(s, source, base), link(s, "crm:P7_took_place_at", own(site), base),
        link(F.lit(iri(own(dataset), base)), "own:hasObservation", s, base), link(F.lit(iri(own(f"{dataset}_{name}"), base)), "dcat:record", s, base),
    ])


def cave_observation_triples(df: DataFrame, graph: str | Column, name: str, base: str = BASE, source: str | Column = "DataSource") -> DataFrame:
    """12 triples per cave observation (slug, entity_id, seq, age_ka, value, median, savgol, depth_mm): one more with a depth,
    two fewer for each smoothed value that is null."""
    s = mint(f"Obs_{name}_%s_e%s_%05d", F.col("slug"), F.col("entity_id"), F.col("seq"), base=base)
    number = lambda p, c, d: literal(s, p, decimal_text(F.col(c), d), "xsd:decimal", base=base)
    given = lambda c, x: F.when(F.col(c).isNotNull(), F.lit(iri(f"own:{x}", base)))
    return emitted(df, graph, [
        link(s, "rdf:type", f"own:{name}Observation", base), link(s, "sosa:hasFeatureOfInterest", mint("Speleothem_%s_e%s", F.col("slug"), F.col("entity_id"), base=base), base),
        link(s, "sosa:observedProperty", f"own:Property_{name}", base), link(s, "own:measurementType", f"own:MeasurementType_{name}", base),
        number("own:ageKaBP", "age_ka", 4), number("own:measuredValue", "value", 4), number("own:atDepth_mm", "depth_mm", 3),
        link(s, "own:ageChronologySpeleothem", mint("UThChronology_%s", F.col("slug"), base=base), base),
        number("own:smoothedValue_rollingMedian", "median", 4), link(s, "own:smoothingMethod_median", given("median", f"RollingMedian_w{WINDOW}"), base),
        number("own:smoothedValue_savgol", "savgol", 4), link(s, "own:smoothingMethod_savgol", given("savgol", f"SavitzkyGolay_w{WINDOW}_p{POLYORDER}"), base),
        derived(s, source, base),
    ])


def site_triples(df: DataFrame, graph: str | Column, base: str = BASE, source: str = "DataSource") -> DataFrame:
    """9 triples per site (site_id, site_name, wkt, n_d18o, n_d13c): six of the cave, two of its geometry and their link. A
    null count leaves its triple out."""
    s, g = mint("Cave_site_%04d", F.col("site_id"), base=base), mint("Cave_site_%04d_Geometry", F.col("site_id"), base=base)
    return emitted(df, graph, [
        link(s, "rdf:type", "own:Cave", base), literal(s, "rdfs:label", F.col("site_name"), lang="en", base=base),
        literal(s, "own:siteId", F.col("site_id"), "xsd:integer", base=base),
        literal(s, "own:countD18OSamples", F.col("n_d18o"), "xsd:integer", base=base), literal(s, "own:countD13CSamples", F.col("n_d13c"), "xsd:integer", base=base),
        link(s, "prov:wasDerivedFrom", f"own:{source}", base), link(g, "rdf:type", "sf:Point", base),
        literal(g, "geo:asWKT", ensure_crs(F.col("wkt")), "geo:wktLiteral", base=base), link(s, "geo:hasGeometry", g, base),
    ])


def geo_site_triples(df: DataFrame, graph: str | Column, extra_types: Sequence[str] = (), base: str = BASE) -> DataFrame:
    """7 triples per site (name, label, and lon and lat or wkt), and one for each extra type: a feature with a point."""
    s, g = mint("%s_Site", F.col("name"), base=base), mint("%s_Geometry", F.col("name"), base=base)
    wkt = ensure_crs(F.col("wkt")) if "wkt" in df.columns else wkt_point(F.col("lon"), F.col("lat"))
    return emitted(df, graph, [
        *[link(s, "rdf:type", t, base) for t in ("geo:Feature", "crm:E53_Place", "crm:E27_Site", *extra_types)],
        literal(s, "rdfs:label", F.col("label"), lang="en", base=base), link(s, "geo:hasGeometry", g, base),
        link(g, "rdf:type", "sf:Point", base), literal(g, "geo:asWKT", wkt, "geo:wktLiteral", base=base),
    ])


def sample_triples(df: DataFrame, graph: str | Column, base: str = BASE) -> DataFrame:
    """4 triples per sample (slug, site_name, entity_id, entity_name), each distinct sample once; a null name becomes the id."""
    rows = df.where("entity_id IS NOT NULL").select("slug", "site_name", F.col("entity_id").cast("string").alias("entity_id"), F.coalesce(F.col("entity_name"), F.col("entity_id").cast("string")).alias("entity_name")).distinct()
    s = mint("Speleothem_%s_e%s", F.col("slug"), F.col("entity_id"), base=base)
    return emitted(rows, graph, [
        link(s, "rdf:type", "own:Speleothem", base), literal(s, "rdfs:label", F.concat_ws(" – ", "site_name", "entity_name"), lang="en", base=base),
        literal(s, "own:entityId", F.col("entity_id"), "xsd:integer", base=base), link(s, "own:collectedFrom", mint("Cave_%s", F.col("slug"), base=base), base),
    ])


def cave_context_triples(df: DataFrame, graph: str | Column, base: str = BASE) -> DataFrame:
    """19 triples per cave (slug, site_id, site_name) with its smoothing methods, measurement types, properties and chronology,
    3 more where it has lon and lat."""
    rows = df.select("slug", "site_id", "site_name", *[F.col(c) if c in df.columns else F.lit(None).cast("double").alias(c) for c in ("lon", "lat")]).distinct()
    at = lambda x: F.lit(iri(f"own:{x}", base))
    cave, geom, chron = mint("Cave_%s", F.col("slug"), base=base), mint("Cave_%s_Geometry", F.col("slug"), base=base), mint("UThChronology_%s", F.col("slug"), base=base)
    wkt = wkt_point(F.col("lon"), F.col("lat"))
    known = lambda c: F.when(wkt.isNotNull(), c)
    median, sg = at(f"RollingMedian_w{WINDOW}"), at(f"SavitzkyGolay_w{WINDOW}_p{POLYORDER}")
    out = [
        link(cave, "rdf:type", "own:Cave", base), literal(cave, "rdfs:label", F.col("site_name"), lang="en", base=base), literal(cave, "own:siteId", F.col("site_id"), "xsd:integer", base=base),
        link(known(geom), "rdf:type", "sf:Point", base), literal(known(geom), "geo:asWKT", wkt, "geo:wktLiteral", base=base), link(cave, "geo:hasGeometry", known(geom), base),
        link(median, "rdf:type", "own:RollingMedianFilter", base), literal(median, "own:windowSize", str(WINDOW), "xsd:integer", base=base),
        link(sg, "rdf:type", "own:SavitzkyGolayFilter", base), literal(sg, "own:windowSize", str(WINDOW), "xsd:integer", base=base), literal(sg, "own:polyOrder", str(POLYORDER), "xsd:integer", base=base),
    ]
    for name in ("d18O", "d13C"):
        out += [link(at(f"MeasurementType_{name}"), "rdf:type", "own:MeasurementType", base), literal(at(f"MeasurementType_{name}"), "rdfs:label", f"{name} measurement", lang="en", base=base)]
        out += [link(at(f"Property_{name}"), "rdf:type", f"own:{name}Property", base), literal(at(f"Property_{name}"), "rdfs:label", f"{name} (speleothem)", lang="en", base=base)]
    out += [link(chron, "rdf:type", "own:UThChronology", base), literal(chron, "rdfs:label", F.concat(F.lit("U-Th chronology of "), F.col("site_name")), lang="en", base=base), literal(chron, "rdfs:comment", "Standardised chronology of the sample's ages", lang="en", base=base)]
    return emitted(rows, graph, out)


def collection_members(members: DataFrame, graph: str | Column, collection: str, label: str, member: str = "s", comment: str | None = None, base: str = BASE) -> DataFrame:
    """A feature collection: its type and label (and comment), and a link to each distinct member."""
    c = f"own:{collection}"
    head = [(c, "rdf:type", "geo:FeatureCollection", None, None), (c, "rdfs:label", label, None, "en")] + ([(c, "rdfs:comment", comment, None, "en")] if comment else [])
    spark = members.sparkSession
    edges = emitted(members.select(F.col(member).alias("m")).where("m IS NOT NULL").distinct(), graph, [link(F.lit(iri(c, base)), "rdfs:member", F.col("m"), base)])
    headers = constants(spark, "", head, base).withColumn("graph", text(graph))
    return headers.unionByName(edges)


def dataset_triples(cores: DataFrame, graph: str | Column, base: str = BASE) -> DataFrame:
    """14 triples per core's data set and its catalogue, from columns dataset, title, description, publisher, licence (an
    address), created, catalogue_label, catalogue_description. A null leaves its triple out."""
    d, cat, en = mint("%s", F.col("dataset"), base=base), mint("%s_Catalog", F.col("dataset"), base=base), {"lang": "en", "base": base}
    return emitted(cores, graph, [
        link(d, "rdf:type", "dcat:Dataset", base), literal(d, "dct:title", F.col("title"), **en), literal(d, "dct:description", F.col("description"), **en),
        link(d, "dct:license", F.col("licence"), base), literal(d, "dct:publisher", F.col("publisher"), base=base), literal(d, "dct:created", F.col("created"), "xsd:date", base=base),
        link(cat, "rdf:type", "dcat:Catalog", base), literal(cat, "rdfs:label", F.col("catalogue_label"), **en), literal(cat, "dct:title", F.col("catalogue_label"), **en),
        literal(cat, "dct:description", F.col("catalogue_description"), **en), literal(cat, "dct:publisher", F.col("publisher"), base=base), link(cat, "dct:license", F.col("licence"), base),
        literal(cat, "dct:created", F.col("created"), "xsd:date", base=base), link(cat, "dcat:dataset", d, base),
    ])


def source_triples(proxies: DataFrame, graph: str | Column, base: str = BASE) -> DataFrame:
    """12 triples per core and proxy: its source and its part of the data set, from columns dataset, proxy, title, creator, year,
    part_title, part_description, licence."""
    d, cat, part, src = (mint(t, F.col("dataset"), *([F.col("proxy")] if "%s_%s" in t else []), base=base) for t in ("%s", "%s_Catalog", "%s_%s", "Source_%s_%s"))
    en = {"lang": "en", "base": base}
    return emitted(proxies, graph, [
        link(src, "rdf:type", "dct:BibliographicResource", base), literal(src, "dct:title", F.col("title"), **en), literal(src, "dct:creator", F.col("creator"), base=base),
        literal(src, "dct:date", F.col("year"), "xsd:gYear", base=base), link(d, "dct:source", src, base), link(part, "rdf:type", "dcat:Dataset", base),
        literal(part, "dct:title", F.col("part_title"), **en), literal(part, "dct:description", F.col("part_description"), **en), link(part, "dct:source", src, base),
        link(part, "dct:license", F.col("licence"), base), link(part, "dcat:distribution", src, base), link(cat, "dcat:dataset", part, base),
    ])


def drilling_triples(cores: DataFrame, graph: str | Column, base: str = BASE) -> DataFrame:
    """25 triples per core: its site with geometry and collections, the core, and the campaign that removed it; from columns core, site,
    site_label, lon, lat, core_label, campaign_label, time_span. A place that is not known leaves its two triples out."""
    s, g, own = mint("%s", F.col("site"), base=base), mint("%s_Geometry", F.col("site"), base=base), mint("%s_Collection", F.col("site"), base=base)
    c, camp, en = mint("%s", F.col("core"), base=base), mint("%s_Campaign", F.col("core"), base=base), {"lang": "en", "base": base}
    everyone = F.lit(iri(f"own:{ALL_SITES}", base))
    return emitted(cores, graph, [
        *[link(s, "rdf:type", t, base) for t in ("geo:Feature", "own:DrillingSite", "crm:E53_Place", "crm:E27_Site")], literal(s, "rdfs:label", F.col("site_label"), **en),
        literal(s, "crm:P87_is_identified_by", F.when(F.col("lon").isNotNull() & F.col("lat").isNotNull(), F.format_string("%.4f, %.4f", "lat", "lon")), "xsd:string", base=base),
        link(g, "rdf:type", "sf:Point", base), literal(g, "geo:asWKT", wkt_point(F.col("lon"), F.col("lat")), "geo:wktLiteral", base=base), link(s, "geo:hasGeometry", g, base),
        link(own, "rdf:type", "geo:FeatureCollection", base), literal(own, "rdfs:label", F.concat(F.lit("Sites of "), F.col("site_label")), **en), link(own, "rdfs:member", s, base), link(everyone, "rdfs:member", s, base),
        link(c, "rdf:type", "sosa:Sample", base), link(c, "rdf:type", "crm:E22_Human-Made_Object", base), literal(c, "rdfs:label", F.col("core_label"), **en), link(c, "sosa:isSampleOf", s, base),
        link(c, "crm:P53_has_former_or_current_location", s, base), literal(c, "crm:P2_has_type", "Ice Core", **en),
        link(camp, "rdf:type", "crm:E7_Activity", base), link(camp, "rdf:type", "crmsci:S1_Matter_Removal", base), literal(camp, "rdfs:label", F.col("campaign_label"), **en),
        link(camp, "crm:P7_took_place_at", s, base), literal(camp, "crm:P4_has_time-span", F.col("time_span"), "xsd:string", base=base), link(camp, "crmsci:O1_removed", c, base),
    ])


def property_triples(proxies: DataFrame, graph: str | Column, base: str = BASE) -> DataFrame:
    """9 triples per proxy (proxy, label, unit, chronology_label, comment): property, chronology and measurement type."""
    prop, mtype, chron = (mint(f"{x}_%s", F.col("proxy"), base=base) for x in ("Property", "MeasurementType", "Chronology"))
    en = {"lang": "en", "base": base}
    return emitted(proxies, graph, [
        link(prop, "rdf:type", "sosa:ObservableProperty", base), link(prop, "rdf:type", "crmsci:S9_Property_Type", base), literal(prop, "rdfs:label", F.col("label"), **en),
        link(prop, "qudt:unit", F.concat(F.lit(iri("unit:", base)), F.col("unit")), base), link(chron, "rdf:type", "crmsci:S6_Data_Evaluation", base), literal(chron, "rdfs:label", F.col("chronology_label"), **en),
        link(mtype, "rdf:type", "own:MeasurementType", base), literal(mtype, "rdfs:label", F.concat(F.col("label"), F.lit(" measurement")), **en), literal(mtype, "rdfs:comment", F.col("comment"), **en),
    ])


def method_triples(spark: SparkSession, graph: str, base: str = BASE) -> DataFrame:
    """The 12 records that all cores share: both smoothing methods and the head of the collection of all sites."""
    everyone, en, none = f"own:{ALL_SITES}", "en", None
    rows = [(everyone, "rdf:type", "geo:FeatureCollection", none, none), (everyone, "rdfs:label", "All sites", none, en), (everyone, "rdfs:comment", "Sites of all data sets", none, en)]
    for m, label in ((f"own:RollingMedian_w{WINDOW}", "Rolling median"), (f"own:SavitzkyGolay_w{WINDOW}_p{POLYORDER}", "Savitzky-Golay")):
        rows += [(m, "rdf:type", "crmsci:S6_Data_Evaluation", none, none), (m, "rdfs:label", f"{label}, window {WINDOW}", none, en), (m, "own:windowSize", str(WINDOW), "xsd:integer", none), (m, "dct:references", f"own:{label.replace(' ', '_')}_reference", none, none)]
    rows.append((f"own:SavitzkyGolay_w{WINDOW}_p{POLYORDER}", "own:polyOrder", str(POLYORDER), "xsd:integer", none))
    return constants(spark, graph, rows, base)


def metadata_triples(cores: DataFrame, sources: DataFrame, proxies: DataFrame, graph: str, base: str = BASE) -> DataFrame:
    """The records behind the observations of any number of cores: cores has a row for each, sources one for each core and proxy,
    proxies one for each proxy. All texts are the tables' own; 93 triples for one core with two proxies and a known place."""
    parts = (dataset_triples(cores, graph, base), drilling_triples(cores, graph, base), source_triples(sources, graph, base), property_triples(proxies, graph, base))
    return reduce(DataFrame.unionByName, parts, method_triples(cores.sparkSession, graph, base))


def core_metadata(spark: SparkSession, graph: str, created: str, proxies: Sequence[str] = ("CH4", "d18O"), core: str = "IceCore", site: str = "Site", dataset: str = "Dataset", lon: float | None = 0.0, lat: float | None = 0.0, licence: str = "https://creativecommons.org/licenses/by/3.0/", texts: dict[str, str] | None = None, sources: dict[str, dict[str, str]] | None = None, base: str = BASE) -> DataFrame:
    """metadata_triples() of one core. `texts` gives columns of its row, `sources` for a proxy columns of its rows in sources and
    proxies; what is not given is named after the core, site, data set and proxy."""
    own = {"title": f"{dataset} records", "description": f"Proxy measurements of {core}", "publisher": f"Publisher of {dataset}", "catalogue_label": f"{dataset} catalogue", "catalogue_description": f"Catalogue of {dataset}", "site_label": site, "core_label": core, "campaign_label": f"Campaign of {core}", "time_span": "not stated"}
    row = own | {"dataset": dataset, "core": core, "site": site, "licence": licence, "created": created} | (texts or {})
    of = {p: {"title": f"{p} record", "creator": f"Authors of the {p} record", "year": created[:4], "part_title": f"{p} data set", "part_description": f"{p} measurements of {core}", "label": p, "unit": "PPB" if p == "CH4" else "PERMILLE", "chronology_label": f"Chronology of {p}", "comment": f"Marks observations of {p}"} | (sources or {}).get(p, {}) for p in proxies}
    table = lambda rows: spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{c} string" for c in rows[0]))
    cores = table([row]).withColumns({"lon": F.lit(lon).cast("double"), "lat": F.lit(lat).cast("double")})
    each = table([{"dataset": dataset, "licence": licence, "proxy": p} | x for p, x in of.items()])
    return metadata_triples(cores, each, each, graph, base)


def union_graphs(*graphs: DataFrame, shared: Sequence[DataFrame] = (), name: str | None = None) -> DataFrame:
    """One graph of several, as a set. Observation triples are unique as their ids are, so only `shared` ones, which more
    than one graph may state, pass a distinct; give all graphs as shared where that is not known."""
    parts = [g.select(*COLUMNS) for g in graphs]
    if shared:
        parts.append(reduce(DataFrame.unionByName, [g.select(*(F.lit(name).alias("graph") if name and c == "graph" else c for c in COLUMNS)) for g in shared]).distinct())
    whole = reduce(DataFrame.unionByName, parts)
    return whole.withColumn("graph", F.lit(name)) if name else whole


def graph_counts(triples: DataFrame, rows: int | None = None) -> DataFrame:
    """Distinct triples per graph, and its subjects and predicates. Give the number of `rows` where it is known, as of a stored table: the
    tasks that tell triples apart then grow in number, not in size."""
    if rows is not None:
        triples = triples.repartition(max(-(-rows // TASK_ROWS), min(8, triples.sparkSession.sparkContext.defaultParallelism)), *COLUMNS)
    return triples.distinct().groupBy("graph").agg(F.count("*").alias("n_triples"), F.countDistinct("s").alias("n_subjects"), F.countDistinct("p").alias("n_predicates"))
