"""The registered queries: each operator over the driver's tables, with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import dims, sources
from ..functions import decimal_text, ensure_crs, mint, observation_label, shift_datum, thousands, to_ka, wkt_point
from ..operators import combined, graph_queries, intervals, ledger, series, sinks, sketches, smooth, store, triples
from ..operators.blocks import BLOCK_ROWS
from ..sources import provenance
from ..sources.graph_text import read_graph_text
from ..storage import TASK_ROWS, file_by_file, new_dir, stored
from .tables import EV, SITES, events, sites, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
ORDER = ("ts", "event_id")
BASE, W = dims.BASE, dims.WINDOW


def query(sql: str):
    def put(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return put


def stage_values(scheme: str) -> str:
    return ", ".join(f"({a}, {b}, '{n}', '{k}')" for a, b, n, k in dims.SCHEMES[scheme])


# --- coercion, units, rounding, identifiers ---------------------------------------------------------------------------


@query(f"WITH {EV} SELECT event_id, k FROM ev WHERE k IS NOT NULL")
def coerce_and_drop(spark, d):
    raw = table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))
    return series.coerce(raw, ["k"], ["k"])


SHIFTS = (("click", 1000.0, 50.0), ("view", 1000.0, -8.0))


@query(f"""WITH {EV}, shifts(event_type, scale, off) AS (VALUES {", ".join(f"('{t}', {a}, {b})" for t, a, b in SHIFTS)})
SELECT event_id, round(age / 1000.0, 9) AS age_ka, round(age / 1000.0 * coalesce(scale, 1) + coalesce(off, 0), 6) AS age_b2k FROM ev LEFT JOIN shifts USING (event_type)""")
def age_unit_and_datum(spark, d):
    shifts = spark.createDataFrame(list(SHIFTS), "event_type string, scale double, off double")
    rows = events(spark, d).join(F.broadcast(shifts), "event_type", "left")
    ka = to_ka(F.col("age"))
    shifted = shift_datum(ka, F.coalesce("scale", F.lit(1.0)), F.coalesce("off", F.lit(0.0)))
    return rows.select("event_id", F.round(ka, 9).alias("age_ka"), F.round(shifted, 6).alias("age_b2k"))


LONG = f"WITH {EV}, long AS (SELECT event_id, user_id, 'value' AS proxy, value FROM ev WHERE value IS NOT NULL UNION ALL SELECT event_id, user_id, 'k', k FROM ev WHERE k IS NOT NULL)"


@query(f"{LONG} SELECT * FROM long")
def unpivot_proxies(spark, d):
    return series.unpivot_proxies(events(spark, d).select("event_id", "user_id", "value", "k"), ["event_id", "user_id"], ["value", "k"])


@query(f"{LONG} SELECT event_id, proxy, CASE proxy WHEN 'value' THEN round(value, 1) ELSE round(value / 7, 4) END AS value FROM long")
def round_by_proxy(spark, d):
    long = unpivot_proxies(spark, d).withColumn("value", F.when(F.col("proxy") == "k", F.col("value") / 7).otherwise(F.col("value")))
    return series.round_by_proxy(long, {"value": 1}).select("event_id", "proxy", "value")


@query(f"""WITH {EV}, n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS seq FROM ev)
SELECT event_id, '{BASE}Obs_x_' || user_id || '_' || printf('%04d', seq) AS iri,
  printf('x observation %04d (%s ka BP)', seq, CAST(CAST(round(age, 1) AS DECIMAL(28, 1)) AS VARCHAR)) AS label FROM n""")
def mint_ids_labels(spark, d):
    rows = series.with_sequence(events(spark, d), ["user_id"], ORDER, block_rows=BLOCK_ROWS)
    return rows.select("event_id", mint("Obs_x_%d_%04d", F.col("user_id"), F.col("seq")).alias("iri"), observation_label("x", F.col("seq"), F.col("age")).alias("label"))


@query(f"WITH {SITES} SELECT site_id, printf('{dims.CRS} POINT(%.6f %.6f)', lon, lat) AS wkt FROM sites")
def wkt_points(spark, d):
    return sites(spark, d).select("site_id", wkt_point(F.col("lon"), F.col("lat")).alias("wkt"))


CRS_SQL = f"CASE WHEN starts_with(trim(wkt), '<') THEN trim(wkt) ELSE '{dims.CRS} ' || trim(wkt) END"


@query(f"WITH {SITES} SELECT site_id, {CRS_SQL} AS wkt FROM sites")
def ensure_crs_prefix(spark, d):
    return sites(spark, d).select("site_id", ensure_crs(ensure_crs(F.col("wkt"))).alias("wkt"))


# --- filters, summaries -----------------------------------------------------------------------------------------------

LOW, HIGH = 100.0, 400.0


@query(f"""WITH {EV} SELECT user_id, count(*) AS n, min(age) AS min_age, max(age) AS max_age, min(value) AS min_value, max(value) AS max_value,
  count(*) FILTER (WHERE age BETWEEN {LOW} AND {HIGH}) AS n_slice, min(age) FILTER (WHERE age BETWEEN {LOW} AND {HIGH}) AS min_age_slice, max(age) FILTER (WHERE age BETWEEN {LOW} AND {HIGH}) AS max_age_slice,
  min(value) FILTER (WHERE age BETWEEN {LOW} AND {HIGH}) AS min_value_slice, max(value) FILTER (WHERE age BETWEEN {LOW} AND {HIGH}) AS max_value_slice FROM ev GROUP BY user_id""")
def age_slice_summary(spark, d):
    return series.summarise(events(spark, d), ["user_id"], ["age", "value"], "age", LOW, HIGH)


@query(f"WITH {EV} SELECT event_id, age FROM ev WHERE age BETWEEN {LOW} AND {HIGH}")
def age_slice_rows(spark, d):
    return series.age_slice(events(spark, d).select("event_id", "age"), LOW, HIGH)


@query("SELECT c_custkey AS site_id FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def missing_series(spark, d):
    """Sites without a sample of one kind."""
    return series.missing_series(table(spark, d, "customer").select(F.col("c_custkey").alias("site_id")), table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("site_id")), ["site_id"])


@query(f"WITH {EV} SELECT user_id, count(*) AS n, min(age) AS min_age, max(age) AS max_age, min(value) AS min_value, max(value) AS max_value, min(k) AS min_k, max(k) AS max_k, count(k) > 0 AS has_k FROM ev GROUP BY user_id")
def series_summary(spark, d):
    return series.summarise(events(spark, d), ["user_id"], ["age", "value", "k"], present=["k"])


@query("SELECT user_id, count(DISTINCT event_type) AS n_entities FROM events GROUP BY user_id")
def entities_per_site(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.countDistinct("event_type").alias("n_entities"))


@query(f"WITH {SITES} SELECT count(*) AS n_sites, CAST(sum(n_d18o) AS BIGINT) AS n_d18o, CAST(sum(n_d13c) AS BIGINT) AS n_d13c, format('{{:,}}', CAST(sum(n_d18o) AS BIGINT)) AS d18o_text FROM sites")
def sample_totals(spark, d):
    total = sites(spark, d).agg(F.count("*").alias("n_sites"), F.sum("n_d18o").alias("n_d18o"), F.sum("n_d13c").alias("n_d13c"))
    return total.withColumn("d18o_text", thousands(F.col("n_d18o")))


@query(f"WITH {EV} SELECT user_id, arg_min(event_type, (ts, event_id)) AS event_type, arg_min(value, (ts, event_id)) AS value FROM ev GROUP BY user_id")
def first_by_order(spark, d):
    return series.first_by(events(spark, d), ["user_id"], ORDER, ["event_type", "value"])


@query(f"WITH {EV} SELECT user_id, event_type, count(*) AS n, min(age) AS min_age, max(age) AS max_age FROM ev WHERE event_type IS NOT NULL GROUP BY ALL")
def entity_groups(spark, d):
    return series.summarise(events(spark, d).where("event_type IS NOT NULL"), ["user_id", "event_type"], ["age"])


@query(f"""WITH {EV}, e AS (SELECT event_type, min(value) AS lo, max(value) AS hi FROM ev GROUP BY 1)
SELECT event_type, round(CASE WHEN event_type = 'click' THEN 0 - 5 ELSE lo - (hi - lo) * 0.05 END, 6) AS low, round(CASE WHEN event_type = 'click' THEN 100 + 5 ELSE hi + (hi - lo) * 0.05 END, 6) AS high FROM e""")
def display_extents(spark, d):
    found = series.display_extents(events(spark, d), ["event_type"], "value", 0.05, {"click": [0.0, 50.0, 100.0]})
    return found.select("event_type", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))


CONFIG = (("click", "C", "PPB"), ("view", "V", "PERMILLE"))


@query(f"WITH c(event_type, slug, unit) AS (VALUES {', '.join(map(str, CONFIG))}) SELECT event_id, slug, unit FROM events JOIN c USING (event_type)")
def site_config_join(spark, d):
    config = spark.createDataFrame(list(CONFIG), "event_type string, slug string, unit string")
    return series.attach_config(table(spark, d, "events"), config, ["event_type"]).select("event_id", "slug", "unit")


# --- intervals --------------------------------------------------------------------------------------------------------

KIND_SQL = "CASE kind " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in dims.STAGE_KINDS.items()) + " ELSE 'cold' END"


@query(f"""WITH {EV}, e AS (SELECT user_id, min(age) AS lo, max(age) AS hi FROM ev GROUP BY 1), s(top, bottom, stage, kind) AS (VALUES {stage_values("ice")})
SELECT user_id, stage, kind, {KIND_SQL} AS drawn_as, round(greatest(top, lo), 6) AS visible_top, round(least(bottom, hi), 6) AS visible_bottom, round((greatest(top, lo) + least(bottom, hi)) / 2, 6) AS label_at
FROM e JOIN s ON greatest(top, lo) < least(bottom, hi)""")
def stage_bands(spark, d):
    extents = events(spark, d).groupBy("user_id").agg(F.min("age").alias("lo"), F.max("age").alias("hi"))
    found = intervals.clip_stages(extents, dims.stages(spark, "ice"), ["user_id"])
    return found.withColumns({c: F.round(c, 6) for c in ("visible_top", "visible_bottom", "label_at")})


@query(f"WITH {EV}, s(top, bottom, stage, kind) AS (VALUES {stage_values('cave')}) SELECT event_id, stage FROM ev LEFT JOIN s ON age >= top AND age < bottom")
def stage_of_observation(spark, d):
    return intervals.tag_stage(events(spark, d), dims.stages(spark, "cave")).select("event_id", "stage")


# --- windows ----------------------------------------------------------------------------------------------------------


def median_sql(keys: str) -> str:
    return f"WITH {EV} SELECT event_id, round(median(value) OVER (PARTITION BY {keys} ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING), 6) AS median FROM ev"


WEIGHTS_SQL = "[" + ", ".join("[" + ", ".join(map(repr, row)) + "]" for row in dims.savgol_weights()) + "]"


def fit_sql(keys: str, more: str = "") -> str:
    on = " AND ".join(f"a.{k.strip()} = b.{k.strip()}" for k in keys.split(","))
    return f"""WITH {EV}, n AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY ts, event_id) AS rn, count(*) OVER (PARTITION BY {keys}) AS n FROM ev),
  s AS (SELECT *, least(greatest(rn - 5, 1), n - 10) AS start FROM n),
  f AS (SELECT a.event_id, sum(b.value * {WEIGHTS_SQL}[a.rn - a.start + 1][b.rn - a.start + 1]) AS savgol
    FROM s a JOIN n b ON {on} AND b.rn BETWEEN a.start AND a.start + 10 WHERE a.n >= 11 GROUP BY a.event_id)
SELECT s.event_id, {more} round(savgol, 6) AS savgol FROM s LEFT JOIN f USING (event_id)"""


@query(median_sql("user_id"))
def rolling_median_series(spark, d):
    return smooth.rolling_median(events(spark, d), ["user_id"], ORDER, "value", block_rows=BLOCK_ROWS).select("event_id", F.round("median", 6).alias("median"))


@query(median_sql("user_id, event_type"))
def rolling_median_entity(spark, d):
    return smooth.rolling_median(events(spark, d), ["user_id", "event_type"], ORDER, "value", block_rows=BLOCK_ROWS).select("event_id", F.round("median", 6).alias("median"))


@query(fit_sql("user_id"))
def savgol_series(spark, d):
    return smooth.savgol(events(spark, d), ["user_id"], ORDER, "value", block_rows=BLOCK_ROWS).select("event_id", F.round("savgol", 6).alias("savgol"))


@query(fit_sql("user_id, event_type"))
def savgol_entity(spark, d):
    return smooth.savgol(events(spark, d), ["user_id", "event_type"], ORDER, "value", block_rows=BLOCK_ROWS).select("event_id", F.round("savgol", 6).alias("savgol"))


HALO_BLOCK = 2000


@query(median_sql("1"))
def rolling_median_halo(spark, d):
    rows = events(spark, d).withColumn("all", F.lit(1))
    return smooth.rolling_median(rows, ["all"], ORDER, "value", block_rows=HALO_BLOCK).select("event_id", F.round("median", 6).alias("median"))


@query(fit_sql("user_id").replace("PARTITION BY user_id", "PARTITION BY 1").replace("a.user_id = b.user_id AND ", ""))
def savgol_halo(spark, d):
    rows = events(spark, d).withColumn("all", F.lit(1))
    return smooth.savgol(rows, ["all"], ORDER, "value", block_rows=HALO_BLOCK).select("event_id", F.round("savgol", 6).alias("savgol"))


@query(median_sql("event_type").replace("5 PRECEDING AND 5 FOLLOWING", "500 PRECEDING AND 500 FOLLOWING"))
def rolling_median_wide(spark, d):
    """A window of 1,001 rows, which moves along in blocks."""
    return smooth.rolling_median(events(spark, d), ["event_type"], ORDER, "value", window=1001, block_rows=HALO_BLOCK).select("event_id", F.round("median", 6).alias("median"))


NULL_KEY = "CASE WHEN event_type <> 'click' THEN event_type END"


@query(median_sql(NULL_KEY))
def rolling_median_null_keys(spark, d):
    """Blocks of a series whose key is null, and of others."""
    rows = events(spark, d).withColumn("key", F.when(F.col("event_type") != "click", F.col("event_type")))
    return smooth.rolling_median(rows, ["key"], ORDER, "value", block_rows=HALO_BLOCK).select("event_id", F.round("median", 6).alias("median"))


@query(f"""WITH {EV}, l AS (SELECT user_id, lag(value) OVER w AS x1, lag(age) OVER w AS y1, value AS x2, age AS y2 FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, x1, round(y1, 6) AS y1, x2, round(y2, 6) AS y2 FROM l WHERE y2 - y1 > 20""")
def gap_segments(spark, d):
    found = series.find_gaps(events(spark, d), ["user_id"], ORDER, 20.0, block_rows=BLOCK_ROWS)
    return found.withColumns({"y1": F.round("y1", 6), "y2": F.round("y2", 6)})


@query(f"""WITH m AS ({median_sql("user_id")}), f AS ({fit_sql("user_id")})
SELECT event_id, 'unsmoothed' AS variant, round(value, 6) AS x FROM events WHERE value IS NOT NULL
UNION ALL SELECT event_id, 'smooth11', median FROM m WHERE median IS NOT NULL UNION ALL SELECT event_id, 'savgol11p2', savgol FROM f WHERE savgol IS NOT NULL""")
def smoothing_variants(spark, d):
    return smooth.smoothing_variants(events(spark, d), ["user_id"], ORDER, "value", ["event_id"], block_rows=BLOCK_ROWS).withColumn("x", F.round("x", 6))


@query(f"WITH {SITES} SELECT site_id, site_name, n_d18o FROM sites WHERE n_d18o IS NOT NULL ORDER BY n_d18o DESC, site_id")
def site_ranking(spark, d):
    return sites(spark, d).dropna(subset=["n_d18o"]).select("site_id", "site_name", "n_d18o").orderBy(F.desc("n_d18o"), "site_id")


# --- the triple table -------------------------------------------------------------------------------------------------


def rows_sql(source: str, graph: str, specs: list[tuple]) -> str:
    """One select per predicate, from (s, p, o, kind, datatype, lang) with s and o as SQL."""
    q = lambda x: f"'{x}'" if x else "CAST(NULL AS VARCHAR)"
    parts = [f"SELECT '{graph}' AS graph, {s} AS s, '{dims.iri(p)}' AS p, CAST({o} AS VARCHAR) AS o, '{k}' AS o_kind, {q(dims.iri(t) if t else None)} AS o_datatype, {q(lang)} AS o_lang FROM {source} WHERE ({o}) IS NOT NULL" for s, p, o, k, t, lang in specs]
    return " UNION ALL ".join(parts)


def iri_sql(name: str) -> str:
    return f"'{dims.iri(name)}'"


def number_sql(column: str, digits: int) -> str:
    if column.startswith("age"):
        return f"CAST(CAST(round({column}, {digits}) AS DECIMAL(28, {digits})) AS VARCHAR)"
    return f"CAST(CAST(CAST({column} AS DECIMAL(28, 6)) AS DECIMAL(28, {digits})) AS VARCHAR)"  # rounds in decimals, half up


def site_specs() -> list[tuple]:
    s, g = f"'{BASE}Cave_site_' || printf('%04d', site_id)", f"'{BASE}Cave_site_' || printf('%04d', site_id) || '_Geometry'"
    return [
        (s, "rdf:type", iri_sql("own:Cave"), "iri", None, None), (s, "rdfs:label", "site_name", "literal", None, "en"), (s, "own:siteId", "site_id", "literal", "xsd:integer", None),
        (s, "own:countD18OSamples", "n_d18o", "literal", "xsd:integer", None), (s, "own:countD13CSamples", "n_d13c", "literal", "xsd:integer", None), (s, "prov:wasDerivedFrom", iri_sql("own:DataSource"), "iri", None, None),
        (g, "rdf:type", iri_sql("sf:Point"), "iri", None, None), (g, "geo:asWKT", CRS_SQL, "literal", "geo:wktLiteral", None), (s, "geo:hasGeometry", g, "iri", None, None),
    ]


SITE_ROWS = f"WITH {SITES}, t AS ({rows_sql('sites', 'sites', site_specs())})"


@query(f"{SITE_ROWS} SELECT * FROM t")
def site_triples(spark, d):
    return triples.site_triples(sites(spark, d), "sites")


def geo_specs() -> list[tuple]:
    s, g = f"'{BASE}' || 'S' || site_id || '_Site'", f"'{BASE}' || 'S' || site_id || '_Geometry'"
    return [*[(s, "rdf:type", iri_sql(t), "iri", None, None) for t in ("geo:Feature", "crm:E53_Place", "crm:E27_Site", "own:DrillingSite")], (s, "rdfs:label", "site_name", "literal", None, "en"), (s, "geo:hasGeometry", g, "iri", None, None), (g, "rdf:type", iri_sql("sf:Point"), "iri", None, None), (g, "geo:asWKT", f"printf('{dims.CRS} POINT(%.6f %.6f)', lon, lat)", "literal", "geo:wktLiteral", None)]


@query(f"WITH {SITES} {rows_sql('sites', 'geo', geo_specs())}")
def geo_site_triples(spark, d):
    rows = sites(spark, d).select(F.format_string("S%d", "site_id").alias("name"), F.col("site_name").alias("label"), "lon", "lat")
    return triples.geo_site_triples(rows, "geo", ["own:DrillingSite"])


SMOOTHED = f"""{EV}, n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_type, ts, event_id) - 1 AS seq FROM ev),
  m AS ({{median}}), f AS ({{fit}}), obs AS (SELECT n.*, m.median, f.savgol FROM n JOIN m USING (event_id) JOIN f USING (event_id))"""


def smoothed_sql(keys: str) -> str:
    return "WITH " + SMOOTHED.replace("{median}", median_sql(keys)).replace("{fit}", fit_sql(keys))


def observations(spark, d, keys):
    rows = smooth.smooth(events(spark, d), keys, ORDER, "value", block_rows=BLOCK_ROWS).withColumns({"median": F.round("median", 6), "savgol": F.round("savgol", 6)})
    return series.with_sequence(rows, ["user_id"], ["event_type", *ORDER], block_rows=BLOCK_ROWS)


def core_specs() -> list[tuple]:
    s, dec = f"'{BASE}Obs_CH4_' || printf('%04d', event_id)", "xsd:decimal"
    link = lambda p, o: (s, p, iri_sql(o), "iri", None, None)
    num = lambda p, c, n: (s, p, number_sql(c, n), "literal", dec, None)
    return [
        (s, "rdfs:label", f"printf('CH4 observation %04d (%s ka BP)', event_id, {number_sql('age', 1)})", "literal", None, "en"), link("own:measurementType", "own:MeasurementType_CH4"),
        link("rdf:type", "sosa:Observation"), link("rdf:type", "crmsci:S4_Observation"), link("sosa:hasFeatureOfInterest", "own:IceCore"), link("sosa:observedProperty", "own:Property_CH4"),
        num("sosa:hasSimpleResult", "value", 2), num("sosa:resultTime", "age", 4), num("own:atDepth_m", "age / 8", 2), link("own:ageChronology", "own:Chronology"), link("qudt:unit", "unit:PPB"),
        num("own:smoothedValue_rollingMedian", "median", 2), num("own:smoothedValue_savgol", "savgol", 2), link("own:smoothingMethod_median", f"own:RollingMedian_w{W}"), link("own:smoothingMethod_savgol", f"own:SavitzkyGolay_w{W}_p2"),
        link("prov:wasDerivedFrom", "own:Source"), link("crm:P7_took_place_at", "own:Site"), (iri_sql("own:Dataset"), "own:hasObservation", s, "iri", None, None), (iri_sql("own:Dataset_CH4"), "dcat:record", s, "iri", None, None),
    ]


CORE_ROWS = f"{smoothed_sql('user_id')}, t AS ({rows_sql('obs', 'core', core_specs())})"


def core_graph(spark, d):
    rows = observations(spark, d, ["user_id"]).select(F.col("event_id").alias("seq"), F.col("age").alias("age_ka"), (F.col("age") / 8).alias("depth_m"), "value", "median", "savgol")
    return triples.core_observation_triples(rows, "core", "CH4", 2)


@query(f"{CORE_ROWS} SELECT * FROM t")
def core_observation_triples(spark, d):
    return core_graph(spark, d)


def cave_specs() -> list[tuple]:
    s = f"'{BASE}Obs_Delta18O_' || user_id || '_e' || event_type || '_' || printf('%05d', seq)"
    link = lambda p, o: (s, p, iri_sql(o), "iri", None, None)
    num = lambda p, c, n: (s, p, number_sql(c, n), "literal", "xsd:decimal", None)
    when = lambda p, c, o: (s, p, f"CASE WHEN {c} IS NOT NULL THEN {iri_sql(o)} END", "iri", None, None)
    return [
        link("rdf:type", "own:Delta18OObservation"), (s, "sosa:hasFeatureOfInterest", f"'{BASE}Speleothem_' || user_id || '_e' || event_type", "iri", None, None), link("sosa:observedProperty", "own:Property_Delta18O"), link("own:measurementType", "own:MeasurementType_Delta18O"),
        num("own:ageKaBP", "age", 4), num("own:measuredValue", "value", 4), num("own:atDepth_mm", "k", 3), (s, "own:ageChronologySpeleothem", f"'{BASE}UThChronology_' || user_id", "iri", None, None),
        num("own:smoothedValue_rollingMedian", "median", 4), when("own:smoothingMethod_median", "median", f"own:RollingMedian_w{W}"), num("own:smoothedValue_savgol", "savgol", 4), when("own:smoothingMethod_savgol", "savgol", f"own:SavitzkyGolay_w{W}_p2"), link("prov:wasDerivedFrom", "own:DataSource"),
    ]


@query(f"{smoothed_sql('user_id, event_type')} {rows_sql('obs', 'caves', cave_specs())}")
def observation_triples(spark, d):
    rows = observations(spark, d, ["user_id", "event_type"]).select(F.col("user_id").cast("string").alias("slug"), F.col("event_type").alias("entity_id"), "seq", F.col("age").alias("age_ka"), "value", "median", "savgol", F.col("k").alias("depth_mm"))
    return triples.cave_observation_triples(rows, "caves", "Delta18O")


SAMPLE_S = f"'{BASE}Speleothem_' || user_id || '_e' || event_type"


@query(f"""WITH x AS (SELECT DISTINCT user_id, event_type FROM events WHERE event_type IS NOT NULL) {rows_sql('x', 'samples', [
    (SAMPLE_S, "rdf:type", iri_sql("own:Speleothem"), "iri", None, None), (SAMPLE_S, "rdfs:label", "user_id || ' – ' || event_type", "literal", None, "en"),
    (SAMPLE_S, "own:entityId", "event_type", "literal", "xsd:integer", None), (SAMPLE_S, "own:collectedFrom", f"'{BASE}Cave_' || user_id", "iri", None, None)])}""")
def sample_triples(spark, d):
    user = F.col("user_id").cast("string")
    return triples.sample_triples(table(spark, d, "events").select(user.alias("slug"), user.alias("site_name"), F.col("event_type").alias("entity_id"), F.col("event_type").alias("entity_name")), "samples")


def context_specs() -> list[tuple]:
    at = lambda x: f"'{BASE}{x}_' || slug"
    cave, geom, chron = at("Cave"), at("Cave") + " || '_Geometry'", at("UThChronology")
    link, text, whole = (lambda s, p, o: (s, p, o, "iri", None, None)), (lambda s, p, o: (s, p, o, "literal", None, "en")), (lambda s, p, o: (s, p, o, "literal", "xsd:integer", None))
    median, fit = iri_sql(f"own:RollingMedian_w{W}"), iri_sql(f"own:SavitzkyGolay_w{W}_p2")
    specs = [
        link(cave, "rdf:type", iri_sql("own:Cave")), text(cave, "rdfs:label", "site_name"), whole(cave, "own:siteId", "site_id"), link(geom, "rdf:type", iri_sql("sf:Point")),
        (geom, "geo:asWKT", f"printf('{dims.CRS} POINT(%.6f %.6f)', lon, lat)", "literal", "geo:wktLiteral", None), link(cave, "geo:hasGeometry", geom),
        link(median, "rdf:type", iri_sql("own:RollingMedianFilter")), whole(median, "own:windowSize", str(W)), link(fit, "rdf:type", iri_sql("own:SavitzkyGolayFilter")), whole(fit, "own:windowSize", str(W)), whole(fit, "own:polyOrder", "2"),
        link(chron, "rdf:type", iri_sql("own:UThChronology")), text(chron, "rdfs:label", "'U-Th chronology of ' || site_name"), text(chron, "rdfs:comment", "'Standardised chronology of the sample''s ages'"),
    ]
    for x in ("d18O", "d13C"):
        kind, prop = iri_sql(f"own:MeasurementType_{x}"), iri_sql(f"own:Property_{x}")
        specs += [link(kind, "rdf:type", iri_sql("own:MeasurementType")), text(kind, "rdfs:label", f"'{x} measurement'"), link(prop, "rdf:type", iri_sql(f"own:{x}Property")), text(prop, "rdfs:label", f"'{x} (speleothem)'")]
    return specs


@query(f"WITH {SITES}, x AS (SELECT *, 'site_' || printf('%04d', site_id) AS slug FROM sites) {rows_sql('x', 'caves', context_specs())}")
def cave_context_triples(spark, d):
    return triples.cave_context_triples(sites(spark, d).select(F.format_string("site_%04d", "site_id").alias("slug"), "site_id", "site_name", "lon", "lat"), "caves")


CORES = """cores AS (SELECT 'D' || s_suppkey AS dataset, 'Core' || s_suppkey AS core, 'Site' || s_suppkey AS site, s_name AS label, n_name AS publisher, s_suppkey % 360 - 180 AS lon, s_suppkey % 180 - 90 AS lat
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey),
proxies(proxy, unit) AS (VALUES ('CH4', 'PPB'), ('d18O', 'PERMILLE')), parts AS (SELECT * FROM cores, proxies)"""
LICENCE, CREATED = "https://creativecommons.org/licenses/by/4.0/", "1995-06-17"


def metadata_specs() -> dict[str, list[tuple]]:
    d, cat, s, c = (f"'{BASE}' || {x}" for x in ("dataset", "dataset || '_Catalog'", "site", "core"))
    g, own, camp, part, src = f"{s} || '_Geometry'", f"{s} || '_Collection'", f"{c} || '_Campaign'", f"{d} || '_' || proxy", f"'{BASE}Source_' || dataset || '_' || proxy"
    everyone, ty = iri_sql("own:AllSites_Collection"), "rdf:type"
    link, en = (lambda s, p, o: (s, p, o, "iri", None, None)), (lambda s, p, o: (s, p, o, "literal", None, "en"))
    kind = lambda s, *names: [link(s, ty, iri_sql(n)) for n in names]
    value = lambda s, p, o, t=None: (s, p, o, "literal", t, None)
    of = lambda x: f"'{BASE}{x}_' || proxy"
    median, fit = iri_sql(f"own:RollingMedian_w{W}"), iri_sql(f"own:SavitzkyGolay_w{W}_p2")
    shared = [*kind(everyone, "geo:FeatureCollection"), en(everyone, "rdfs:label", "'All sites'"), en(everyone, "rdfs:comment", "'Sites of all data sets'"), value(fit, "own:polyOrder", "2", "xsd:integer")]
    for m, name in ((median, "Rolling median"), (fit, "Savitzky-Golay")):
        shared += [*kind(m, "crmsci:S6_Data_Evaluation"), en(m, "rdfs:label", f"'{name}, window {W}'"), value(m, "own:windowSize", str(W), "xsd:integer"), link(m, "dct:references", iri_sql(f"own:{name.replace(' ', '_')}_reference"))]
    return {
        "cores": [
            *kind(d, "dcat:Dataset"), en(d, "dct:title", "label || ' records'"), en(d, "dct:description", "'Measurements of ' || core"), link(d, "dct:license", f"'{LICENCE}'"), value(d, "dct:publisher", "publisher"), value(d, "dct:created", f"'{CREATED}'", "xsd:date"),
            *kind(cat, "dcat:Catalog"), en(cat, "rdfs:label", "label || ' catalogue'"), en(cat, "dct:title", "label || ' catalogue'"), en(cat, "dct:description", "'Catalogue of ' || core"), value(cat, "dct:publisher", "publisher"), link(cat, "dct:license", f"'{LICENCE}'"), value(cat, "dct:created", f"'{CREATED}'", "xsd:date"), link(cat, "dcat:dataset", d),
            *kind(s, "geo:Feature", "own:DrillingSite", "crm:E53_Place", "crm:E27_Site"), en(s, "rdfs:label", "label"), value(s, "crm:P87_is_identified_by", "printf('%.4f, %.4f', lat::DOUBLE, lon::DOUBLE)", "xsd:string"),
            *kind(g, "sf:Point"), value(g, "geo:asWKT", f"printf('{dims.CRS} POINT(%.6f %.6f)', lon::DOUBLE, lat::DOUBLE)", "geo:wktLiteral"), link(s, "geo:hasGeometry", g),
            *kind(own, "geo:FeatureCollection"), en(own, "rdfs:label", "'Sites of ' || label"), link(own, "rdfs:member", s), link(everyone, "rdfs:member", s),
            *kind(c, "sosa:Sample", "crm:E22_Human-Made_Object"), en(c, "rdfs:label", "label || ' core'"), link(c, "sosa:isSampleOf", s), link(c, "crm:P53_has_former_or_current_location", s), en(c, "crm:P2_has_type", "'Ice Core'"),
            *kind(camp, "crm:E7_Activity", "crmsci:S1_Matter_Removal"), en(camp, "rdfs:label", "'Campaign of ' || core"), link(camp, "crm:P7_took_place_at", s), value(camp, "crm:P4_has_time-span", "'1990/1995'", "xsd:string"), link(camp, "crmsci:O1_removed", c),
        ],
        "parts": [
            *kind(src, "dct:BibliographicResource"), en(src, "dct:title", "proxy || ' of ' || core"), value(src, "dct:creator", "label"), value(src, "dct:date", "'1995'", "xsd:gYear"), link(d, "dct:source", src),
            *kind(part, "dcat:Dataset"), en(part, "dct:title", "proxy || ' data set'"), en(part, "dct:description", "proxy || ' measurements of ' || core"), link(part, "dct:source", src), link(part, "dct:license", f"'{LICENCE}'"), link(part, "dcat:distribution", src), link(cat, "dcat:dataset", part),
        ],
        "proxies": [
            *kind(of("Property"), "sosa:ObservableProperty", "crmsci:S9_Property_Type"), en(of("Property"), "rdfs:label", "proxy"), link(of("Property"), "qudt:unit", f"'{dims.iri('unit:')}' || unit"),
            *kind(of("Chronology"), "crmsci:S6_Data_Evaluation"), en(of("Chronology"), "rdfs:label", "'Chronology of ' || proxy"),
            *kind(of("MeasurementType"), "own:MeasurementType"), en(of("MeasurementType"), "rdfs:label", "proxy || ' measurement'"), en(of("MeasurementType"), "rdfs:comment", "'Marks observations of ' || proxy"),
        ],
        "(SELECT 1)": shared,
    }


@query(f"WITH {CORES} " + " UNION ALL ".join(rows_sql(table, "core", specs) for table, specs in metadata_specs().items()))
def metadata_triples(spark, d):
    """Suppliers as cores, each with its data set, catalogue, sources, site and campaign."""
    key, name = F.col("s_suppkey").cast("string"), F.col("s_name")
    core, text = F.concat(F.lit("Core"), key), lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    nation = table(spark, d, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("publisher"))
    rows = series.attach_config(table(spark, d, "supplier"), nation, ["s_nationkey"], how="left")
    cores = rows.select(
        text("D", key).alias("dataset"), core.alias("core"), text("Site", key).alias("site"), name.alias("site_label"), "publisher", F.lit(LICENCE).alias("licence"), F.lit(CREATED).alias("created"),
        text(name, " records").alias("title"), text("Measurements of ", core).alias("description"), text(name, " catalogue").alias("catalogue_label"), text("Catalogue of ", core).alias("catalogue_description"), text(name, " core").alias("core_label"),
        text("Campaign of ", core).alias("campaign_label"), F.lit("1990/1995").alias("time_span"), (F.col("s_suppkey") % 360 - 180).cast("double").alias("lon"), (F.col("s_suppkey") % 180 - 90).cast("double").alias("lat"),
    )
    proxies = spark.createDataFrame([("CH4", "PPB"), ("d18O", "PERMILLE")], "proxy string, unit string")
    p = F.col("proxy")
    each = cores.withColumn("proxy", F.explode(F.array(F.lit("CH4"), F.lit("d18O")))).select(
        "dataset", "proxy", "licence", text(p, " of ", F.col("core")).alias("title"), F.col("site_label").alias("creator"), F.lit("1995").alias("year"), text(p, " data set").alias("part_title"), text(p, " measurements of ", F.col("core")).alias("part_description"))
    known = proxies.select("proxy", p.alias("label"), "unit", text("Chronology of ", p).alias("chronology_label"), text("Marks observations of ", p).alias("comment"))
    return triples.metadata_triples(cores, each, known, "core")


def member_specs(key: str, name: str) -> list[tuple]:
    return [(iri_sql("own:AllSites_Collection"), "rdfs:member", f"'{BASE}{name}_' || {key}", "iri", None, None)]


HEAD = "SELECT 'all' AS graph, '{c}' AS s, '{t}' AS p, '{fc}' AS o, 'iri' AS o_kind, CAST(NULL AS VARCHAR) AS o_datatype, CAST(NULL AS VARCHAR) AS o_lang UNION SELECT 'all', '{c}', '{l}', 'All sites', 'literal', NULL, 'en'".format(c=dims.iri("own:AllSites_Collection"), t=dims.iri("rdf:type"), fc=dims.iri("geo:FeatureCollection"), l=dims.iri("rdfs:label"))


@query(f"{HEAD} UNION ({rows_sql('customer', 'all', member_specs('c_custkey', 'C'))}) UNION ({rows_sql('supplier', 'all', member_specs('s_suppkey', 'S'))})")
def collection_members(spark, d):
    a = table(spark, d, "customer").select(mint("C_%d", F.col("c_custkey")).alias("s"))
    b = table(spark, d, "supplier").select(mint("S_%d", F.col("s_suppkey")).alias("s"))
    parts = [triples.collection_members(x, "all", triples.ALL_SITES, "All sites") for x in (a, b)]
    return triples.union_graphs(shared=parts)


NATION_S = f"'{BASE}Nation_' || %s"


@query(f"""WITH a AS ({rows_sql('customer', 'x', [(NATION_S % 'c_nationkey', 'rdf:type', iri_sql('own:Nation'), 'iri', None, None)])}),
b AS ({rows_sql('nation', 'x', [(NATION_S % 'n_nationkey', 'rdf:type', iri_sql('own:Nation'), 'iri', None, None), (NATION_S % 'n_nationkey', 'rdfs:label', 'n_name', 'literal', None, 'en')])}),
u AS (SELECT * FROM a UNION SELECT * FROM b) SELECT 'combined' AS graph, count(*) AS n_triples, count(DISTINCT s) AS n_subjects, count(DISTINCT p) AS n_predicates FROM u""")
def graph_union_distinct(spark, d):
    s = lambda c: mint("Nation_%d", F.col(c))
    a = triples.emitted(table(spark, d, "customer"), "a", [triples.link(s("c_nationkey"), "rdf:type", "own:Nation")])
    b = triples.emitted(table(spark, d, "nation"), "b", [triples.link(s("n_nationkey"), "rdf:type", "own:Nation"), triples.literal(s("n_nationkey"), "rdfs:label", F.col("n_name"), lang="en")])
    return triples.graph_counts(triples.union_graphs(shared=[a, b], name="combined"))


NONE, TEXT = "CAST(NULL AS DOUBLE)", "CAST(NULL AS VARCHAR)"


@query(f"""{smoothed_sql('user_id, event_type')} SELECT 'events' AS dataset, user_id || '/' || event_type AS series_id, CAST(user_id AS VARCHAR) AS site, event_type AS entity, 'value' AS proxy, 'PPB' AS unit, 'hours' AS chronology,
  round(age, 6) AS age_ka, k AS depth, 'mm' AS depth_unit, value, median, savgol FROM obs
UNION ALL SELECT 'lineitem', CAST(l_orderkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), {TEXT}, l_returnflag, 'PERMILLE', {TEXT}, {NONE}, CAST(l_linenumber AS DOUBLE), 'm', CAST(l_quantity AS DOUBLE), {NONE}, {NONE} FROM lineitem""")
def harmonised_observations(spark, d):
    user = F.col("user_id").cast("string")
    a = observations(spark, d, ["user_id", "event_type"]).select(
        F.lit("events").alias("dataset"), F.concat(user, F.lit("/"), F.col("event_type")).alias("series_id"), user.alias("site"), F.col("event_type").alias("entity"), F.lit("value").alias("proxy"), F.lit("PPB").alias("unit"), F.lit("hours").alias("chronology"),
        F.round("age", 6).alias("age_ka"), F.col("k").alias("depth"), F.lit("mm").alias("depth_unit"), "value", "median", "savgol")
    b = table(spark, d, "lineitem").select(F.lit("lineitem").alias("dataset"), F.col("l_orderkey").alias("series_id"), F.col("l_suppkey").alias("site"), F.col("l_returnflag").alias("proxy"), F.lit("PERMILLE").alias("unit"), F.col("l_linenumber").alias("depth"), F.lit("m").alias("depth_unit"), F.col("l_quantity").alias("value"))
    return series.harmonise(a, b)


# --- questions to the triple table ------------------------------------------------------------------------------------


def sites_graph(spark, d):
    rows = sites(spark, d)
    members = rows.select(mint("Cave_site_%04d", F.col("site_id")).alias("s"))
    both = [triples.collection_members(members, "sites", c, c) for c in ("Caves_Collection", triples.ALL_SITES)]
    return triples.union_graphs(triples.site_triples(rows, "sites"), *both)


@query(f"WITH {SITES} SELECT '{BASE}Cave_site_' || printf('%04d', site_id) AS site, site_name AS label, {CRS_SQL} AS wkt FROM sites, (VALUES (1), (2)) v(x)")
def q_sites_geometry(spark, d):
    return graph_queries.sites_with_geometry(sites_graph(spark, d))


@query(f"WITH {SITES} SELECT DISTINCT '{BASE}Cave_site_' || printf('%04d', site_id) AS site, site_name AS label, {CRS_SQL} AS wkt FROM sites")
def q_sites_geometry_distinct(spark, d):
    return graph_queries.sites_with_geometry(sites_graph(spark, d), distinct=True)


@query(f"""{smoothed_sql('user_id')} SELECT '{BASE}Obs_CH4_' || printf('%04d', event_id) AS obs, CAST({number_sql('age', 4)} AS DOUBLE) AS age, CAST({number_sql('value', 2)} AS DOUBLE) AS value, CAST({number_sql('median', 2)} AS DOUBLE) AS smoothed
FROM obs WHERE age IS NOT NULL AND value IS NOT NULL AND median IS NOT NULL""")
def q_observation_star(spark, d):
    """Asked of the whole graph, written to a store by subject."""
    return store.observations_by_age(store.write_store(core_graph(spark, d)), "sosa:Observation")


@query(f"""{CORE_ROWS} SELECT k.s AS obs, CAST(a.o AS DOUBLE) AS age, CAST(v.o AS DOUBLE) AS value, CAST(m.o AS DOUBLE) AS smoothed
FROM t k JOIN t a ON a.s = k.s AND a.p = '{dims.iri('own:ageKaBP')}' JOIN t v ON v.s = k.s AND v.p = '{dims.iri('own:measuredValue')}'
JOIN t m ON m.s = k.s AND m.p = '{dims.iri('own:smoothedValue_rollingMedian')}' WHERE k.p = '{dims.iri('rdf:type')}' AND k.o = '{dims.iri('own:CH4Observation')}'""")
def q_observation_star_as_written(spark, d):
    """The question with predicates that ice-core observations don't have: no rows."""
    return graph_queries.observations_by_age(core_graph(spark, d), "own:CH4Observation", "own:ageKaBP", "own:measuredValue")


@query(f"WITH {SITES} SELECT '{BASE}Cave_site_' || printf('%04d', site_id) AS cave, site_name AS name, n_d18o AS d18o_count, n_d13c AS d13c_count FROM sites WHERE n_d18o IS NOT NULL AND n_d13c IS NOT NULL")
def q_site_counts(spark, d):
    return graph_queries.site_counts(sites_graph(spark, d))


@query(SQL["q_sites_geometry"])
def q_stored_sites_geometry(spark, d):
    """Collections are subjects with very many triples here, and are kept apart from the buckets."""
    return store.sites_with_geometry(store.write_store(sites_graph(spark, d), wide=100))


@query(SQL["q_sites_geometry_distinct"])
def q_stored_sites_geometry_distinct(spark, d):
    return store.sites_with_geometry(store.write_store(sites_graph(spark, d), wide=100), distinct=True)


@query(f"{CORE_ROWS} SELECT graph, count(*) AS n_triples, count(DISTINCT s) AS n_subjects, count(DISTINCT p) AS n_predicates FROM (SELECT DISTINCT * FROM t) GROUP BY graph")
def stored_graph_counts(spark, d):
    return store.graph_counts(store.write_store(core_graph(spark, d), wide=5000))


# --- runs that follow one another -------------------------------------------------------------------------------------

IN_PARTS = f"""WITH {SITES}, x AS (SELECT sites.*, c_nationkey FROM sites JOIN customer ON c_custkey = site_id), t AS ({rows_sql('x', 'all', site_specs())}
  UNION ALL {rows_sql('x', 'all', [(NATION_S % 'c_nationkey', 'rdf:type', iri_sql('own:Nation'), 'iri', None, None)])})"""


def graphs_in_parts(spark, d, first: bool):
    """Sites in 25 graphs, which also state the nations that several of them share. The first run lacks five graphs and some
    sites of the fifth, and has other names in the fourth."""
    nation = table(spark, d, "customer").select(F.col("c_custkey").alias("site_id"), "c_nationkey")
    rows, key = sites(spark, d).join(nation, "site_id"), F.col("site_id") % 25
    if first:
        rows = rows.where((key < 20) & ~((key == 4) & (F.col("site_id") % 2 == 0)))
        rows = rows.withColumn("site_name", F.when(key == 3, F.concat("site_name", F.lit(" (draft)"))).otherwise(F.col("site_name")))
    name = F.concat(F.lit("part "), key)
    nations = triples.emitted(rows, name, [triples.link(mint("Nation_%d", F.col("c_nationkey")), "rdf:type", "own:Nation")])
    return triples.site_triples(rows, name).unionByName(nations)


def two_runs(spark, d):
    path = new_dir(spark, "combined")
    combined.update(graphs_in_parts(spark, d, first=True), path)
    return combined.update(graphs_in_parts(spark, d, first=False), path)


@query(f"{IN_PARTS} SELECT DISTINCT * FROM t")
def incremental_union(spark, d):
    """The combined graph after a second run, which rewrites the graphs that are new or changed only."""
    return two_runs(spark, d)[0].triples("all")


@query("""SELECT DISTINCT 'part ' || c_custkey % 25 AS graph, CASE WHEN c_custkey % 25 >= 20 THEN 'new' WHEN c_custkey % 25 IN (3, 4) THEN 'changed' ELSE 'same' END AS status FROM customer""")
def incremental_union_changes(spark, d):
    return two_runs(spark, d)[1].select("graph", "status")


WITHIN = ", ".join(f"true AS {c}_within" for c in sketches.GRAPH)
COUNTS = "count(*) AS n_triples, count(DISTINCT s) AS n_subjects, count(DISTINCT p) AS n_predicates"


@query(f"{CORE_ROWS} SELECT graph, {COUNTS}, {WITHIN} FROM (SELECT DISTINCT * FROM t) GROUP BY graph")
def sketched_graph_counts(spark, d):
    """Two runs that share a third of the subjects, merged by their sketches, beside the exact counts of both together."""
    graph, third = stored(core_graph(spark, d), "core", task_rows=TASK_ROWS), F.pmod(F.xxhash64("s"), F.lit(3))
    runs = [sketches.graph_sketches(graph.where(third != i)) for i in (0, 1)]
    total = sketches.merged(runs[0].unionByName(runs[1]), ["graph"])
    return sketches.against_exact(sketches.estimated(total), triples.graph_counts(graph, graph.count()), ["graph"])


def kept_sketches(spark, d):
    """Sketches of the graphs of the first run, replaced and added to by those of the second."""
    path = new_dir(spark, "sketches")
    for first in (True, False):
        sketches.keep(sketches.graph_sketches(graphs_in_parts(spark, d, first)), path)
    return sketches.kept(spark, path)


@query(f"{IN_PARTS} SELECT graph, {COUNTS}, {WITHIN} FROM (SELECT DISTINCT * FROM t) GROUP BY graph")
def sketched_union_counts(spark, d):
    """All graphs as one: what several of them state counts once."""
    total = sketches.merged(kept_sketches(spark, d)).withColumn("graph", F.lit("all"))
    exact = triples.graph_counts(triples.union_graphs(shared=[graphs_in_parts(spark, d, first=False)], name="all"))
    return sketches.against_exact(sketches.estimated(total), exact, ["graph"])


@query("""WITH n AS (SELECT DISTINCT c_custkey % 25 AS part, c_nationkey FROM customer), p AS (SELECT DISTINCT part FROM n)
SELECT 'part ' || a.part AS "left", 'part ' || b.part AS "right", count(x.c_nationkey) AS n_shared FROM p a JOIN p b ON b.part = a.part + 1
  LEFT JOIN (SELECT l.part, l.c_nationkey FROM n l JOIN n r ON r.part = l.part + 1 AND l.c_nationkey = r.c_nationkey) x ON x.part = a.part GROUP BY 1, 2""")
def sketched_overlaps(spark, d):
    """Nations that neighbouring graphs both state; few enough for the sketches to be exact."""
    rows = table(spark, d, "customer").withColumn("graph", F.concat(F.lit("part "), F.col("c_custkey") % 25))
    found = stored(sketches.sketched(rows, ["graph"], {"n_shared": ["c_nationkey"]}), "sketches")
    number = F.substring("graph", 6, 9).cast("int")
    pairs = found.select(F.col("graph").alias("left"), F.concat(F.lit("part "), number + 1).alias("right"))
    return sketches.shared(found, pairs)


LATE = "event_id % 5 = 0 OR user_id % 10 = 7"


@query(f"""WITH b AS (SELECT *, CASE WHEN {LATE} THEN 1 ELSE 0 END AS batch FROM events)
SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id, batch ORDER BY ts, event_id) - 1
  + CASE batch WHEN 1 THEN coalesce((SELECT count(*) FROM b e WHERE e.batch = 0 AND e.user_id = b.user_id), 0) ELSE 0 END AS seq FROM b""")
def stable_sequence(spark, d):
    """Numbers per series over two runs. The second is given all rows; those of the first keep their numbers."""
    path, rows = new_dir(spark, "numbers"), table(spark, d, "events").select("event_id", "user_id", "ts")
    for batch, given in enumerate((rows.where(f"NOT coalesce({LATE}, false)"), rows)):
        ledger.append_numbered(given, path, batch, ["user_id"], ORDER, ["event_id"], block_rows=BLOCK_ROWS)
    return ledger.numbered(spark, path).select("event_id", "user_id", "seq")


# --- sinks ------------------------------------------------------------------------------------------------------------

TERM = "CASE WHEN o_kind = 'iri' THEN '<' || o || '>' WHEN o_lang IS NOT NULL THEN '\"' || o || '\"@' || o_lang WHEN o_datatype IS NOT NULL THEN '\"' || o || '\"^^<' || o_datatype || '>' ELSE '\"' || o || '\"' END"


@query(f"{SITE_ROWS} SELECT graph, '<' || s || '> <' || p || '> ' || {TERM} || ' .' AS line FROM t")
def ntriples_lines(spark, d):
    return sinks.ntriples_lines(site_triples(spark, d))


@query(f"{SITE_ROWS}, x AS (SELECT DISTINCT graph, s, '<' || p || '> ' || {TERM} AS part FROM t) SELECT graph, s, '<' || s || '>' || chr(10) || '    ' || string_agg(part, ' ;' || chr(10) || '    ' ORDER BY part) || ' .' AS block FROM x GROUP BY graph, s")
def subject_blocks(spark, d):
    return sinks.subject_blocks(site_triples(spark, d))


@query(f"""WITH {EV}, s AS (SELECT event_type, count(*) AS n, min(age) AS min_age, max(age) AS max_age FROM ev GROUP BY 1)
SELECT 'series/' || event_type AS part, 'n' AS measure, n::DOUBLE AS number FROM s UNION ALL SELECT 'series/' || event_type, 'min_age', min_age FROM s UNION ALL SELECT 'series/' || event_type, 'max_age', max_age FROM s
UNION ALL SELECT 'sites', 'n', count(*)::DOUBLE FROM customer""")
def run_report(spark, d):
    summary = series.summarise(events(spark, d), ["event_type"], ["age"])
    return sinks.run_report(("series", summary), ("sites", table(spark, d, "customer").agg(F.count("*").alias("n"))))


# --- files written and read back --------------------------------------------------------------------------------------


def tab_files(rows, name: str) -> str:
    """Lines of a tab table in the shared folder, its metadata and column line in a file of their own."""
    path = new_dir(rows.sparkSession, name)
    rows.sparkSession.createDataFrame([(TAB_HEAD,)], "value string").write.text(f"{path}/head")
    rows.write.text(f"{path}/rows")
    return path


TAB_HEAD = "/* DATA DESCRIPTION:\nCitation:\tNobody (1999)\n1.0\tnot data\n*/\nDepth [m]\tAge [ka BP]\tValue"
BAD = "CASE WHEN event_id % 7 = 0 THEN NULL ELSE round(age, 6) END"


def tab_rows(spark, d, *columns):
    rows = events(spark, d).select(
        F.col("event_id").cast("string").alias("depth"), F.lit("").alias("none"), F.when(F.col("event_id") % 7 == 0, F.lit("x")).otherwise(F.round("age", 6).cast("string")).alias("age"),
        F.when(F.col("event_id") % 11 == 0, F.lit("")).otherwise(F.col("value").cast("string")).alias("value"))
    return rows.select(F.concat_ws("\t", *[F.coalesce(c, F.lit("")) for c in columns]).alias("value"))


TAB_SQL = f"WITH {EV} SELECT '%s' AS series_id, CAST(event_id AS DOUBLE) AS depth_m, {BAD} AS age_ka, value FROM ev WHERE value IS NOT NULL AND event_id % 11 <> 0"


@query(TAB_SQL.replace("'%s'", "'ch4'"))
def read_tab_methane(spark, d):
    """Six columns, of which empty ones and one with bad text, below a block of metadata."""
    path = tab_files(tab_rows(spark, d, "depth", "none", "none", "age", "value", "none"), "methane")
    return sources.read_tab_series(spark, [f"{path}/head", f"{path}/rows"], sources.METHANE_TAB, "ch4")


@query(TAB_SQL.replace("'%s'", "'d18o'"))
def read_tab_isotope(spark, d):
    path = tab_files(tab_rows(spark, d, "depth", "age", "value"), "isotope")
    return sources.read_tab_series(spark, [f"{path}/head", f"{path}/rows"], sources.ISOTOPE_TAB, "d18o")


@query(f"""WITH {EV} SELECT user_id AS site_id, 'Site, ' || user_id AS site_name, CAST(user_id % 5 AS BIGINT) AS entity_id, event_id AS sample_id, event_type AS entity_name, round(age, 6) AS age_bp, round(age, 6) / 1000.0 AS age_ka,
  value AS d18o_permille, k AS d13c_permille, CASE WHEN event_id % 2 = 0 THEN 47.5 END AS latitude, CASE WHEN event_id % 2 = 0 THEN k END AS depth_sample FROM ev WHERE event_id % 13 <> 0""")
def read_cave_samples(spark, d):
    """Two kinds of files under one glob: half of the rows in files with more columns, in another order."""
    rows = events(spark, d).select(
        F.col("user_id").alias("site_id"), F.concat(F.lit("Site, "), F.col("user_id")).alias("site_name"), (F.col("user_id") % 5).alias("entity_id"), F.col("event_type").alias("entity_name"), F.col("event_id").alias("sample_id"),
        F.when(F.col("event_id") % 13 == 0, F.lit("none")).otherwise(F.round("age", 6).cast("string")).alias("age_bp"), F.col("value").alias("d18o_permille"), F.col("k").alias("d13c_permille"))
    path = new_dir(spark, "samples")
    rows.where("sample_id % 2 = 1").write.csv(f"{path}/a", header=True)
    more = rows.where("sample_id % 2 = 0").select("sample_id", *[c for c in rows.columns if c != "sample_id"], F.lit(47.5).alias("latitude"), F.lit(8.0).alias("longitude"), F.col("d13c_permille").alias("depth_sample"))
    more.write.csv(f"{path}/b", header=True)
    found = sources.read_samples(spark, f"{path}/*/*.csv")
    return found.select("site_id", "site_name", "entity_id", "sample_id", "entity_name", "age_bp", "age_ka", "d18o_permille", "d13c_permille", "latitude", "depth_sample")


@query(f"WITH {SITES} SELECT site_id, site_name, trim(wkt) AS wkt, n_d18o, n_d13c FROM sites WHERE site_id % 9 <> 0")
def read_site_table(spark, d):
    """Two kinds of files under one glob, with the same columns in another order."""
    path = new_dir(spark, "sites")
    rows = sites(spark, d).select("site_id", "site_name", F.when(F.col("site_id") % 9 != 0, F.trim("wkt")).alias("wkt"), F.col("n_d18o").alias("n_d18o_samples"), F.col("n_d13c").alias("n_d13c_samples"))
    rows.where("site_id % 2 = 0").write.csv(f"{path}/a", header=True, quoteAll=True)
    rows.where("site_id % 2 = 1").select("n_d13c_samples", "site_name", "n_d18o_samples", "wkt", "site_id").write.csv(f"{path}/b", header=True, quoteAll=True)
    return sources.read_sites(spark, f"{path}/*/*.csv")


def proxy_files(spark, d) -> list[dict]:
    """Files with untidy headers of two proxies, in two orders of columns, one that lacks its column, and one that is not there."""
    path, rows = new_dir(spark, "proxies"), events(spark, d)
    for name, column in (("ch4", "value"), ("dust", "k"), ("dd", "value")):
        head = {"event_id": "\ufeffDepth", "age": " AGE ", column: "Other" if name == "dd" else name.upper()}
        each = [F.round(c, 6).alias(h) if c == "age" else F.col(c).alias(h) for c, h in head.items()]
        rows.where("event_id % 2 = 0").select(*each).write.csv(f"{path}/{name}/a", header=True, sep=";")
        rows.where("event_id % 2 = 1").select(*each[::-1]).write.csv(f"{path}/{name}/b", header=True, sep=";")
    shift = lambda n: dict(zip(("scale", "offset"), dims.DATUM_SHIFTS[n]))
    return [{"series_id": n, "path": f"{path}/{n}/*"} | shift(n) for n in ("ch4", "dust", "dd", "d18o")]


@query(f"""WITH {EV} SELECT 'ch4' AS series_id, round(round(age, 6) * 1000.0 + 50.0, 4) AS age, value FROM ev WHERE value IS NOT NULL
UNION ALL SELECT 'dust', round(round(age, 6) * 1000.0 - 8.0, 4), k FROM ev WHERE k IS NOT NULL""")
def read_proxy_sources(spark, d):
    return sources.load_sources(spark, proxy_files(spark, d))[0].withColumn("age", F.round("age", 4))


@query(f"WITH {EV} SELECT 'ch4' AS series_id, true AS is_read, count(value) AS rows FROM ev UNION ALL SELECT 'dust', true, count(k) FROM ev UNION ALL SELECT 'dd', false, 0 UNION ALL SELECT 'd18o', false, 0")
def source_status(spark, d):
    status = sources.load_sources(spark, proxy_files(spark, d))[1]
    return status.select("series_id", (F.col("status") == "ok").alias("is_read"), "rows")


HEADER = "site_id,site_name,entity_id,sample_id,age_bp,d18o_permille,d13c_permille"
FILE_ROWS = f"""ls AS (SELECT user_id % 8 AS part, event_id, user_id || ',Site,' || (user_id % 5) || ',' || event_id || ',' || event_id || ',' || (event_id % 100) || ',' AS line FROM events),
  h AS (SELECT part, line, sha256(line) AS h FROM (SELECT part, line FROM ls UNION ALL SELECT DISTINCT part, '{HEADER}' FROM ls)),
  f AS (SELECT part, sum(strlen(line) + 1)::BIGINT AS bytes, count(*) AS lines,
    sha256(count(*) || ':' || sum(('0x' || substr(h, 1, 15))::BIGINT)::VARCHAR || ':' || sum(('0x' || substr(h, 16, 15))::BIGINT)::VARCHAR) AS digest FROM h GROUP BY part)"""


def sample_files(spark, d) -> str:
    """A file of samples for each of eight groups of users, in a folder of its own."""
    path, number = new_dir(spark, "samples"), F.col("event_id")
    rows = table(spark, d, "events").select(
        F.col("user_id").alias("site_id"), F.lit("Site").alias("site_name"), (F.col("user_id") % 5).alias("entity_id"), number.alias("sample_id"), number.alias("age_bp"), (number % 100).alias("d18o_permille"), F.lit(None).cast("string").alias("d13c_permille"),
        (F.col("user_id") % 8).alias("part"))
    rows.repartition(8, "part").write.partitionBy("part").csv(path, header=True)
    return f"{path}/*/*.csv"


@query(f"WITH {FILE_ROWS} SELECT * FROM f")
def source_files(spark, d):
    """A record of each file: its size, lines and digest."""
    found = provenance.file_records(spark, sample_files(spark, d))
    return found.select(F.regexp_extract("file", r"part=(\d+)", 1).cast("long").alias("part"), "bytes", "lines", "digest")


FILE_S = f"'{BASE}SourceFile_' || substr(digest, 1, 32)"


@query(f"""WITH {FILE_ROWS}, o AS (SELECT '{BASE}Obs_Delta18O_' || user_id || '_e' || (user_id % 5) || '_' || printf('%05d', event_id) AS s, digest
  FROM (SELECT user_id, event_id, user_id % 8 AS part FROM events) JOIN f USING (part)), t AS ({rows_sql('o', 'caves', [('s', 'prov:wasDerivedFrom', FILE_S, 'iri', None, None)])}
  UNION ALL {rows_sql('f', 'caves', [(FILE_S, 'rdf:type', iri_sql('prov:Entity'), 'iri', None, None), (FILE_S, 'own:contentDigest', 'digest', 'literal', None, None), (FILE_S, 'own:byteSize', 'bytes', 'literal', 'xsd:integer', None), (FILE_S, 'own:lineCount', 'lines', 'literal', 'xsd:integer', None)])})
SELECT * FROM t""")
def file_provenance_triples(spark, d):
    """Each observation's link to the file that it was read from, and what is said of the files, without their names and times."""
    path = sample_files(spark, d)
    records = stored(provenance.file_records(spark, path), "files")
    rows = provenance.with_source_file(sources.read_samples(spark, path), records)
    none = F.lit(None).cast("double")
    rows = rows.select(F.col("site_id").cast("string").alias("slug"), "entity_id", F.col("sample_id").alias("seq"), "age_ka", F.col("d18o_permille").alias("value"), none.alias("median"), none.alias("savgol"), none.alias("depth_mm"), "source_file")
    links = triples.cave_observation_triples(rows, "caves", "Delta18O", source=F.col("source_file")).where(F.col("p") == dims.iri("prov:wasDerivedFrom"))
    return links.unionByName(provenance.file_triples(records, "caves").where(~F.col("p").isin(dims.iri("rdfs:label"), dims.iri("dct:modified"))))


LINE = f"'<' || s || '> <' || p || '> ' || {TERM} || ' .'"


@query(f"""WITH {SITES}, t AS ({rows_sql('sites', 'sites', site_specs())} UNION ALL {rows_sql('sites', 'geo', geo_specs())})
SELECT 'by graph' AS output, graph, {LINE} AS line FROM t UNION ALL SELECT 'combined', NULL, {LINE} FROM t""")
def graph_text_files(spark, d):
    """A folder of lines for each graph and one for all, read back."""
    path, whole = new_dir(spark, "graphs"), triples.union_graphs(site_triples(spark, d), geo_site_triples(spark, d))
    sinks.write_ntriples(whole, f"{path}/each")
    sinks.write_ntriples(whole, f"{path}/all", by_graph=False)
    each = spark.read.text(f"{path}/each").select(F.lit("by graph").alias("output"), "graph", F.col("value").alias("line"))
    return each.unionByName(spark.read.text(f"{path}/all").select(F.lit("combined").alias("output"), F.lit(None).cast("string").alias("graph"), F.col("value").alias("line")))


@query(f"{CORE_ROWS} SELECT DISTINCT * FROM t")
def read_graph_blocks(spark, d):
    """The core's graph written as compressed blocks of Turtle, a folder per graph, and read back, a file by a task."""
    path = new_dir(spark, "blocks")
    sinks.write_subject_blocks(core_graph(spark, d), path, compression="gzip")
    return read_graph_text(file_by_file(spark), path)


@query(f"""WITH {SITES}, t AS ({rows_sql('sites', 'sites', site_specs())} UNION ALL {rows_sql('sites', 'geo', geo_specs())}) SELECT * REPLACE ('all' AS graph) FROM t""")
def read_graph_lines(spark, d):
    """Two graphs written as lines into one folder and read back under one name."""
    path = new_dir(spark, "lines")
    sinks.write_ntriples(triples.union_graphs(site_triples(spark, d), geo_site_triples(spark, d)), path, by_graph=False)
    return read_graph_text(spark, path, graph="all")


TABLES_SQL = f"""WITH {EV}, m AS ({median_sql("event_type")}), f AS ({fit_sql("event_type")}), e AS (SELECT event_type, min(age) AS lo, max(age) AS hi, min(value) AS vlo, max(value) AS vhi FROM ev GROUP BY 1),
  st(top, bottom, stage, kind) AS (VALUES {stage_values("ice")}), v AS (SELECT event_id, 'unsmoothed' AS variant, round(value, 6) AS x FROM ev UNION ALL SELECT event_id, 'smooth11', median FROM m UNION ALL SELECT event_id, 'savgol11p2', savgol FROM f)
SELECT 'variants' AS part, event_type AS series_id, variant AS name, round(age, 6) AS a, x AS b FROM v JOIN ev USING (event_id) WHERE x IS NOT NULL
UNION ALL SELECT 'extents', event_type, 'age', round(lo, 6), round(hi, 6) FROM e
UNION ALL SELECT 'extents', event_type, 'value', round(CASE WHEN event_type = 'click' THEN -5.0::DOUBLE ELSE vlo - (vhi - vlo) * 0.05 END, 6), round(CASE WHEN event_type = 'click' THEN 105.0::DOUBLE ELSE vhi + (vhi - vlo) * 0.05 END, 6) FROM e
UNION ALL SELECT 'bands', event_type, stage, round(greatest(top, lo), 6), round(least(bottom, hi), 6) FROM e JOIN st ON greatest(top, lo) < least(bottom, hi)"""


@query(TABLES_SQL)
def series_tables(spark, d):
    """The tables behind the drawings of a series per event type, written by series and read back."""
    path = new_dir(spark, "series")
    rows = events(spark, d).withColumnRenamed("event_type", "series_id")
    sinks.write_series_tables(rows, dims.stages(spark, "ice"), path, list(ORDER), ticks={"click": [0.0, 50.0, 100.0]}, block_rows=BLOCK_ROWS)
    read = lambda part, name, a, b: spark.read.parquet(f"{path}/{part}").select(F.lit(part).alias("part"), "series_id", F.col(name).alias("name"), F.round(a, 6).alias("a"), F.round(b, 6).alias("b"))
    return read("variants", "variant", "age", "x").unionByName(read("extents", "axis", "low", "high")).unionByName(read("bands", "stage", "visible_top", "visible_bottom"))
