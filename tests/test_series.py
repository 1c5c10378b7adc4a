import math

import pytest
from pyspark.sql import functions as F

from stratalake import dims, sources
from stratalake.functions import decimal_text, ensure_crs, escape_literal, mint, number, thousands, wkt_point
from stratalake.operators import intervals, series, sinks


def one(spark, column, **values):
    df = spark.range(1).withColumns({k: F.lit(v) for k, v in values.items()})
    return df.select(column.alias("x")).first().x


def test_coercion(spark):
    assert one(spark, number(F.col("a")), a="1e3") == 1000.0
    assert one(spark, number(F.col("a")), a="abc") is None and one(spark, number(F.col("a")), a="NaN") is None
    assert one(spark, decimal_text(F.col("a"), 3), a=1e-3) == "0.001"
    assert one(spark, thousands(F.col("a")), a=318870) == "318,870"


def test_geometry_text(spark):
    assert one(spark, wkt_point(F.lit(123.35), F.lit(-75.1))) == dims.CRS + " POINT(123.350000 -75.100000)"
    for text in ("POINT(1 2)", "  POINT(1 2) ", dims.CRS + " POINT(1 2)"):
        assert one(spark, ensure_crs(ensure_crs(F.col("a"))), a=text) == dims.CRS + " POINT(1 2)"
    assert one(spark, mint("Cave_%04d", F.col("a")), a=12345) == dims.BASE + "Cave_12345"
    assert one(spark, escape_literal(F.col("a")), a='q" b\\ n\n') == 'q\\" b\\\\ n\\n'


def test_tab_source(spark, tmp_path):
    p = tmp_path / "a.tab"
    p.write_text("/* DATA\n2 3\tx\n*/\nDepth\tRef\tAge1\tAge2\tV\tS\n1.5\t1.6\t0.1\t0.2\t700.5\t10\n2.5\t\t\t0.4\t650.0\t\n\t1\t1\t1\t1\t1\n3.5\t\t\tx\t600.0\t9\n")
    got = sources.read_tab_series(spark, str(p), sources.METHANE_TAB, "ch4").orderBy("depth_m").collect()
    assert [(r.depth_m, r.age_ka, r.value) for r in got] == [(1.5, 0.2, 700.5), (2.5, 0.4, 650.0), (3.5, None, 600.0)]


def test_sample_and_site_sources(spark, tmp_path):
    (tmp_path / "s.csv").write_text("﻿site_id,site_name,entity_id,entity_name,sample_id,age_bp,d18o_permille,d13c_permille\n1,Ä,2,E,3,1500,-5.5,\n1,Ä,2,E,4,,1,1\n1,Ä,2,E,5,2500,bad,-9\n")
    got = sources.read_samples(spark, str(tmp_path / "s.csv")).orderBy("sample_id").collect()
    assert [(r.sample_id, r.age_ka, r.d18o_permille, r.d13c_permille, r.latitude) for r in got] == [(3, 1.5, -5.5, None, None), (5, 2.5, None, -9.0, None)]
    (tmp_path / "v.csv").write_text('site_id,site_name,wkt,n_d18o_samples,n_d13c_samples\n141,"S","POINT(3 4)","9265","3962"\n2,"T","","1",""\n3,"U","POINT(1 1)","1",""\n')
    rows = sources.read_sites(spark, str(tmp_path / "v.csv")).orderBy("site_id").collect()
    assert [(r.site_id, r.n_d18o, r.n_d13c) for r in rows] == [(3, 1, None), (141, 9265, 3962)]


def test_delimited_sources_and_their_status(spark, tmp_path):
    (tmp_path / "c.csv").write_text("﻿Depth; AGE ;Ch4\n1;0.1;700\n2;x;1\n")
    (tmp_path / "d.csv").write_text("depth;age\n1;2\n")
    scale, offset = dims.DATUM_SHIFTS["ch4"]
    configs = [{"series_id": n, "path": str(tmp_path / f), "scale": scale, "offset": offset} for n, f in (("ch4", "c.csv"), ("dust", "d.csv"), ("dd", "none.csv"))]
    rows, status = sources.load_sources(spark, configs)
    assert [(r.series_id, r.age, r.value) for r in rows.collect()] == [("ch4", 150.0, 700.0)]
    found = {r.series_id: r.status for r in status.collect()}
    assert {r.series_id: r.rows for r in status.collect()} == {"ch4": 1, "dust": 0, "dd": 0}
    assert found["ch4"] == "ok" and "found" in found["dust"] and found["dd"].startswith("skipped")
    with pytest.raises(ValueError):
        sources.require(rows, ["nothing"])


def test_summaries_skip_nan(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("a", 2.0, math.nan), ("a", 3.0, None), ("b", 9.0, 1.0)], "k string, age double, v double")
    got = series.summarise(df, ["k"], ["v"], "age", 2.0, 9.0).orderBy("k").collect()
    assert [(r.n, r.max_v, r.n_slice, r.max_v_slice) for r in got] == [(3, 5.0, 2, None), (1, 1.0, 1, 1.0)]


def test_sequence_ties_gaps_and_missing(spark):
    df = spark.createDataFrame([("a", 1.0, 2, 1.0), ("a", 1.0, 1, 2.0), ("a", 99.0, 3, 3.0)], "k string, age double, id int, value double")
    assert [r.seq for r in series.with_sequence(df, ["k"], ["age", "id"]).orderBy("age", "id").collect()] == [0, 1, 2]
    assert [tuple(r)[1:] for r in series.find_gaps(df, ["k"], ["age", "id"], 50).collect()] == [(1.0, 1.0, 3.0, 99.0)]
    assert series.missing_series(spark.createDataFrame([("a",), ("z",)], "k string"), df, ["k"]).first().k == "z"
    assert series.first_by(df, ["k"], ["age", "id"], ["value"]).first().value == 2.0
    assert series.display_extents(df, ["k"], "value", ticks={"a": [5.0]}).first()[1:] == (4.5, 5.5)


def test_stages(spark):
    extents = spark.createDataFrame([("m", 0.0, 648.679), ("touch", 14.0, 29.0)], "k string, lo double, hi double")
    got = intervals.clip_stages(extents, dims.stages(spark, "ice"), ["k"])
    assert got.where("k = 'm'").count() == 15 and [r.stage for r in got.where("k = 'touch'").collect()] == ["MIS 2"]
    last = got.where("k = 'm' and stage = 'MIS 16'").first()
    assert (last.visible_top, last.visible_bottom) == (621.0, 648.679)
    ages = spark.createDataFrame([(0.0,), (14.0,), (533.0,), (None,)], "age double")
    assert sorted(str(r.stage) for r in intervals.tag_stage(ages, dims.stages(spark, "cave")).collect()) == ["MIS 1", "MIS 2", "None", "None"]


def test_large_stage_tables_join_by_bins(spark):
    extents = spark.createDataFrame([("m", 0.0, 648.679), ("touch", 14.0, 29.0), ("old", 5000.0, 6000.0)], "k string, lo double, hi double")
    ages = spark.createDataFrame([(x / 2,) for x in range(-20, 1400)] + [(None,)], "age double")
    stages = dims.stages(spark, "cave")
    for f in (lambda most: intervals.clip_stages(extents, stages, ["k"], most), lambda most: intervals.tag_stage(ages, stages, most=most)):
        assert sorted(map(str, f(100).collect())) == sorted(map(str, f(1).collect()))


def test_samples_with_different_headers(spark, tmp_path):
    (tmp_path / "v_a.csv").write_text("site_id,site_name,entity_id,entity_name,sample_id,age_bp,d18o_permille,d13c_permille\n1,A,2,E,3,1500,-5.5,\n")
    (tmp_path / "v_b.csv").write_text("\ufeffsample_id,Site_ID,site_name,entity_id,age_bp,d18o_permille,d13c_permille,latitude,longitude,depth_sample\n4,2,B,7,2500,,1.5,47.5,-8,12\n")
    got = {r.site_id: r for r in sources.read_samples(spark, f"{tmp_path}/v_*.csv").collect()}
    assert (got[1].sample_id, got[1].latitude, got[1].entity_name) == (3, None, "E") and (got[2].sample_id, got[2].latitude, got[2].depth_sample, got[2].entity_name) == (4, 47.5, 12.0, None)
    assert got[2].source.endswith("v_b.csv")
    (tmp_path / "v_c.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError):
        sources.read_samples(spark, f"{tmp_path}/v_*.csv")


def test_files_with_exchanged_columns(spark, tmp_path):
    (tmp_path / "v_a.csv").write_text('site_id,site_name,wkt,n_d18o_samples,n_d13c_samples\n1,"A, b ""c""","POINT(1 2)","5","7"\n')
    (tmp_path / "v_b.csv").write_text('n_d13c_samples,wkt,site_id,n_d18o_samples,site_name\n70,"POINT(3 4)",2,50,B\n')
    (tmp_path / "v_c.csv").write_text("")
    got = sources.read_sites(spark, f"{tmp_path}/v_*.csv").orderBy("site_id").collect()
    assert [(r.site_id, r.site_name, r.n_d18o, r.n_d13c) for r in got] == [(1, 'A, b "c"', 5, 7), (2, "B", 50, 70)]
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "a.csv").write_text("Depth;Age;Ch4\n1;2;3\n")
    (tmp_path / "p" / "b.csv").write_text("CH4 ;depth; AGE\n30;10;20\n")
    assert sorted((r.age, r.value) for r in sources.read_delimited_proxy(spark, str(tmp_path / "p"), "ch4").collect()) == [(2.0, 3.0), (20.0, 30.0)]
    (tmp_path / "p" / "c.csv").write_text("Age;Ch4\n1;2\n")
    with pytest.raises(ValueError, match="depth"):
        sources.read_delimited_proxy(spark, str(tmp_path / "p"), "ch4")
    assert sources.read_delimited_proxy(spark, str(tmp_path / "p"), "ch4", required=("age",)).count() == 3


def test_a_source_that_fails_while_it_is_read_skips_itself(spark, tmp_path):
    import gzip

    (tmp_path / "good.csv").write_text("depth;age;ch4\n1;2;3\n")
    whole = gzip.compress(("depth;age;dust\n" + "1;2;3\n" * 50_000).encode())
    (tmp_path / "bad.csv.gz").write_bytes(whole[: len(whole) // 2] + b"\0" * 50)
    rows, status = sources.load_sources(spark, [{"series_id": "ch4", "path": str(tmp_path / "good.csv")}, {"series_id": "dust", "path": str(tmp_path / "bad.csv.gz")}])
    found = {r.series_id: (r.status[:7], r.rows) for r in status.collect()}
    assert found == {"ch4": ("ok", 1), "dust": ("skipped", 0)} and rows.count() == 1


@pytest.mark.parametrize("n", [1, 3, 64, 65, 2000])
def test_interval_search_equals_comparing_all(spark, n):
    import random

    r = random.Random(n)
    cuts = sorted(r.sample(range(-50, 40 * n), 2 * n))
    table = [(cuts[2 * i] / 4, cuts[2 * i + 1] / 4 if r.random() < 0.7 or i == n - 1 else cuts[2 * i + 2] / 4, f"s{i}", "warm") for i in range(n)]
    stages = spark.createDataFrame(table + [(None, 1.0, "x", "warm"), (3.0, 3.0, "y", "cold")], "top double, bottom double, stage string, kind string")
    ages = sorted({v for row in table for v in row[:2]} | {r.uniform(-20, 11 * n) for _ in range(200)})
    df = spark.createDataFrame([(a,) for a in ages] + [(None,), (math.nan,)], "age double")
    got = intervals.tag_stage(df, stages)
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    want = {a: next((s for lo, hi, s, _ in table if lo <= a < hi), None) for a in ages}
    rows = got.collect()
    assert {x.age: x.stage for x in rows if x.age is not None and not math.isnan(x.age)} == want and len(rows) == len(ages) + 2
    assert all(x.stage is None for x in rows if x.age is None or math.isnan(x.age))
    extents = [(i, *sorted((r.uniform(-20, 11 * n), r.choice(ages)))) for i in range(40)] + [(99, None, 1.0)]
    met = intervals.clip_stages(spark.createDataFrame(extents, "k int, lo double, hi double"), stages, ["k"])
    assert "Join" not in met._jdf.queryExecution().optimizedPlan().toString()
    want = sorted((k, s, max(a, lo), min(b, hi)) for k, lo, hi in extents if lo is not None for a, b, s, _ in table if max(a, lo) < min(b, hi))
    assert sorted((x.k, x.stage, x.visible_top, x.visible_bottom) for x in met.collect()) == want


def test_overlapping_stages_are_joined(spark):
    stages = spark.createDataFrame([(0.0, 10.0, "a", "warm"), (5.0, 15.0, "b", "cold")], "top double, bottom double, stage string, kind string")
    got = intervals.tag_stage(spark.createDataFrame([(7.0,), (12.0,), (20.0,)], "age double"), stages).collect()
    assert sorted((r.age, str(r.stage)) for r in got) == [(7.0, "a"), (7.0, "b"), (12.0, "b"), (20.0, "None")]


def test_series_files_are_few(spark, tmp_path):
    df = spark.range(4000).select((F.col("id") % 40).cast("string").alias("series_id"), F.col("id").alias("v")).repartition(16)
    sinks.write_series(df, str(tmp_path / "s"), file_rows=70)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 4000 and 40 <= len(back.inputFiles()) <= 120
