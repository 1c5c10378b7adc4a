"""Records of input files, and rows linked to them."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from stratalake import dims
from stratalake.operators import triples
from stratalake.sources import provenance, read_samples

HEAD = "site_id,site_name,entity_id,sample_id,age_bp,d18o_permille,d13c_permille\n"


def written(tmp_path, **files):
    for name, lines in files.items():
        at = tmp_path / f"cave {name} [1] ä"
        at.mkdir()
        (at / "v.csv").write_text(HEAD + "".join(f"1,Site,1,{x},{x},0.5,\n" for x in lines))
    return f"{tmp_path}/*/*"


def test_equal_lines_are_one_source_in_any_order(spark, tmp_path):
    path = written(tmp_path, a=range(5), b=reversed(range(5)), c=range(6), d=[0, 1, 2, 3, 4, 4])
    records = provenance.file_records(spark, path).collect()
    assert len(records) == 4 and {r.name for r in records} == {"v.csv"}
    assert sorted(r.lines for r in records) == [6, 6, 7, 7] and len({r.digest for r in records}) == 3
    assert {r.bytes for r in records} == {os.path.getsize(f"{tmp_path}/cave {x} [1] ä/v.csv") for x in "abcd"}
    stated = provenance.file_triples(provenance.file_records(spark, path), "g")
    assert stated.count() == 24 and stated.select("s").distinct().count() == 3
    assert {r.o for r in stated.where("p LIKE '%modified'").collect()} == {r.modified.strftime("%Y-%m-%dT%H:%M:%SZ") for r in records}


@pytest.mark.parametrize("most", [10, 0])
def test_rows_are_linked_to_their_own_file(spark, tmp_path, most):
    path = written(tmp_path, a=range(40), b=range(40, 60), c=[])
    rows = read_samples(spark, path).withColumns({"digest": F.lit("mine"), "lines": F.lit(0), "_x": F.lit(None).cast("string")})
    rows = rows.unionByName(rows.limit(1).withColumn("source", F.lit("nowhere"))).unionByName(rows.limit(1).withColumn("source", F.lit(None).cast("string")))
    records = provenance.file_records(spark, path)
    got = provenance.with_source_file(rows, records, most=most)
    assert got.columns == [*rows.columns, "source_file"] and got.count() == 62
    assert got.where("source_file IS NULL").count() == 2
    each = {r.source_file: (r.lo, r.n) for r in got.where("source_file IS NOT NULL").groupBy("source_file").agg(F.min("sample_id").alias("lo"), F.count("*").alias("n")).collect()}
    assert sorted(each.values()) == [(0, 40), (40, 20)]
    obs = got.select(F.lit("x").alias("slug"), "entity_id", F.col("sample_id").alias("seq"), "age_ka", F.col("d18o_permille").alias("value"), *[F.lit(None).cast("double").alias(c) for c in ("median", "savgol", "depth_mm")], "source_file")
    links = triples.cave_observation_triples(obs, "g", "D", source=F.col("source_file")).where(F.col("p") == dims.iri("prov:wasDerivedFrom"))
    assert links.count() == 60
    lines = provenance.file_triples(records, "g").where("p LIKE '%lineCount'").select(F.col("s").alias("o"), F.col("o").alias("n"))
    assert {(r.n, r["count"]) for r in links.join(lines, "o").groupBy("n").count().collect()} == {("41", 40), ("21", 20)}


def test_empty_compressed_and_split_files(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    with gzip.open(tmp_path / "b.csv.gz", "wt") as f:
        f.write(HEAD + "\n" * 3)
    (tmp_path / "c.csv").write_text(HEAD + "\n" * 3)
    one = {r.name: r for r in provenance.file_records(spark, str(tmp_path)).collect()}
    assert set(one) == {"b.csv.gz", "c.csv"} and one["b.csv.gz"].digest == one["c.csv"].digest and one["c.csv"].lines == 4
    (tmp_path / "c.csv").write_text(HEAD + "".join(f"{i},x\n" for i in range(5000)))
    whole = provenance.file_records(spark, f"{tmp_path}/c.csv").first()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        parts = provenance.file_records(spark, f"{tmp_path}/c.csv")
        assert spark.read.text(f"{tmp_path}/c.csv").rdd.getNumPartitions() > 4 and parts.first() == whole and parts.count() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
