"""Questions to a triple table, as DataFrame plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..dims import BASE, iri
from ..storage import TASK_ROWS, stored

#: Predicates that lead from a collection to its sites' labels and geometry texts.
GEOMETRY = ("rdfs:member", "rdfs:label", "geo:hasGeometry", "geo:asWKT")


def objects(triples: DataFrame, predicate: str, s: str, o: str, base: str = BASE) -> DataFrame:
    return triples.where(F.col("p") == iri(predicate, base)).select(F.col("s").alias(s), F.col("o").alias(o))


def sites_with_geometry(triples: DataFrame, distinct: bool = False, base: str = BASE) -> DataFrame:
    """Members of any collection with label and geometry text, along member, label, hasGeometry and asWKT.

    A site in several collections comes once for each, unless distinct. The triples of the four predicates are written to the
    shared folder first, as they are read more than once.
    """
    asked = triples.where(F.col("p").isin([iri(p, base) for p in GEOMETRY])).select("s", "p", "o")
    return geometry_joins(stored(asked, "geometry", task_rows=TASK_ROWS), distinct, base)


def geometry_joins(triples: DataFrame, distinct: bool = False, base: str = BASE) -> DataFrame:
    """sites_with_geometry() of triples in storage that have its four predicates only.

    They are counted, and joined by sorting in parts of TASK_ROWS triples or less on average; Spark, which makes a part for each core
    at least of what has that many bytes, chooses these where that is enough. No side is sent to all tasks: triples compress so
    well that one whose files look small may have millions of rows, and each task would hold them all.
    """
    parts = -(-triples.count() // TASK_ROWS)
    parted = lambda rows, key: rows.repartition(parts, key) if parts > triples.sparkSession.sparkContext.defaultParallelism else rows
    of = lambda p, s, o, key: parted(objects(triples, p, s, o, base), key).hint("merge")
    members = of("rdfs:member", "collection", "site", "site").select("site")
    if distinct:
        members = members.distinct()
    found = members.join(of("rdfs:label", "site", "label", "site"), "site").join(of("geo:hasGeometry", "site", "geom", "site"), "site")
    found = parted(found, "geom").join(of("geo:asWKT", "geom", "wkt", "geom"), "geom").select("site", "label", "wkt")
    return parted(found, "site").distinct() if distinct else found


def star(triples: DataFrame, predicates: dict[str, str], kind: str | None = None, base: str = BASE) -> DataFrame:
    """Subjects that have all the predicates (column: prefix:local), one row each; of one class if `kind` is given. One read
    and one shuffle, also for the class, which is one more column of the same aggregate. Each predicate must have one value
    per subject."""
    full = {iri(p, base): c for c, p in predicates.items()}
    p, o = F.col("p"), F.col("o")
    asked, member = p.isin(list(full)), F.lit(True)
    if kind:
        member = (p == iri("rdf:type", base)) & (o == iri(kind, base))
        asked |= member
    found = triples.where(asked).groupBy("s").agg(*[F.max(F.when(p == x, o)).alias(c) for x, c in full.items()], F.max(F.when(member, True)).alias("_member"))
    return found.dropna().drop("_member")


def observations_by_age(triples: DataFrame, kind: str, age: str = "sosa:resultTime", value: str = "sosa:hasSimpleResult", smoothed: str = "own:smoothedValue_rollingMedian", base: str = BASE) -> DataFrame:
    """Observations of a class with age, value and smoothed value as numbers, by age."""
    found = star(triples, {"age": age, "value": value, "smoothed": smoothed}, kind, base)
    return found.select(F.col("s").alias("obs"), *[F.col(c).cast("double").alias(c) for c in ("age", "value", "smoothed")]).orderBy("age")


def site_counts(triples: DataFrame, base: str = BASE) -> DataFrame:
    """Caves with both sample counts, most first."""
    found = star(triples, {"name": "rdfs:label", "d18o_count": "own:countD18OSamples", "d13c_count": "own:countD13CSamples"}, "own:Cave", base)
    return found.select(F.col("s").alias("cave"), "name", F.col("d18o_count").cast("bigint").alias("d18o_count"), F.col("d13c_count").cast("bigint").alias("d13c_count")).orderBy(F.desc("d18o_count"))


