"""A stored triple table that is laid out for questions about subjects.

Rows lie in folders by predicate, and within each in buckets by subject, sorted by it. A question reads the folders of its
predicates only, and whatever groups or joins by subject finds each bucket's rows together, so it needs no shuffle. Subjects with
very many triples, such as a data set that links all its observations, would make one bucket as large as they are; they
are counted and kept in a table of their own without buckets.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..dims import BASE, iri
from ..storage import TASK_ROWS, new_dir, stored
from . import graph_queries
from .series import is_small
from .triples import COLUMNS

#: Triples of a subject from which it is kept apart, and triples that a bucket should have, about: a task sorts those of a bucket, and
#: graph_counts() hashes them.
WIDE, BUCKET_ROWS = 100_000, 1_000_000


class Store(NamedTuple):
    """The tables of a stored graph, by name: subjects in buckets, and subjects with very many triples."""

    spark: SparkSession
    narrow: str
    wide: str

    def of(self, predicates: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
        """Both tables' triples, of some predicates (full identifiers) only; the folders of others are not read."""
        both = [self.spark.table(t) for t in (self.narrow, self.wide)]
        if predicates is not None:
            both = [t.where(F.col("p").isin(predicates)) for t in both]
        return tuple(t.select(*COLUMNS) for t in both)

    def triples(self) -> DataFrame:
        a, b = self.of()
        return a.unionByName(b)


def open_store(spark: SparkSession, path: str, buckets: int, name: str | None = None) -> Store:
    """The store that write_store() has written under path with so many buckets, in any session."""
    name = name or f"graph_{uuid.uuid4().hex}"
    columns = ", ".join(f"{c} STRING" for c in COLUMNS)
    for table, part, clustered in ((name, "narrow", f"CLUSTERED BY (s) SORTED BY (s) INTO {buckets} BUCKETS"), (f"{name}_wide", "wide", "")):
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY (p) {clustered} LOCATION '{path}/{part}'")
        spark.sql(f"MSCK REPAIR TABLE {table}")
    return Store(spark, name, f"{name}_wide")


def write_store(triples: DataFrame, path: str | None = None, name: str | None = None, buckets: int | None = None, wide: int = WIDE) -> Store:
    """Writes triples by subject, and opens them. `buckets` follow the number of rows if not given; subjects with more than
    `wide` triples go to the table without buckets, and their rows stay in the tasks that hold them.

    The triples are first written to the shared folder, as they are read more than once. A graph without triples gives
    empty tables. Rows repeat as often as they stand in the input.
    """
    spark = triples.sparkSession
    path = path or new_dir(spark, "store")
    rows = stored(triples.select(*COLUMNS), "triples", task_rows=TASK_ROWS)
    buckets = buckets or max(-(-rows.count() // BUCKET_ROWS), min(8, spark.sparkContext.defaultParallelism))
    large = stored(rows.groupBy("s").agg(F.count("*").alias("n")).where(F.col("n") > wide).select("s"), "large")
    sent = F.broadcast(large) if is_small(large) else large
    temporary = f"stratalake_{uuid.uuid4().hex}"
    narrow = rows.join(sent, "s", "left_anti").select(*COLUMNS).repartition(buckets, "s")
    narrow.write.format("parquet").partitionBy("p").bucketBy(buckets, "s").sortBy("s").option("path", f"{path}/narrow").saveAsTable(temporary)
    spark.sql(f"DROP TABLE {temporary}")  # its files stay, as they have a path of their own
    rows.join(sent, "s", "left_semi").select(*COLUMNS).write.partitionBy("p").parquet(f"{path}/wide")
    return open_store(spark, path, buckets, name)


def star(store: Store, predicates: dict[str, str], kind: str | None = None, base: str = BASE) -> DataFrame:
    """graph_queries.star() over a store: subjects in buckets are grouped where they lie, the few wide ones by a shuffle of
    what the tasks have combined."""
    asked = [iri(p, base) for p in predicates.values()] + ([iri("rdf:type", base)] if kind else [])
    narrow, wide = (graph_queries.star(t, predicates, kind, base) for t in store.of(asked))
    return narrow.unionByName(wide)


def observations_by_age(store: Store, kind: str, age: str = "sosa:resultTime", value: str = "sosa:hasSimpleResult", smoothed: str = "own:smoothedValue_rollingMedian", base: str = BASE) -> DataFrame:
    """graph_queries.observations_by_age() over a store."""
    found = star(store, {"age": age, "value": value, "smoothed": smoothed}, kind, base)
    return found.select(F.col("s").alias("obs"), *[F.col(c).cast("double").alias(c) for c in ("age", "value", "smoothed")]).orderBy("age")


def sites_with_geometry(store: Store, distinct: bool = False, base: str = BASE) -> DataFrame:
    """graph_queries.sites_with_geometry() over a store; only the folders of its four predicates are read."""
    narrow, wide = store.of([iri(p, base) for p in graph_queries.GEOMETRY])
    return graph_queries.geometry_joins(narrow.unionByName(wide), distinct, base)


def graph_counts(store: Store) -> DataFrame:
    """Distinct triples per graph, and its subjects and predicates. Triples and subjects in buckets are told apart where they
    lie; a row per graph and task is shuffled, and per graph and predicate."""
    narrow, wide = (rows.groupBy("s", *[c for c in COLUMNS if c != "s"]).agg(F.lit(1)).groupBy("s", "graph").agg(F.count("*").alias("n")) for rows in store.of())
    each = [t.groupBy("graph").agg(F.sum("n").alias("n_triples"), F.count("*").alias("n_subjects")) for t in (narrow, wide)]
    sums = each[0].unionByName(each[1]).groupBy("graph").agg(*[F.sum(c).alias(c) for c in ("n_triples", "n_subjects")])
    kinds = store.triples().select(F.col("graph").alias("_g"), "p").distinct().groupBy("_g").agg(F.count("p").alias("n_predicates"))
    return sums.join(kinds, sums["graph"].eqNullSafe(kinds["_g"])).drop("_g")
