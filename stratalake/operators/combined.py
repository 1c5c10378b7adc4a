"""One combined graph of many, kept up to date: what a run changes is what it rewrites.

Two tables lie under a path, each with a folder per graph, named by a digest of the graph's name. `parts` has all triples of
a graph; `whole` has each triple of the combined graph once, in the folder of one of the graphs that state it. A graph is
told to have changed by its content digest, which lies in its own folder as a row without a subject, so that a folder and its
digest are replaced by one dynamic overwrite. An update reads the stored graphs but shuffles and rewrites the changed ones only.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..storage import stored
from .series import is_small
from .triples import COLUMNS, SCHEMA

TRIPLE = tuple(c for c in COLUMNS if c != "graph")
#: Triples up to which a side of a lookup is sent to all tasks, about 200 MB of long texts.
SENT = 200_000


class Combined(NamedTuple):
    """The combined graph under a path."""

    spark: SparkSession
    path: str

    def _read(self, table: str) -> DataFrame:
        """The rows of a table with their folder; none where it has not been written."""
        schema = f"{SCHEMA}, part string"
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{table}")
        if not p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{table}")

    def parts(self) -> DataFrame:
        """Every graph's triples under its own name."""
        return self._read("parts").where("s IS NOT NULL").select(*COLUMNS)

    def triples(self, name: str) -> DataFrame:
        """The combined graph: each triple that some graph states, once; no shuffle."""
        return self._read("whole").where("s IS NOT NULL").select(F.lit(name).alias("graph"), *TRIPLE)

    def digests(self) -> DataFrame:
        """(graph, part, n, digest) of each stored graph."""
        marks = self._read("parts").where("s IS NULL AND o_kind <> 'gone'")
        return marks.select("graph", "part", F.col("p").cast("bigint").alias("n"), F.col("o").alias("digest"))


def part_of(graph: Column) -> Column:
    """The folder of a graph: safe as a name whatever the graph is called; a null name is a graph of its own."""
    return F.coalesce(F.md5(graph.cast("binary")), F.lit("null"))


def content_digests(triples: DataFrame) -> DataFrame:
    """(graph, part, n, digest): rows per graph, and 128 bits of two hashes of its triples in any order. One aggregate, combined
    in the tasks. Repeated triples count, so a graph that repeats others than before is taken as changed, which is safe."""
    cells = [x for c in TRIPLE for x in (F.col(c).isNull(), F.col(c))]
    one, two = F.xxhash64(*cells), F.xxhash64(F.lit("second"), *cells[::-1])
    found = triples.groupBy("graph").agg(F.count("*").alias("n"), F.bit_xor(one).alias("_x"), F.sum(two.cast("decimal(38,0)")).alias("_s"))
    return found.select("graph", part_of(F.col("graph")).alias("part"), "n", F.concat_ws(":", "n", F.hex("_x"), "_s").alias("digest"))


def changes(triples: DataFrame, at: Combined, complete: bool = False) -> DataFrame:
    """(graph, part, n, digest, status): each given graph as new, changed or same; with `complete`, stored ones not given as gone."""
    old = at.digests().select("part", F.col("graph").alias("_graph"), F.col("digest").alias("_digest"))
    both = content_digests(triples).join(old, "part", "full" if complete else "left")
    status = F.when(F.col("digest").isNull(), "gone").when(F.col("_digest").isNull(), "new").when(F.col("digest") == F.col("_digest"), "same").otherwise("changed")
    return both.select(F.coalesce("graph", "_graph").alias("graph"), "part", F.coalesce("n", F.lit(0)).alias("n"), "digest", status.alias("status"))


def same_triple(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """left with (left_semi) or without (left_anti) the triples of right; both may have nulls in any column but the subject."""
    right = right.select(*[F.col(c).alias(f"_{c}") for c in TRIPLE])
    return left.join(right, reduce(Column.__and__, [left[c].eqNullSafe(right[f"_{c}"]) for c in TRIPLE]), how)


def found_in(few: DataFrame, many: DataFrame) -> DataFrame:
    """The rows of `many` whose triple is in `few`. If `few` is small, `many` is read in place and not shuffled."""
    few = few.select(*TRIPLE)
    return same_triple(many, F.broadcast(few) if is_small(few, SENT) else few, "left_semi")


def in_parts(rows: DataFrame, parts: DataFrame, how: str) -> DataFrame:
    """The rows of some folders (left_semi), or of all others (left_anti)."""
    return rows.join(F.broadcast(parts) if is_small(parts) else parts, "part", how)


def put(rows: DataFrame, path: str, mode: str) -> None:
    """Writes rows to their folders, few files in each; what other folders hold stays."""
    options = {"partitionOverwriteMode": "dynamic"} if mode == "overwrite" else {}
    rows.select(*COLUMNS, "part").hint("rebalance", "part").write.options(**options).partitionBy("part").mode(mode).parquet(path)


def update(triples: DataFrame, path: str, complete: bool = False) -> tuple[Combined, DataFrame]:
    """Brings the combined graph under `path` up to date with the given graphs, and returns it and changes(), as they were found.

    Graphs that are stored and not given stay, or, with `complete`, go. Folders of graphs that are the same are not rewritten;
    where a changed graph no longer states a triple that it kept for others, the triple is appended to the folder of one that
    still does. Triples without a subject are left out, and repeats within a graph are one. The input is read twice, so give a stored table if
    it is costly. A run that was cut off is repaired by running it again, as a graph's digest is written last; until then a
    triple may stand twice. One run at a time may write.
    """
    spark = triples.sparkSession
    at = Combined(spark, path.rstrip("/"))
    triples = triples.select(*COLUMNS).where("s IS NOT NULL")
    report = stored(changes(triples, at, complete), "changes")
    touched = report.where("status <> 'same'").select("part")
    if touched.isEmpty():
        return at, report
    marks = report.where("status <> 'same'").select(
        "graph", F.lit(None).cast("string").alias("s"), F.col("n").cast("string").alias("p"), F.col("digest").alias("o"), F.when(F.col("status") == "gone", "gone").otherwise("mark").alias("o_kind"), *[F.lit(None).cast("string").alias(c) for c in COLUMNS[5:]], "part")
    new = stored(in_parts(triples.withColumn("part", part_of(F.col("graph"))), touched, "left_semi").select(*COLUMNS, "part").distinct(), "new")
    whole, parts = (at._read(t).where("s IS NOT NULL") for t in ("whole", "parts"))
    others = in_parts(whole, touched, "left_anti")

    dropped = stored(same_triple(in_parts(whole, touched, "left_semi"), new, "left_anti").select(*TRIPLE).distinct(), "dropped")
    still = found_in(dropped, in_parts(parts, touched, "left_anti")).groupBy(*TRIPLE).agg(F.min_by(F.struct("graph", "part"), "part").alias("_at"))
    adopted = stored(same_triple(still, found_in(dropped, others), "left_anti").select("_at.graph", *TRIPLE, "_at.part"), "adopted")
    once = new.groupBy(*TRIPLE).agg(F.min_by(F.struct("graph", "part"), "part").alias("_at")).select("_at.graph", *TRIPLE, "_at.part")
    kept = stored(found_in(new, others).select(*TRIPLE), "kept")
    fresh = stored(same_triple(once, kept, "left_anti").select(*COLUMNS, "part"), "fresh")
    if not adopted.isEmpty():
        put(adopted, f"{at.path}/whole", "append")
    put(fresh.unionByName(marks), f"{at.path}/whole", "overwrite")
    put(new.unionByName(marks), f"{at.path}/parts", "overwrite")
    return at, report


def counts(at: Combined, name: str) -> DataFrame:
    """Triples of the combined graph, its subjects and predicates, as graph_counts() gives them; no triple is told apart again."""
    return at.triples(name).groupBy("graph").agg(F.count("*").alias("n_triples"), F.countDistinct("s").alias("n_subjects"), F.countDistinct("p").alias("n_predicates"))
