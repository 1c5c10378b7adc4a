"""Small helpers shared by the training-data operators: word columns, splits, the shared folder.

Operators that add working columns for a while name them _stratalake_…; those names are theirs alone.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from ..storage import new_dir, remove, shared_dir, stored  # noqa: F401  (the operators take them from here)

#: The white space that separates words, for Java's and for DuckDB's patterns.
SPACE = r"[\x20\x09-\x0D]+"
#: Most bytes of the texts of a sample that the driver takes, and keys that may count as hot, with the rows that one must have.
SAMPLE_BYTES, HOT_KEYS, HOT_ROWS = 64 << 20, 10_000, 1_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The runs of characters other than space and tab to carriage return; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE, -1), "")


def settled(value: Column) -> Column:
    """value, computed once per row: filters above it are not pushed below it with copies of its expression."""
    return F.when(F.monotonically_increasing_id() >= 0, value)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, UPPER, LOWER)


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; -1 where the id is null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(-1))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, most_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """At most `most` rows (doc_id, text, label) with `most_bytes` of text, one row for each of as many labelled ids, chosen
    by a hash of the id.

    The ids are chosen from the label rows alone, so that side has at most `most` rows and is broadcast; the
    documents are cut to the chosen ids and then, with map-side combining, to one row per id: the text with the least hash.
    An id with several label rows counts once, with its largest label; null ids and labels are left out.
    """
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .select("doc_id", F.col(label).cast("int").alias("label"))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return within_bytes(rows.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.max("label").alias("label")), most_bytes)


def within_bytes(rows: DataFrame, most_bytes: int) -> DataFrame:
    """Of a sample (doc_id, text, …) of few rows with an id each, in the order of the ids' hashes those whose texts still fit into
    most_bytes: a text that does not fit is passed over, and the rows after it are looked at all the same. The driver
    gets ids and lengths only."""
    spark, kept = rows.sparkSession, stored(rows, "sample")
    lengths = kept.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("n"), F.xxhash64("doc_id").alias("h")).collect()
    fit, left = [], most_bytes
    for r in sorted(lengths, key=lambda r: (r.h, r.doc_id)):
        if r.n <= left:
            left -= r.n
            fit.append((r.doc_id,))
    if len(fit) == len(lengths):
        return kept
    return kept.join(F.broadcast(spark.createDataFrame(fit, kept.select("doc_id").schema)), "doc_id", "left_semi")


def streamed(rows: DataFrame) -> Iterator[Row]:
    """The rows of a sample in the order of their ids, a partition at a time, so that the driver never holds all texts."""
    return rows.orderBy("doc_id").toLocalIterator()


def looked_up(rows: DataFrame, found: DataFrame, keys: list[str], total: int) -> DataFrame:
    """rows (about `total` of them) joined to found, which has one row per key and its number of rows in a column n, which
    goes. Null keys find nothing.

    Keys with more rows than HOT_ROWS and than a HOT_KEYS-th of all are HOT_KEYS at most, so these are sent to all
    tasks, and their rows stay where they are. The other keys join by a shuffle in which no key has more rows than that.
    """
    limit = max(total // HOT_KEYS, HOT_ROWS)
    if total <= limit:
        return rows.join(found.drop("n"), keys)
    hot, cold = (found.where(f"n {op} {limit}").drop("n") for op in (">", "<="))
    many = rows.join(F.broadcast(hot), keys)
    few = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys)
    return many.unionByName(few)
