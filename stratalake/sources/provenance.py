"""Where rows come from: a record per input file, and the link from each row's statement to it.

A record has the file's size and time as the file system gives them, and a digest of its lines. The digest does not depend on the
order of lines, so a large file is read in splits by many tasks and its parts are summed up; files with the same lines
are the same source, wherever they lie. Reading by another path, or again, gives the same digest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..dims import BASE
from ..functions import mint
from ..operators.series import is_small
from ..operators.triples import emitted, link, literal, text

#: Parts into which a file's rows are dealt where the records are too many to be sent to all tasks.
SALTS = 16


def file_records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, name, bytes, modified, lines, digest) of each text file of a path or glob.

    `file` is the full name as input_file_name() and the readers' `source` give it, `name` its last part. Lines are counted with the header and empty
    ones; compressed files are digested by their text and sized as they are. One aggregate over all lines, combined in the tasks. A file
    without a line gives no record, as no row can come from it.
    """
    meta = lambda c: F.col(f"_metadata.{c}")
    lines = spark.read.text(path if isinstance(path, str) else list(path)).select(
        F.input_file_name().alias("file"), meta("file_name").alias("name"), meta("file_size").alias("bytes"), meta("file_modification_time").alias("modified"), F.sha2("value", 256).alias("h"))
    share = lambda start: F.sum(F.conv(F.substring("h", start, 15), 16, 10).cast("decimal(19,0)"))
    found = lines.groupBy("file", "name", "bytes", "modified").agg(F.count("*").alias("lines"), share(1).alias("a"), share(16).alias("b"))
    return found.select("file", "name", "bytes", "modified", "lines", F.sha2(F.concat_ws(":", "lines", "a", "b"), 256).alias("digest"))


def source_file(digest: Column, base: str = BASE) -> Column:
    """The identifier of a file with these lines; null for null."""
    return F.when(digest.isNotNull(), mint("SourceFile_%s", F.substring(digest, 1, 32), base=base))


def file_triples(records: DataFrame, graph: str | Column, base: str = BASE) -> DataFrame:
    """6 triples per record. Records with the same lines give one source that states each of their names and times, and what
    they have in common twice; a null leaves its triple out."""
    s = source_file(F.col("digest"), base)
    return emitted(records, graph, [
        link(s, "rdf:type", "prov:Entity", base), literal(s, "rdfs:label", F.col("name"), base=base), literal(s, "own:contentDigest", F.col("digest"), base=base),
        literal(s, "own:byteSize", F.col("bytes"), "xsd:integer", base=base), literal(s, "own:lineCount", F.col("lines"), "xsd:integer", base=base),
        literal(s, "dct:modified", F.date_format(F.to_utc_timestamp("modified", F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'"), "xsd:dateTime", base=base),
    ])


def with_source_file(rows: DataFrame, records: DataFrame, source: str = "source", into: str = "source_file", base: str = BASE, most: int = 100_000) -> DataFrame:
    """rows with the identifier of the file that their column `source` names, null where there is no record of it.

    Up to `most` records, which is counted, are sent to all tasks, so rows stay where they are. More are joined by a shuffle in
    which the rows of a file, which may be a third of all, are dealt over SALTS parts.
    """
    known = records.select(F.col("file").alias("_file"), source_file(F.col("digest"), base).alias("_source_file"))
    if is_small(records, most):
        found = rows.join(F.broadcast(known), F.col(source) == F.col("_file"), "left")
    else:
        salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int"))
        many = known.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        found = salted.join(many, (F.col(source) == F.col("_file")) & (F.col("_salt") == F.col("_part")), "left")
    return found.select(*[F.col(c) for c in rows.columns if c != into], F.col("_source_file").alias(into))
