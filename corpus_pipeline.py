"""A training-data pipeline over `documents`: five stages, each on what its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which the caller writes as Parquet and rereads as the next
stage's docs; run() does so in the shared folder. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratalake.llm import decontaminate, mixing, simhash, toxicity
from stratalake.llm.common import stored, table, words
from stratalake.llm.queries import encoded


#: Working columns, named as no column of documents is.
SCORED, FOUND, KEY, ROW, AT, CHUNK = (f"_stratalake_{x}" for x in ("scored", "found", "key", "row", "at", "chunk"))
#: Copies of one row that one task may be given, bytes of a pass and of all passes sent to all tasks, and the setting that names
#: the folder in which the token files stay.
COPIES, PASS_BYTES, SENT_BYTES, TOKENS_DIR = 1000, 64, 32 << 20, "spark.stratalake.tokens.dir"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the limit; a document with any text or none has a score, so null, empty and
    repeated rows are judged like any other. Other columns stay as they are."""
    scored = toxicity.score_toxicity(docs, table(spark, sf_dir, "labels"), out=SCORED)
    return scored.where(F.col(f"{SCORED}.score") < toxicity.REJECT).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: the one with the smallest id; of rows equal in id and text one."""
    return simhash.deduplicate(docs).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words are benchmark passages, or none; a null text has no words and
    stays."""
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), out=FOUND)
    return found.where(~decontaminate.contaminated(FOUND)).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A copy of a document for each of its passes of which the mix takes half or more, in the order of their training
    positions; one of no words comes once.

    Positions are worked out on rows without texts. A row is known by a digest of all its columns. Where passes come to
    SENT_BYTES or less, which is counted, they are sent to the texts, which are shuffled once, by position; else texts and
    passes meet in a shuffle of their own. Where rows are equal in all columns, which is looked up, these share one row of
    texts, which has the passes of all of them, so none is lost or added; COPIES of them at most are put together by one task.
    """
    keyed = docs.withColumn(KEY, F.unhex(F.md5(F.to_json(F.struct(*docs.columns), {"ignoreNullFields": "false"}))))
    mixed = mixing.mix(keyed.select("doc_id", "text", "source", KEY), keep=(KEY,))
    chunk = F.floor(F.col("copy") / COPIES)
    passes = mixed.select(KEY, "copy", "size", F.inline(mixing.passes_of())).where(2 * F.col("pass_words") >= F.col("size")).select(KEY, chunk.alias(CHUNK), F.col("position").alias(AT))
    if mixed.where("copy > 0").isEmpty():
        passes = passes.drop(CHUNK)
        sent = PASS_BYTES * passes.count() <= SENT_BYTES
        copies = keyed.select(KEY, F.struct(*docs.columns).alias(ROW)).join(F.broadcast(passes) if sent else passes, KEY)
    else:
        rows = keyed.groupBy(KEY).agg(F.first(F.struct(*docs.columns)).alias(ROW), F.count("*").alias(CHUNK))
        rows = rows.withColumn(CHUNK, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(CHUNK) - 1) / COPIES))))
        copies = rows.join(passes, [KEY, CHUNK])
    copies = copies.repartitionByRange(AT, KEY).sortWithinPartitions(AT, KEY).select(f"{ROW}.*")
    return copies.unionByName(docs.where(F.size(words(F.col("text"))) == 0))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids written as binary records and read back: doc_id, start, n_tokens, ids_crc32. The files stay in the folder
    that the setting spark.stratalake.tokens.dir names, under a name of their own; where it is unset they go with the driver."""
    folder = spark.conf.get(TOKENS_DIR, None)
    return encoded(docs, folder and f"{folder.rstrip('/')}/tokens-{uuid.uuid4().hex}")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("tokens", write_tokens),
]

#: No SQL: scores, fingerprints and token ids are not to be had in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents in sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
