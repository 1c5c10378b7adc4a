"""Quality rules with built-in functions only: counts of each text, and a hashed n-gram likelihood ratio.

The ratio compares two multinomials over hashed n-grams: one of a trusted target (documents labelled good), one of the
raw corpus. A document's verdict is its log-likelihood ratio, divided by its number of n-grams, held against a threshold.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, functions as F

from .common import settled, words

#: Fixed values of the base rules.
SYMBOLS, LEAST_WORDS, MOST_REPEATED = "#*$%&|<>", 50, 50
#: Buckets of hashed n-grams of up to BASE_BYTES of text, n-grams of a text (runs of letters or digits, and runs of other
#: marks, are its units).
BUCKETS, BASE_BYTES, LONGEST = 1 << 13, 32 << 20, 2
UNIT = r"[\p{L}\p{M}\p{N}]+|[^\p{L}\p{M}\p{N}\x20\x09-\x0D]+"
#: What is added to each bucket's share, the verdict's threshold, and most trusted ids that are sent to all tasks.
SMOOTHING, THRESHOLD, MOST_SENT = 0.5, -0.3, 500_000


def repeated_words(w: str, n: int = 3) -> Column:
    """Words of the array column w within windows of n words that the text has twice or more, each word once."""
    size = F.size(w)
    keys = F.transform(F.sequence(F.lit(0), size - n), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(n)]))
    return F.when(size >= n, keys).otherwise(F.array().cast("array<bigint>"))


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed (replacing columns of these
    names). A null text has no words; rows are counted one by one, and all other columns stay.

    Windows of three words are told apart by their 64-bit hash: they are sorted with their places, those equal to a
    neighbour are kept, and their places in order give the words that they cover.
    """
    plain = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(plain, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    full = docs.withColumn("_stratalake_w", words(F.col(text))).withColumn("_stratalake_l", lines)
    full = full.withColumn("_stratalake_k", repeated_words("_stratalake_w"))
    repeats = F.size("_stratalake_k") > F.size(F.array_distinct("_stratalake_k"))
    full = full.withColumn("_stratalake_s", F.when(repeats, F.sort_array(F.transform("_stratalake_k", lambda k, i: F.struct(k.alias("k"), i.alias("i"))))))
    same = lambda x, j, d: F.coalesce(F.get("_stratalake_s", j + d)["k"] == x["k"], F.lit(False))
    full = full.withColumn("_stratalake_p", F.sort_array(F.transform(F.filter("_stratalake_s", lambda x, j: ((j > 0) & same(x, F.greatest(j, F.lit(1)), -1)) | same(x, j, 1)), lambda x: x["i"])))
    covered = F.aggregate(F.transform("_stratalake_p", lambda x, j: F.least(F.lit(3), F.coalesce(F.get("_stratalake_p", j + 1) - x, F.lit(3)))), F.lit(0), lambda a, b: a + b)
    counts = {
        "n_words": F.size("_stratalake_w").cast("long"),
        "word_chars": F.char_length(F.translate(plain, " \t\n\x0b\x0c\r", "")).cast("long"),
        "n_symbols": (F.char_length(plain) - F.char_length(F.translate(plain, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size("_stratalake_l") - F.size(F.array_distinct("_stratalake_l"))).cast("long"),
        "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
    }
    counted = full.withColumn("_stratalake_c", settled(F.struct(*[c.alias(n) for n, c in counts.items()]))).withColumns({n: F.col(f"_stratalake_c.{n}") for n in counts})
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return counted.withColumn("base_failed", failed).drop("_stratalake_w", "_stratalake_l", "_stratalake_k", "_stratalake_s", "_stratalake_p", "_stratalake_c")


def buckets_for(size: int) -> int:
    """Buckets for a corpus of `size` bytes of text: BUCKETS for BASE_BYTES, twice as many for each eightfold of these.

    So they grow as the cube root of the text, and 100 TB have 2^21, which a task holds in some 50 MB.
    """
    many, reach = BUCKETS, BASE_BYTES
    while reach < size:
        many, reach = 2 * many, 8 * reach
    return many


def buckets(text: Column) -> Column:
    """The hashed n-grams of a text, of one to LONGEST units, as numbers of buckets; null has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({UNIT})"), 1)


def bucket(units: str, at: Column, n: int, of: int) -> Column:
    """The bucket, one of `of`, of the n units from place `at`; at the end of a text there are fewer."""
    return F.pmod(F.xxhash64(*[F.get(units, at + k) for k in range(n)], F.lit(n)), F.lit(of)).cast("int")


def grams(units: str, of: int) -> Column:
    places = F.sequence(F.lit(0), F.size(units) - 1)
    found = F.flatten(F.transform(places, lambda i: F.array(*[bucket(units, i, n, of) for n in range(1, LONGEST + 1)])))
    return F.when(F.size(units) > 0, found).otherwise(F.array().cast("array<int>"))


def trusted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs with a column _good: 1 where the id's largest label is 1, else null. Null ids and labels are left out.

    The distinct trusted ids are sent to all tasks if there are at most MOST_SENT of them, which is counted; if there are
    more, the join shuffles.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    good = known.groupBy("doc_id").agg(F.max(F.col("quality").cast("int")).alias("q")).where("q = 1").select(F.col("doc_id").alias("_id"), F.lit(1).alias("_good"))
    few = good.limit(MOST_SENT + 1).count() <= MOST_SENT
    return docs.join(F.broadcast(good) if few else good, F.col("doc_id") == F.col("_id"), "left").drop("_id")


def counts(texts: DataFrame, of: int) -> tuple[dict[int, int], dict[int, int]]:
    """How often each bucket occurs in texts (text, _good) that are good, and in all: one pass over them, at most `of`
    rows, combined in the tasks before they are shuffled."""
    rows = texts.select(buckets(F.col("text")).alias("u"), "_good").select("u", F.size("u").alias("n"), "_good").select(F.explode(grams("u", of)).alias("b"), "_good")
    found = rows.groupBy("b").agg(F.count("_good").alias("good"), F.count("*").alias("n")).collect()
    return {r.b: r.good for r in found}, {r.b: r.n for r in found}


def ratios(docs: DataFrame, labels: DataFrame) -> list[float]:
    """log(target share / raw share) of each bucket, of which there are more the more text docs have (buckets_for). The
    raw counts cover every document, the target every one that is labelled 1. With no such document, or no n-gram in
    them, all ratios are 0."""
    many = buckets_for(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    target, raw = counts(trusted(docs.select("doc_id", "text"), labels), many)
    if not any(target.values()):
        return [0.0] * many
    t, r = sum(target.values()) + SMOOTHING * many, sum(raw.values()) + SMOOTHING * many
    return [math.log((target.get(b, 0) + SMOOTHING) / t) - math.log((raw.get(b, 0) + SMOOTHING) / r) for b in range(many)]


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """docs with the columns of base_counts(), llr (per n-gram; 0 where there are none) and kept.

    kept is false where base_failed is true, else llr >= threshold. Every document is judged, by itself; repeated rows
    get equal results and other columns stay.
    """
    weights = ratios(docs.select("doc_id", F.col(text).alias("text")), labels)
    constant = F.from_json(F.lit(json.dumps({"v": [round(x, 9) for x in weights]})), "v array<double>")["v"]
    scored = base_counts(docs, text).withColumn("_stratalake_u", buckets(F.col(text)))
    size, add = F.size("_stratalake_u"), lambda i: sum((F.get(constant, bucket("_stratalake_u", i, n, len(weights))) for n in range(2, LONGEST + 1)), F.get(constant, bucket("_stratalake_u", i, 1, len(weights))))
    total = F.aggregate(F.sequence(F.lit(0), size - 1), F.lit(0.0), lambda acc, i: acc + add(i))
    scored = scored.withColumn("llr", settled(F.when(size > 0, total / (size * LONGEST)).otherwise(F.lit(0.0))))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold)).drop("_stratalake_u")
