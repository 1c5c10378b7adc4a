"""Mixing sources to target weights as a time-varying curriculum, with built-in functions only.

Training positions run over [0, 1) and are shares of all words. At position t, source s gives a share in proportion to
target * (1 + ramp * (2t - 1)) of the words, which grows over the run where its ramp is positive and falls where it is negative. The
ramps of the weights are moved by their mean over all targets, so that the shares add up to the same at every t.
Integrated, the words a source has given by t are target * (t + ramp * (t * t - t)). A document's place in its source's
stream of words, divided by the target, is inverted through that curve to a position, and documents are range-sorted by
position. How many words a source gives in all is its target's alone, so `taken` follows from the targets and the order
of a source's documents; the schedule decides when they come.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from .common import stored, words

#: Weights of the sources in turn, share of all words that the mix takes, most passes over a source.
WEIGHTS, SHARE, PASSES = (5, 2, 1), 1.5, 2
#: Ramp of the schedule for each weight, rows of a run of documents within which places are summed, and copies of one row that a
#: task places.
RAMPS, RUN_ROWS, COPIES = (0.5, 0.0, -0.5), 5000, 1000


def source_targets(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, passes: int = PASSES, ramps: tuple = RAMPS) -> DataFrame:
    """One row per source: source, weight, ramp (moved so that target * ramp adds up to 0), source_size, rows, target.

    The budget `share` * all words is dealt out by weight, no source getting more than `passes` times its size; what is
    cut off is dealt to the others again. With the sources ordered by cap / weight, those before the first one that the
    level does not fill are capped, so two running sums give all targets at once. The table of sources, one row each, is
    the only thing that is put in order here.
    """
    copies = F.col("copies") if "copies" in docs.columns else F.lit(1)
    sizes = docs.groupBy("source").agg(F.sum(F.col("size") * copies).alias("source_size"), F.count("*").alias("rows"))
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    pick = lambda values: F.get(F.array(*[F.lit(float(v)) for v in values]), F.pmod(rank, F.lit(len(values))))
    ranked = sizes.withColumns({"weight": pick(weights), "ramp": pick(ramps)}).withColumn("cap", F.lit(float(passes)) * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    upto, onward, whole = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing), order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    budget = F.lit(float(share)) * F.sum("source_size").over(whole)
    level = (budget - F.coalesce(F.sum("cap").over(upto), F.lit(0.0))) / F.sum("weight").over(onward)
    leveled = ranked.withColumn("level", level).withColumn("open", F.col("level") * F.col("weight") < F.col("cap"))
    first = F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(whole)
    targets = leveled.withColumn("final", first).withColumn("target", F.when(F.col("final").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("final") * F.col("weight"))))
    mean = F.coalesce(F.try_divide(F.sum(F.col("ramp") * F.col("target")).over(whole), F.sum("target").over(whole)), F.lit(0.0))
    moved = targets.withColumn("moved", F.col("ramp") - mean)
    steepest = F.greatest(F.lit(1.0), F.max(F.abs("moved")).over(whole))  # a share is never below 0
    return moved.withColumn("ramp", F.col("moved") / steepest).select("source", "weight", "ramp", "source_size", "rows", "target")


def position(done: Column, ramp: Column) -> Column:
    """The t in [0, 1] by which the share `done` of a source's words has been given: ramp * t * t + (1 - ramp) * t = done."""
    b = 1 - ramp
    return F.when(F.abs(ramp) < 1e-9, done).otherwise(F.coalesce(F.try_divide(2 * done, b + F.sqrt(F.greatest(b * b + 4 * ramp * done, F.lit(0.0)))), F.lit(0.0)))


def given(t: Column, ramp: Column) -> Column:
    """The share of a source's words that its schedule, integrated, has given by position t."""
    return t + ramp * (t * t - t)


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, passes: int = PASSES, ramps: tuple = RAMPS, text: str = "text", keep: tuple = ()) -> DataFrame:
    """Rows (doc_id, source, row_hash, size, source_size, target, ramp, place, copy, taken, first_position), one per row of
    docs, and docs' columns `keep`, in which rows may differ too. They are written to the shared folder.

    Within a source, documents stand in the order of a digest of id and text, then id and text hash; the mix takes the
    source's stream of words from its start, over and over, until the target is met, so a document gives whole passes and
    at most one document of a source gives a part of its last pass. place is where the document starts in the stream;
    copy numbers rows that are equal in all; taken sums up the words that the schedule gives between the positions at which
    each of the document's passes begins and ends (passes_of()), and first_position is where the first begins, null if it gives none.

    Nulls: a null text has size 0, a null source is a source that comes last, a null id is an id like any other. Documents
    of size 0 take nothing. Equal rows stand side by side and are counted, not sorted; where there are more than COPIES of
    one, its copies are dealt out to tasks by so many. Sums over a hot source are taken in runs of about RUN_ROWS documents by
    digest, so no task holds a source, nor all rows of one id. Reruns agree.
    """
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("/"), F.coalesce(F.col(text), F.lit(""))))
    sized = docs.select("doc_id", "source", F.size(words(F.col(text))).cast("long").alias("size"), F.xxhash64(text).alias("row_hash"), key.alias("key"), *keep)
    sized = stored(sized.groupBy(*sized.columns).agg(F.count("*").alias("copies")), "sized")
    targets = stored(source_targets(sized, weights, share, passes, ramps), "targets")
    runs = F.ceil(F.col("rows") / RUN_ROWS).cast("long")
    run = F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / 4294967296.0 * runs).cast("long")
    placed = sized.join(F.broadcast(targets) if few(targets) else targets, sized["source"].eqNullSafe(targets["source"])).drop(targets["source"]).withColumn("run", run)
    words_of = F.col("size") * F.col("copies")
    before = Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("source", "run").agg(F.sum(words_of).alias("run_size"))
    starts = starts.select(F.col("source").alias("_s"), F.col("run").alias("_r"), F.coalesce(F.sum("run_size").over(before), F.lit(0)).alias("run_start"))
    within = Window.partitionBy("source", "run").orderBy("key", "doc_id", "row_hash", *keep).rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("ahead", F.coalesce(F.sum(words_of).over(within), F.lit(0)))
    placed = placed.join(starts, placed["source"].eqNullSafe(starts["_s"]) & (placed["run"] == starts["_r"]))
    placed = copied(placed, (sized.agg(F.max("copies")).first()[0] or 0) > COPIES)
    placed = placed.withColumn("place", F.col("run_start") + F.col("ahead") + F.col("copy") * F.col("size"))
    ran = placed.withColumn("_passes", passes_of())
    taken = F.aggregate("_passes", F.lit(0).cast("long"), lambda a, p: a + p["pass_words"])
    return stored(ran.select(
        "doc_id", "source", "row_hash", "size", "source_size", "target", "ramp", "place", "copy", taken.alias("taken"),
        F.get("_passes", 0)["position"].alias("first_position"), *keep,
    ), "mixed")


def copied(rows: DataFrame, hot: bool) -> DataFrame:
    """A row for each of the `copies` of rows, numbered in a column copy. Where some have more than COPIES (`hot`), these are
    parted into chunks first, which are dealt to tasks before they are written out."""
    each = lambda first, end: F.explode(F.sequence(first, end - 1))
    if not hot:
        return rows.withColumn("copy", each(F.lit(0).cast("long"), F.col("copies")))
    few = rows.where(F.col("copies") <= COPIES).withColumn("copy", each(F.lit(0).cast("long"), F.col("copies")))
    many = rows.where(F.col("copies") > COPIES).withColumn("chunk", each(F.lit(0).cast("long"), F.ceil(F.col("copies") / COPIES)))
    many = many.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key", "chunk").withColumn("copy", each(F.col("chunk") * COPIES, F.least("copies", (F.col("chunk") + 1) * COPIES)))
    return few.unionByName(many.drop("chunk"))


def passes_of() -> Column:
    """The passes over a document that begin within the run, as structs (pass, position, pass_words).

    Pass p starts place + p * source_size words into the source's stream. Its place and its end there, as shares of the
    target, are inverted through the schedule to positions, the end cut off at 1, the end of the run; and what the
    integrated schedule gives between the two are its words.
    """
    goal = F.round("target")
    n = F.when((F.col("size") > 0) & (F.col("place") < goal), F.ceil((goal - F.col("place")) / F.col("source_size"))).otherwise(0).cast("int")
    at = lambda stream: position(F.least(stream / goal, F.lit(1.0)), F.col("ramp"))

    def one(p: Column) -> Column:
        start = F.col("place") + p * F.col("source_size")
        first, last = at(start), at(start + F.col("size"))
        return F.struct(p.alias("pass"), first.alias("position"), F.round(goal * (given(last, F.col("ramp")) - given(first, F.col("ramp")))).cast("long").alias("pass_words"))

    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), one)).otherwise(F.array().cast("array<struct<pass:int,position:double,pass_words:bigint>>"))


def few(targets: DataFrame, most: int = 10_000) -> bool:
    """Whether the table of sources is small enough to send to all tasks: counted, not assumed."""
    return targets.limit(most + 1).count() <= most


def training_order(mixed: DataFrame) -> DataFrame:
    """mix() as rows of passes (…, pass, position, pass_words), range-sorted by training position. A document has a row for
    each pass that gives words, whole or in part."""
    passes = mixed.select("*", F.inline(passes_of())).drop("taken", "first_position")
    return passes.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id", "row_hash")


def dealt(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of mix() with `taken`, `first_position` and `passes` gathered from the passes of training_order(), and those
    passes in their order.

    Both are written to the shared folder, so the order is made once. A document that gives words starts at a place that
    no other document of its source has, which is how its passes are found again; all others have none and take nothing.
    """
    mixed = mix(docs)
    order = stored(training_order(mixed), "training-order")
    found = order.groupBy(F.col("source").alias("_s"), F.col("place").alias("_p")).agg(F.sum("pass_words").alias("_given"), F.min("position").alias("_first"), F.count("*").alias("_n"))
    joined = mixed.join(found, mixed["source"].eqNullSafe(found["_s"]) & (mixed["place"] == found["_p"]) & (mixed["size"] > 0), "left")
    summed = {"taken": F.coalesce("_given", F.lit(0)).cast("long"), "first_position": F.col("_first"), "passes": F.coalesce("_n", F.lit(0)).cast("long")}
    return joined.withColumns(summed).drop("_s", "_p", "_given", "_first", "_n"), order


#: The position by which a share of a source's words is given, in SQL.
POSITION_SQL = "CASE WHEN abs(ramp) < 1e-9 THEN done ELSE 2 * done / ((1 - ramp) + sqrt(greatest((1 - ramp) * (1 - ramp) + 4 * ramp * done, 0))) END"
MIX_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS BIGINT) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '') || '/' || coalesce(text, '')) AS key FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
turns AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS turn, {PASSES}.0::DOUBLE * source_size AS cap FROM sources),
ranked AS (SELECT *, (CASE turn WHEN 0 THEN {WEIGHTS[0]} WHEN 1 THEN {WEIGHTS[1]} ELSE {WEIGHTS[2]} END)::DOUBLE AS weight,
    (CASE turn WHEN 0 THEN {RAMPS[0]} WHEN 1 THEN {RAMPS[1]} ELSE {RAMPS[2]} END)::DOUBLE AS ramp FROM turns),
leveled AS (SELECT *, ({SHARE} * (sum(source_size) OVER ())::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM ranked),
chosen AS (SELECT min_by(level, cap / weight) AS final FROM leveled WHERE level * weight < cap),
met AS (SELECT source, source_size, ramp, CASE WHEN final IS NULL THEN cap ELSE least(cap, final * weight) END AS target FROM leveled LEFT JOIN chosen ON true),
moved AS (SELECT source, source_size, target, ramp - coalesce(sum(ramp * target) OVER () / nullif(sum(target) OVER (), 0), 0) AS ramp FROM met),
targets AS (SELECT source, source_size, target, ramp / greatest(1, max(abs(ramp)) OVER ()) AS ramp FROM moved),
placed AS (SELECT s.doc_id, s.size, t.source_size, t.target, t.ramp, CAST(round(t.target) AS BIGINT) AS goal,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
begun AS (SELECT *, size > 0 AND place < goal AS given, place::DOUBLE / goal::DOUBLE AS done FROM placed)
SELECT doc_id, size, source_size, round(target, 6) AS target,
  CAST(CASE WHEN source_size > 0 THEN (goal // source_size) * size + greatest(0, least(size, goal - (goal // source_size) * source_size - place)) ELSE 0 END AS BIGINT) AS taken,
  CASE WHEN given THEN round({POSITION_SQL}, 9) END AS first_position, CAST(CASE WHEN given THEN ceil((goal - place)::DOUBLE / source_size) ELSE 0 END AS BIGINT) AS passes
FROM begun"""
