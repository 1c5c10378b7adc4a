"""Stage intervals over series: the visible part of each stage, and the stage of each observation."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from ..dims import STAGE_KINDS
from .series import is_small

#: Stages up to which the search is a tree of comparisons.
TREE = 64


def binned(stages: DataFrame) -> tuple[DataFrame, Callable[[Column], Column]]:
    """stages with a row for each bin that they reach into (_bin), and the bin of an age. Bins are as wide as a stage is on
    average, so that an equality join replaces the comparison of all pairs."""
    r = stages.agg(F.min("top").alias("a"), F.max("bottom").alias("b"), F.count("*").alias("n")).first()
    width = max((r.b - r.a) / r.n, 1e-9)
    of = lambda x: F.floor((x - r.a) / width)
    return stages.withColumn("_bin", F.explode(F.sequence(of(F.col("top")), of(F.col("bottom"))))), of


class Bounds(NamedTuple):
    """A scheme's stages in order, without overlap, as constant arrays."""

    tops: list[float]
    bottoms: list[float]
    table: Column  # an array of structs (top, bottom, stage, kind)


def bounds_of(stages: DataFrame, most: int) -> Bounds | None:
    """The stages as arrays if there are at most `most`, which is counted, and none overlaps another; else None. Stages that are
    empty or lack a bound hold no age and are left out."""
    if not is_small(stages, most):
        return None
    kind = F.col("kind") if "kind" in stages.columns else F.lit(None)
    found = stages.where("top < bottom").select(F.col("top").cast("double"), F.col("bottom").cast("double"), F.col("stage").cast("string"), kind.cast("string")).collect()
    rows = sorted((tuple(r) for r in found), key=lambda r: r[:2])
    if any(a[1] > b[0] for a, b in zip(rows, rows[1:])):
        return None
    text = json.dumps([dict(zip(("top", "bottom", "stage", "kind"), r)) for r in rows])
    return Bounds([r[0] for r in rows], [r[1] for r in rows], F.from_json(F.lit(text), "array<struct<top:double,bottom:double,stage:string,kind:string>>"))


def below(values: list[float], x: Column, equal: bool) -> Column:
    """How many of the rising values lie below x, or at it if `equal`, by binary search; null for null. Few values are a tree of
    comparisons in the generated code, more a loop over a constant array, with as many steps as halvings."""
    passed = lambda v: v <= x if equal else v < x

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(passed(F.lit(values[mid])), tree(mid + 1, hi)).otherwise(tree(lo, mid))

    if len(values) <= TREE:
        return F.when(x.isNotNull(), tree(0, len(values)))
    array = F.from_json(F.lit(json.dumps(values)), "array<double>")

    def step(at: Column, _: Column) -> Column:
        mid = F.floor((at["lo"] + at["hi"]) / 2).cast("int")
        right = (at["lo"] < at["hi"]) & passed(F.get(array, mid))
        return F.struct(F.when(right, mid + 1).otherwise(at["lo"]).alias("lo"), F.when(right, at["hi"]).otherwise(mid).alias("hi"))

    begin = F.struct(F.lit(0).alias("lo"), F.lit(len(values)).alias("hi"))
    return F.when(x.isNotNull(), F.aggregate(F.sequence(F.lit(0), F.lit(len(values).bit_length())), begin, step, lambda at: at["lo"]))


def clip_stages(extents: DataFrame, stages: DataFrame, keys: Sequence[str], most: int = 10_000) -> DataFrame:
    """Stages clipped to each key's [lo, hi] (…, stage, kind, drawn_as, visible_top, visible_bottom, label_at).

    A stage that only touches the extent is left out. At most `most` stages, counted, are searched in place and only those that an
    extent reaches are written out; more of them, or stages that overlap, are joined by bins of age.
    """
    top, bottom = F.greatest("top", "lo"), F.least("bottom", "hi")
    kinds = F.create_map(*[F.lit(x) for pair in STAGE_KINDS.items() for x in pair])
    if bounds := bounds_of(stages, most):
        first, end = below(bounds.bottoms, F.col("lo"), True), below(bounds.tops, F.col("hi"), False)
        reached = extents.withColumn("_st", F.explode(F.slice(bounds.table, first + 1, F.greatest(end - first, F.lit(0)))))
        met = reached.select("*", "_st.*").where(top < bottom)
    else:
        spread, of = binned(stages)
        reach = extents.withColumn("_bin", F.explode(F.sequence(of(F.col("lo")), of(F.col("hi")))))
        met = reach.join(spread, "_bin").where((top < bottom) & (F.col("_bin") == of(top)))
    return met.select(
        *keys, "stage", "kind", F.coalesce(F.try_element_at(kinds, F.col("kind")), F.lit("cold")).alias("drawn_as"),
        top.alias("visible_top"), bottom.alias("visible_bottom"), ((top + bottom) / 2).alias("label_at"),
    )


def tag_stage(df: DataFrame, stages: DataFrame, age: str = "age", most: int = 10_000) -> DataFrame:
    """df with the stage whose half-open interval [top, bottom) holds its age, else null; no row is doubled, as stages don't
    overlap. At most `most` stages, counted, are searched in place, without a join; more, or stages that overlap, are joined by
    bins of age."""
    x = F.col(age)
    if bounds := bounds_of(stages, most):
        found = F.get(bounds.table, below(bounds.tops, x, True) - 1)
        return df.withColumn("stage", F.when(x < found["bottom"], found["stage"]))
    spread, of = binned(stages.where("top < bottom").select("top", "bottom", "stage"))
    inside = (x >= F.col("top")) & (x < F.col("bottom"))
    return df.join(spread, (of(x) == F.col("_bin")) & inside, "left").drop("top", "bottom", "_bin")
