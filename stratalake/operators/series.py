"""Cleaning, reshaping and summarising proxy series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ..functions import number
from .blocks import in_blocks, split_long, with_position


def coerce(df: DataFrame, columns: Sequence[str], required: Sequence[str] = ()) -> DataFrame:
    """The columns as numbers (bad text and NaN become null); rows that lack a required one are dropped."""
    return df.withColumns({c: number(F.col(c)) for c in columns}).dropna(subset=list(required)) if required else df.withColumns({c: number(F.col(c)) for c in columns})


def age_slice(df: DataFrame, low: float, high: float, age: str = "age") -> DataFrame:
    """Rows with low <= age <= high."""
    return df.where(F.col(age).between(low, high))


def unpivot_proxies(df: DataFrame, ids: Sequence[str], proxies: Sequence[str]) -> DataFrame:
    """Long form (…, proxy, value) of a wide table, without rows that have no value."""
    return df.unpivot(list(ids), list(proxies), "proxy", "value").where("value IS NOT NULL")


def round_by_proxy(df: DataFrame, digits: dict[str, int], value: str = "value", proxy: str = "proxy", default: int = 4) -> DataFrame:
    """value rounded to the digits of its proxy, half up."""
    kinds: dict[int, list[str]] = {}
    for p, d in digits.items():
        kinds.setdefault(d, []).append(p)
    rounded = F.round(F.col(value), default)
    for d, names in kinds.items():
        rounded = F.when(F.col(proxy).isin(names), F.round(F.col(value), d)).otherwise(rounded)
    return df.withColumn(value, rounded)


def with_sequence(df: DataFrame, keys: Sequence[str], order: Sequence, start: int = 0, out: str = "seq", block_rows: int | None = None) -> DataFrame:
    """A running number per key in a total order. Give a tie-break as the last of `order`. With block_rows, keys that
    have more rows than that are numbered in parts."""
    short, long, n = split_long(df, keys, block_rows)
    done = short.withColumn(out, (F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1 + start).cast("bigint"))
    if long is None:
        return done
    placed = with_position(long, keys, order, block_rows, n)
    return done.unionByName(placed.withColumn(out, F.col("pos") - 1 + start).drop(*{"pos", "n"} - {out}))


def summarise(df: DataFrame, keys: Sequence[str], columns: Sequence[str], slice_on: str | None = None, low: float = 0, high: float = 0, present: Sequence[str] = ()) -> DataFrame:
    """Rows, and least and greatest of each column, per key; with slice_on the same again within the closed slice, and for the
    columns of `present` whether the key has any value of it, all in the same pass. NaN counts as missing."""
    clean = {c: F.when(~F.isnan(c), F.col(c)) for c in {*columns, *present}}
    aggs: list[Column] = [F.count("*").alias("n")] + [f(clean[c]).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))]
    if slice_on:
        inside = F.col(slice_on).between(low, high)
        aggs += [F.count(F.when(inside, 1)).alias("n_slice")] + [f(F.when(inside, clean[c])).alias(f"{name}_{c}_slice") for c in columns for name, f in (("min", F.min), ("max", F.max))]
    return df.groupBy(*keys).agg(*aggs, *[(F.count(clean[c]) > 0).alias(f"has_{c}") for c in present])


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The columns of each key's first row in the order given, by an aggregate rather than a sort."""
    return df.groupBy(*keys).agg(*[F.min_by(c, F.struct(*order)).alias(c) for c in columns])


def display_extents(df: DataFrame, keys: Sequence[str], value: str, padding: float = 0.05, ticks: DataFrame | dict | None = None) -> DataFrame:
    """Axis limits per key (low, high): of the ticks of the first key where given, padded by a twentieth of their span (half
    a unit if that is 0), else of the data, padded by `padding` of their range.

    Ticks are a table (first key, ticks array<double>), or a dict of few keys; keys without ticks use the data.
    """
    found = df.groupBy(*keys).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    span = F.col("hi") - F.col("lo")
    low, high = F.col("lo") - span * padding, F.col("hi") + span * padding
    if ticks is None:
        return found.select(*keys, low.alias("low"), high.alias("high"))
    if isinstance(ticks, dict):
        ticks = df.sparkSession.createDataFrame([(k, [float(x) for x in t]) for k, t in ticks.items()], f"{keys[0]} {dict(df.dtypes)[keys[0]]}, ticks array<double>")
    found = attach_config(found, ticks.select(keys[0], F.array_min("ticks").alias("_least"), F.array_max("ticks").alias("_most")), [keys[0]], how="left")
    pad = F.when(F.col("_most") > F.col("_least"), (F.col("_most") - F.col("_least")) * 0.05).otherwise(0.5)
    return found.select(*keys, F.coalesce(F.col("_least") - pad, low).alias("low"), F.coalesce(F.col("_most") + pad, high).alias("high"))


def missing_series(expected: DataFrame, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are expected and have no row with data."""
    return expected.select(*keys).distinct().join(df.select(*keys).distinct(), list(keys), "left_anti")


def find_gaps(df: DataFrame, keys: Sequence[str], order: Sequence[str], threshold: float, age: str = "age", value: str = "value", block_rows: int | None = None) -> DataFrame:
    """Segments (x1, y1, x2, y2) that bridge steps of age over the threshold; x is the value, y the age. With block_rows, keys
    that have more rows than that are cut into blocks."""
    short, long, n = split_long(df, keys, block_rows)

    def bridged(rows: DataFrame, own: Column, at: Sequence[str], order: Sequence[str]) -> DataFrame:
        w = Window.partitionBy(*at).orderBy(*order)
        both = rows.select(*keys, F.lag(value).over(w).alias("x1"), F.lag(age).over(w).alias("y1"), F.col(value).alias("x2"), F.col(age).alias("y2"), own.alias("_mine"))
        return both.where(F.col("_mine") & (F.col("y2") - F.col("y1") > threshold)).drop("_mine")

    found = bridged(short, F.lit(True), keys, order)
    if long is None:
        return found
    cut = in_blocks(with_position(long, keys, order, block_rows, n), 1, block_rows)
    return found.unionByName(bridged(cut, F.col("_own"), [*keys, "_block"], ["pos"]))


def is_small(df: DataFrame, most: int = 100_000) -> bool:
    """Whether a table has at most `most` rows: counted, and no further than that."""
    return df.limit(most + 1).count() <= most


def attach_config(df: DataFrame, config: DataFrame, keys: Sequence[str], most: int = 100_000, how: str = "inner") -> DataFrame:
    """df with a configuration's columns; sent to all tasks if it has at most `most` rows, else joined by shuffle."""
    return df.join(F.broadcast(config) if is_small(config, most) else config, list(keys), how)


#: Columns of the observation table that all kinds of series share.
HARMONISED = {
    "dataset": "string", "series_id": "string", "site": "string", "entity": "string", "proxy": "string", "unit": "string", "chronology": "string",
    "age_ka": "double", "depth": "double", "depth_unit": "string", "value": "double", "median": "double", "savgol": "double",
}


def harmonise(*series: DataFrame) -> DataFrame:
    """One observation table (HARMONISED) of several series: columns that one lacks are null, others are left out."""
    parts = [s.select(*[(F.col(c) if c in s.columns else F.lit(None)).cast(t).alias(c) for c, t in HARMONISED.items()]) for s in series]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
