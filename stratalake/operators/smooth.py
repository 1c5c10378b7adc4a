"""Smoothing of ordered series: centred rolling median and Savitzky-Golay, per key or in blocks with halos.

The plain form is one window per key. A key with very many rows is cut into blocks of positions: rows near a border are
copied to the neighbouring block too, the same window runs per block, and the copies are dropped. Wide windows are worked on
block by block in Arrow batches: a median that moves with the row, and a fit by one product per row, neither of which sorts or
gathers a row's window anew.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType
from pyspark.sql.window import Window

from ..dims import POLYORDER, WINDOW, savgol_weights
from .blocks import BLOCK_ROWS, in_blocks, split_long, with_position

#: Widest window that is worked on by window functions.
NARROW = 21


def median_over(value: str, keys: Sequence[str], order: Sequence[str], window: int) -> Column:
    frame = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-(window // 2), (window - 1) // 2)
    return F.percentile(value, F.lit(0.5)).over(frame)


def neighbours(value: str, keys: Sequence[str], order: Sequence[str], window: int) -> dict[str, Column]:
    """The values up to window - 1 rows before and after each row, as columns of their own."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return {f"_v{d}": F.lag(value, -d).over(w) for d in range(1 - window, window)}


def fit_of(window: int, polyorder: int, pos: Column, n: Column) -> Column:
    """The fitted value at each row from its neighbours(); edges use the polynomial of the first or last `window` rows; null in
    shorter series. A null within a row's window makes its result null."""
    weights, mid = savgol_weights(window, polyorder), window // 2
    at = pos - F.least(F.greatest(pos - mid, F.lit(1)), n - window + 1)
    inner = sum((F.col(f"_v{j - mid}") * F.lit(x) for j, x in enumerate(weights[mid])), F.lit(0.0))
    near = F.slice(F.array(*[F.col(f"_v{d}") for d in range(1 - window, window)]), (F.lit(window) - at).cast("int"), window)
    row = F.get(F.array(*[F.array(*[F.lit(x) for x in r]) for r in weights]), at.cast("int"))
    edge = F.aggregate(F.zip_with(near, row, lambda v, x: v * x), F.lit(0.0), lambda a, b: a + b)
    return F.when(n >= window, F.when(at == mid, inner).otherwise(edge))


def moving_median(v: np.ndarray, window: int) -> np.ndarray:
    """Medians of the frames that median_over() takes, from an ordered structure that each step changes by two values."""
    return pd.Series(v).rolling(window, center=True, min_periods=1).median().to_numpy()


def moving_fit(v: np.ndarray, pos: np.ndarray, n: int, window: int, polyorder: int) -> np.ndarray:
    """What fit_of() gives, for rows of consecutive positions `pos` of a key of n rows that hold their windows; not a number
    where they don't, or where a value within is missing."""
    out = np.full(len(v), np.nan)
    if n < window or len(v) < window:
        return out
    mid, shift = window // 2, np.nanmean(v) if np.isfinite(v).any() else 0.0
    q, _ = np.linalg.qr(np.vander(np.linspace(-1, 1, window), polyorder + 1))
    missing = np.concatenate([[0], np.cumsum(np.isnan(v))])
    whole = missing[window:] == missing[:-window]  # by the first row of a window
    filled = np.where(np.isnan(v), 0.0, v - shift)
    inner = np.correlate(filled, q @ q[mid], "valid") + shift
    out[mid : mid + len(inner)] = np.where(whole, inner, np.nan)
    if pos[0] == 1:
        out[:mid] = q[:mid] @ (q.T @ filled[:window]) + shift if whole[0] else np.nan
    if pos[-1] == n:
        out[len(v) - mid :] = q[window - mid :] @ (q.T @ filled[-window:]) + shift if whole[-1] else np.nan
    return out


def smooth_wide(rows: DataFrame, at: Sequence[str], value: str, median: str | None, savgol: str | None, window: int, polyorder: int) -> DataFrame:
    """rows, which have pos and n, with their smoothed values, one group of `at` at a time. Other columns pass as they are."""
    if savgol and (window % 2 == 0 or polyorder >= window):
        raise ValueError("the window must be odd and longer than the order")
    names = [c for c in (median, savgol) if c]

    def one(group: pa.Table) -> pa.Table:
        group = group.sort_by("pos")
        v, pos = group[value].cast(pa.float64()).to_numpy(), group["pos"].to_numpy()
        v = np.where(np.isfinite(v), v, np.nan)
        found = ([moving_median(v, window)] if median else []) + ([moving_fit(v, pos, group["n"][0].as_py(), window, polyorder)] if savgol else [])
        for name, x in zip(names, found):
            group = group.append_column(name, pa.array(x, from_pandas=True))
        return group

    return rows.groupBy(*at).applyInArrow(one, StructType([*rows.schema.fields, *[StructField(c, DoubleType()) for c in names]]))


def smooth(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, median: str | None = "median", savgol: str | None = "savgol", window: int = WINDOW, polyorder: int = POLYORDER, block_rows: int | None = None) -> DataFrame:
    """df with the rolling median and the Savitzky-Golay value of each row in its key, in one pass over one sort.

    `order` must be total within a key: end it with a tie-break. With block_rows, keys that have more rows than that, which are
    counted, are cut into blocks of so many, so one long series does not land in one task; the results are the same. Null
    keys are a key, nulls in the order come first. Windows of more than NARROW rows are worked on in memory, a key or block
    at a time, so block_rows is BLOCK_ROWS for them unless given; a value that is not finite counts as missing there.
    """
    keys, wide, names = list(keys), window > NARROW, df.columns
    short, long, count = split_long(df, keys, block_rows or (BLOCK_ROWS if wide else None))
    block_rows = block_rows or BLOCK_ROWS

    def done(rows: DataFrame, at: Sequence[str], by: Sequence[str]) -> DataFrame:
        if wide:
            return smooth_wide(rows, at, value, median, savgol, window, polyorder)
        out = {median: median_over(value, at, by, window)} if median else {}
        rows = rows.withColumns(out | (neighbours(value, at, by, window) if savgol else {}))
        return rows.withColumn(savgol, fit_of(window, polyorder, F.col("pos"), F.col("n"))) if savgol else rows

    added = [c for c in (median, savgol) if c]
    if savgol or wide:
        whole = Window.partitionBy(*keys)
        short = short.withColumns({"pos": F.row_number().over(whole.orderBy(*order)).cast("bigint"), "n": F.count(F.lit(1)).over(whole)})
    plain = done(short, keys, list(order)).select(*names, *added)
    if long is None:
        return plain
    cut = in_blocks(with_position(long, keys, order, block_rows, count), window - 1 if savgol else window // 2, block_rows)
    return plain.unionByName(done(cut, [*keys, "_block"], ["pos"]).where("_own").select(*names, *added))


def rolling_median(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, window: int = WINDOW, out: str = "median", block_rows: int | None = None) -> DataFrame:
    return smooth(df, keys, order, value, median=out, savgol=None, window=window, block_rows=block_rows)


def savgol(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, window: int = WINDOW, polyorder: int = POLYORDER, out: str = "savgol", block_rows: int | None = None) -> DataFrame:
    return smooth(df, keys, order, value, median=None, savgol=out, window=window, polyorder=polyorder, block_rows=block_rows)


def smoothing_variants(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, ids: Sequence[str], window: int = WINDOW, polyorder: int = POLYORDER, block_rows: int | None = None) -> DataFrame:
    """Long form (…, variant, x) of each row's value, rolling median and Savitzky-Golay value; rows without one left out."""
    names = {value: "unsmoothed", "median": f"smooth{window}", "savgol": f"savgol{window}p{polyorder}"}
    done = smooth(df, keys, order, value, window=window, polyorder=polyorder, block_rows=block_rows)
    done = done.select(*ids, *[F.col(c).cast("double").alias(v) for c, v in names.items()])
    return done.unpivot(list(ids), list(names.values()), "variant", "x").where("x IS NOT NULL")
