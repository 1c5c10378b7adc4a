"""Column functions: coercion, ages, identifiers, geometry text, literals."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..dims import BASE, CRS


def number(value: Column) -> Column:
    """A double, or null where the text is no number or is NaN."""
    d = value.try_cast("double")
    return F.when(~F.isnan(d), d)


def whole(value: Column) -> Column:
    """A bigint, or null where the text is no whole number."""
    return value.try_cast("bigint")


def to_ka(age_bp: Column) -> Column:
    return age_bp / 1000.0


def shift_datum(age: Column, scale: Column, offset: Column) -> Column:
    return age * scale + offset


def mint(template: str, *parts: Column, base: str = BASE) -> Column:
    """An identifier: the base and a printf template over the parts, such as 'Obs_%04d'. Longer numbers are not cut."""
    return F.concat(F.lit(base), F.format_string(template, *parts))


def observation_label(name: str, seq: Column, age_ka: Column, digits: int = 4) -> Column:
    return F.format_string(f"{name} observation %0{digits}d (%s ka BP)", seq, decimal_text(age_ka, 1))


def decimal_text(value: Column, digits: int | Column, places: int | None = None) -> Column:
    """value rounded half up and written plainly, never with an exponent; null stays null."""
    places = digits if places is None else places
    return F.round(value, digits).cast(f"decimal(28,{places})").cast("string")


def wkt_point(lon: Column, lat: Column, precision: int = 6) -> Column:
    """A point with its reference system, longitude first; null if either is null."""
    return F.when(lon.isNotNull() & lat.isNotNull(), F.format_string(f"{CRS} POINT(%.{precision}f %.{precision}f)", lon, lat))


def ensure_crs(wkt: Column) -> Column:
    """Trimmed geometry text, with the default reference system before it unless it names one. Idempotent."""
    t = F.trim(wkt)
    return F.when(t.startswith("<"), t).otherwise(F.concat(F.lit(CRS + " "), t))


def thousands(value: Column, digits: int = 0) -> Column:
    return F.format_number(value, digits)


def escape_literal(text: Column) -> Column:
    """Text between the quotes of a line of N-Triples."""
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text
