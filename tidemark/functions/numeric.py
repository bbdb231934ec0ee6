"""Numeric helpers: payload number cleaning, target scaling, sign, casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import config as C


def strip_number(s: Column) -> Column:
    """Remove '$' and thousands separators."""
    return F.regexp_replace(s, r"[$,]", "")


def bad_number(s: Column) -> Column:
    """Whether a cleaned number does not parse."""
    return strip_number(s).try_cast("double").isNull()


def parse_price(s: Column) -> Column:
    """Prices must parse: a malformed price raises (whatever the ANSI
    setting of the session)."""
    v = strip_number(s).try_cast("double")
    return F.when(v.isNull() & s.isNotNull(),
                  F.raise_error(F.concat(F.lit("unparsable price: "), s))).otherwise(v)


def parse_volume(s: Column) -> Column:
    """Volumes that do not parse (e.g. 'N/A') become 0."""
    return F.coalesce(strip_number(s).try_cast("long"), F.lit(0).cast("long"))


def scale_clip(x: Column, scale: float = C.TARGET_SCALE,
               clip_factor: float = C.TARGET_SCALE_CLIP_FACTOR) -> Column:
    """Log-return targets x scale, clipped to +-clip_factor*scale."""
    c = clip_factor * scale
    return F.greatest(F.lit(-c), F.least(F.lit(c), x * F.lit(scale)))


def unscale(x: Column, scale: float = C.TARGET_SCALE) -> Column:
    return x * F.lit(1.0 / scale)


def sign(x: Column) -> Column:
    """-1 / 0 / 1 as an integer."""
    return F.signum(x).cast("int")


def to_f32(x: Column) -> Column:
    return x.cast("float")