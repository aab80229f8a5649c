"""Small column helpers with the reference's number semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def num_text(c: Column) -> Column:
    """Integral numbers print without a fraction, as in the reference."""
    return c.cast("bigint").cast("string")


def js_round(c: Column) -> Column:
    """Round half up (toward +inf), like ``Math.round``."""
    return F.floor(c + F.lit(0.5)).cast("bigint")


def js_ceil_div(num: Column, den: int) -> Column:
    return F.ceil(num.cast("double") / F.lit(float(den))).cast("bigint")


def iso_millis(ts: Column) -> Column:
    """``Date.toISOString`` form of a UTC timestamp."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


_EPOCH = "1970-01-01 00:00:00"


def epoch_micros(ts: Column) -> Column:
    """Microseconds since the epoch of a wall-clock timestamp, independent of
    the session time zone (the captured tables load as ``TIMESTAMP_NTZ``)."""
    return F.timestamp_diff("MICROSECOND", F.lit(_EPOCH).cast("timestamp_ntz"), ts.cast("timestamp_ntz"))
