"""Shared column helpers: white space, text form of values, guarded errors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WS = " \t\n\r\x0b\x0c\x85                 　"


def ws_trim(c: Column) -> Column:
    """Trim all Unicode white space, not spaces alone."""
    return F.btrim(c, F.lit(WS))


def num(c: Column) -> Column:
    """Double, or null where the text is no number."""
    return ws_trim(c.cast("string")).try_cast("double")


def go_text(c: Column, dtype: str) -> Column:
    """A value's text as in event payloads: whole doubles show no fraction."""
    if dtype in ("double", "float"):
        whole = (c == F.floor(c)) & (F.abs(c) < 1e15)
        return F.when(whole, c.cast("long").cast("string")).otherwise(c.cast("string"))
    return c.cast("string")


def guard(bad: Column, message: str, value: Column) -> Column:
    """``value``, or an error raised where ``bad`` holds."""
    return F.when(bad, F.raise_error(F.lit(message))).otherwise(value)


def micros(df, name: str) -> Column:
    """Microseconds since 1970 of a timestamp column, with or without zone."""
    if dict(df.dtypes)[name] == "timestamp":
        return F.unix_micros(name)
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast(`{name}` as timestamp_ntz))")
