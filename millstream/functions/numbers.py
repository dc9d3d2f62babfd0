"""Text to numbers and dates, with the failure rule chosen by the caller."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the day format of the loan file.
DAY_FORMAT = "dd-MM-yyyy"


def _parsed(value: Column, source: Column, what: str, on_error: str) -> Column:
    if on_error == "null":
        return value
    if on_error != "raise":
        raise ValueError("on_error must be 'raise' or 'null'")
    bad = F.raise_error(F.concat(F.lit(f"not {what}: "), source.cast("string")))
    return F.when(source.isNotNull() & value.isNull(), bad).otherwise(value)


def to_int(c: Column | str, on_error: str = "raise") -> Column:
    """Text to a 64-bit integer. Bad text stops the job, or gives NULL on request."""
    c = F.col(c) if isinstance(c, str) else c
    return _parsed(c.try_cast("bigint"), c, "an integer", on_error)


def to_float(c: Column | str, on_error: str = "raise") -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return _parsed(c.try_cast("double"), c, "a number", on_error)


def to_day(c: Column | str, fmt: str = DAY_FORMAT, on_error: str = "raise") -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return _parsed(F.try_to_date(c, fmt), c, "a date", on_error)


def to_cents(c: Column | str) -> Column:
    """A money amount with two decimals as whole cents, so that sums are exact."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c * 100).cast("bigint")
