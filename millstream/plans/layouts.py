"""Text lines of the known files as rows with named, typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import to_day, to_float, to_int
from ..functions.text import field, fields_after, split_fields, strip_all

# The fields of the files, in order.
DEPARTMENT_FIELDS = ["id", "name", "salary", "dept", "date"]
CARD_FIELDS = [
    "customer_id", "first_name", "last_name", "relationship_no", "card_type",
    "max_credit_limit", "total_spent", "cash_withdrawn", "cleared_amount", "last_date",
]
LOAN_FIELDS = [
    "customer_id", "first_name", "last_name", "customer_category", "loan_id",
    "loan_category", "due_date", "due_amount", "payment_date",
]
SALE_FIELDS = [
    "store_id", "store_location", "product_id", "product_category",
    "pieces", "buy_rate", "sell_price", "unix_timestamp",
]


def _named(
    lines: DataFrame, names: list[str], keep: list[str], line: Column,
    fewest: int, most: int | None, on_error: str,
) -> DataFrame:
    """Lines with between ``fewest`` and ``most`` fields as named text columns. Other
    lines stop the job or, with ``"drop"`` and ``"null"``, are left out."""
    if on_error not in ("raise", "drop", "null"):
        raise ValueError("on_error must be 'raise', 'drop' or 'null'")
    fields = split_fields(line)
    fits = F.size("_f") >= fewest
    if most is not None:
        fits = fits & (F.size("_f") <= most)
    split = lines.select(*keep, fields.alias("_f"))
    if on_error == "raise":
        wrong = F.raise_error(F.concat(F.lit("wrong number of fields: "), F.array_join("_f", ",")))
        split = split.select(*keep, F.when(~fits, wrong).otherwise(F.col("_f")).alias("_f"))
    else:
        split = split.where(fits)
    return split.select(*keep, *[field("_f", i).alias(n) for i, n in enumerate(names)])


def department_rows(lines: DataFrame, line: str = "value", on_error: str = "raise") -> DataFrame:
    """Fields behind the fifth are not looked at; the date may be absent."""
    return _named(lines, DEPARTMENT_FIELDS, [], F.col(line), 4, None, on_error)


def keyed_rows(lines: DataFrame, line: str = "value") -> DataFrame:
    """The first field as ``key``, the others as the array ``fields``."""
    split = lines.select(split_fields(line).alias("_f"))
    return split.select(field("_f", 0).alias("key"), fields_after("_f", 0).alias("fields"))


def card_rows(lines: DataFrame, line: str = "value", on_error: str = "raise") -> DataFrame:
    """``on_error="null"`` leaves amounts that do not parse NULL."""
    rows = _named(lines, CARD_FIELDS, [], F.col(line), 10, 10, on_error)
    for amount in ("max_credit_limit", "total_spent", "cleared_amount"):
        rows = rows.withColumn(amount, to_float(amount, on_error))
    return rows


def loan_rows(lines: DataFrame, line: str = "value", on_error: str = "raise") -> DataFrame:
    """``on_error="null"`` leaves dates that do not parse NULL."""
    rows = _named(lines, LOAN_FIELDS, [], F.col(line), 9, 9, on_error)
    for day in ("due_date", "payment_date"):
        rows = rows.withColumn(day, to_day(strip_all(day), on_error=on_error))
    return rows


def sale_rows(
    lines: DataFrame, line: str | Column = "value", keep: list[str] | None = None,
    on_error: str = "raise",
) -> DataFrame:
    """Sales with or without the trailing time field. ``on_error="drop"`` leaves out
    lines whose numbers do not parse."""
    if on_error not in ("raise", "drop"):
        raise ValueError("on_error must be 'raise' or 'drop'")
    line = F.col(line) if isinstance(line, str) else line
    rows = _named(lines, SALE_FIELDS, keep or [], strip_all(line), 7, None, on_error)
    numbers = ["pieces", "buy_rate", "sell_price"]
    rule = "null" if on_error == "drop" else "raise"
    cast = {n: to_int(n, rule) for n in numbers}
    cast["unix_timestamp"] = to_int(strip_all("unix_timestamp"), rule)
    rows = rows.withColumns(cast)
    return rows.dropna(subset=numbers) if on_error == "drop" else rows
