"""Store sales: five windowed jobs over sale messages, on tables and streams.

All jobs drop sales of other cities; all but the session job sum profit per
store, the session job sums pieces per product category.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import from_bytes, pair_text, to_bytes
from ..operators.panes import count_panes
from ..operators.sessions import session_windows
from ..operators.windows import fixed_windows, sliding_windows
from .layouts import sale_rows

# The cities of interest and the sizes of the windows.
CITIES = ("Mumbai", "Bangalore")
FIXED_SIZE = "5 seconds"
SLIDING_SIZE, SLIDING_STEP = "10 seconds", "5 seconds"
SESSION_GAP_SECONDS = 10
PANE_ROWS = 5


def sales_from_messages(
    messages: DataFrame, cities: Sequence[str] = CITIES, on_error: str = "raise"
) -> DataFrame:
    """Payload bytes to sale rows of the cities, with ``profit`` and the message's
    ``element_time``, and its ``message_id`` if there is one."""
    more = [c for c in ("element_time", "message_id") if c in messages.columns]
    rows = sale_rows(messages, from_bytes("data"), more, on_error)
    return with_profit(rows.where(F.col("store_location").isin(*cities)))


def with_profit(sales: DataFrame) -> DataFrame:
    profit = (F.col("sell_price") - F.col("buy_rate")) * F.col("pieces")
    return sales.withColumn("profit", profit)


def with_event_time(sales: DataFrame, delay: str | None = None) -> DataFrame:
    """Event time from the sale itself. On a stream ``delay`` says how far it may lag."""
    timed = sales.withColumn("element_time", F.timestamp_seconds("unix_timestamp"))
    return timed.withWatermark("element_time", delay) if delay else timed


def profit_by_fixed_window(sales: DataFrame, size: str = FIXED_SIZE) -> DataFrame:
    return fixed_windows(sales, ["store_id"], "element_time", "profit", size)


def profit_by_sliding_window(
    sales: DataFrame, size: str = SLIDING_SIZE, step: str = SLIDING_STEP
) -> DataFrame:
    return sliding_windows(sales, ["store_id"], "element_time", "profit", size, step)


def pieces_by_session(sales: DataFrame, gap_seconds: float = SESSION_GAP_SECONDS) -> DataFrame:
    return session_windows(sales, ["product_category"], "element_time", "pieces", gap_seconds)


def profit_by_panes(sales: DataFrame, order: Sequence[str] = ("element_time",)) -> DataFrame:
    return count_panes(sales, ["store_id"], order, "profit", PANE_ROWS)


def result_payload(key: str, total: str = "total") -> Column:
    """The result as the bytes of a pair, such as ``('STR_2', 216)``."""
    return to_bytes(pair_text(key, total))
