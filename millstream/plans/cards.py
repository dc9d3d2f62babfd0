"""Card skippers: points per customer for payments that fall short."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import join_fields

# Fixed value: the share of the spending that has to be cleared.
CLEARED_SHARE = 0.7

CUSTOMER = ("customer_id", "first_name", "last_name")


def card_points(
    spent: Column, cleared: Column, limit: Column, both_bonus: bool = True
) -> Column:
    """One point for clearing less than 70 % of the spending, one for spending the
    whole limit without clearing all of it, and one more if both hold. The job as
    first coded could never give the third; ``both_bonus=False`` does the same."""
    short = F.when(cleared < F.lit(CLEARED_SHARE) * spent, 1).otherwise(0)
    over = F.when((spent >= limit) & (cleared < spent), 1).otherwise(0)
    return short + over + short * over if both_bonus else short + over


def card_defaulters(
    cards: DataFrame, both_bonus: bool = True, keys: Sequence[str] = CUSTOMER
) -> DataFrame:
    """Points per customer; customers without points are kept."""
    points = card_points(
        F.col("total_spent"), F.col("cleared_amount"), F.col("max_credit_limit"), both_bonus)
    return cards.groupBy(*keys).agg(F.sum(points).alias("points"))


def defaulter_lines(points: DataFrame, keys: Sequence[str] = CUSTOMER) -> DataFrame:
    return points.select(join_fields(" ", *keys, F.col("points")).alias("value"))
