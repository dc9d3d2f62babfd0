"""Several outputs from one pass: rows get a tag, consumers select theirs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tag_rows(rules: Sequence[tuple[str, Column]], otherwise: str, name: str = "tag"):
    """Tag every row with the first rule that holds, else with ``otherwise``."""

    def step(df: DataFrame) -> DataFrame:
        choice = F
        for tag, condition in rules:
            choice = choice.when(condition, F.lit(tag))
        return df.withColumn(name, choice.otherwise(F.lit(otherwise)))

    return step


def output(df: DataFrame, tag: str, name: str = "tag") -> DataFrame:
    """The rows of one tag. Each consumer re-reads the source with its own filter;
    ``sinks.write_tagged`` writes all tags in a single pass instead."""
    return df.where(F.col(name) == tag).drop(name)
