"""Word count, case-sensitive, words being runs of ASCII letters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import join_fields, words
from ..operators.elements import flat_map
from ..operators.grouping import count_per_key


def word_count(texts: DataFrame, text: str = "value") -> DataFrame:
    found = texts.transform(flat_map(words(text), "word"))
    return count_per_key(found, ["word"])


def word_lines(counts: DataFrame) -> DataFrame:
    """Counts as lines such as ``word, 3``."""
    return counts.select(join_fields(", ", F.col("word"), F.col("n")).alias("value"))
