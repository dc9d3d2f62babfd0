"""Attendance: department records counted per name, in several ways.

Records have the columns ``id``, ``name`` and ``dept``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.cogroup import exclude
from ..operators.combine import CombineFn, combine_globally
from ..operators.elements import Step, chain, filter_in, tag_constant
from ..operators.grouping import count_per_key, fold_groups, group_by_key, having, sum_list
from ..operators.tags import tag_rows


def attendance_count(records: DataFrame, dept: str = "Accounts") -> DataFrame:
    """Rows of one department, counted per name."""
    return count_per_key(records.where(F.col("dept") == dept), ["name"])


def attendance_by_groups(records: DataFrame, dept: str = "Accounts") -> DataFrame:
    """The same count by grouping ones and folding each group."""
    ones = records.where(F.col("dept") == dept).select("name", F.lit(1).alias("one"))
    return fold_groups(group_by_key(ones, ["name"], "one"), ["name"], sum_list, name="n")


class CountByLabel(CombineFn):
    """How often each label occurs, as one list. The accumulator holds every label, so this
    is for label sets of bounded size; a count per name belongs under the name as a key."""

    def create_accumulator(self) -> dict:
        return {}

    def add_input(self, accumulator: dict, element: str) -> dict:
        accumulator[element] = accumulator.get(element, 0) + 1
        return accumulator

    def merge_accumulators(self, accumulators: Sequence[dict]) -> dict:
        return dict(sum(map(Counter, accumulators), Counter()))

    def extract_output(self, accumulator: dict) -> list[dict]:
        return [{"label": label, "n": count} for label, count in accumulator.items()]


def label_counts(records: DataFrame, label: str) -> DataFrame:
    """One global result holding all counts, then unnested into rows again."""
    whole = combine_globally(
        records, [label], CountByLabel(), "counts array<struct<label:string,n:bigint>>")
    return whole.select(F.inline("counts"))


def departments_merged(records: DataFrame, depts: Sequence[str]) -> DataFrame:
    """Several departments counted apart, each row tagged with its department.

    The branches differ only in the department they pick, so they share one scan
    and one shuffle: the department becomes part of the key.
    """
    return records.transform(filter_in("dept", list(depts))).transform(
        lambda df: count_per_key(df, ["name", "dept"]))


def frequent(minimum: int = 30, label: str = "Employee") -> Step:
    """Composite step: counts above a minimum, tagged."""
    return chain(having(F.col("n") > minimum), tag_constant("tag", label))


def frequent_names(records: DataFrame, depts: Sequence[str], minimum: int = 30) -> DataFrame:
    """The composite step on the counts of every department."""
    return departments_merged(records, depts).transform(frequent(minimum)).drop("dept")


def attendance_with_exclusions(
    records: DataFrame,
    exclusions: DataFrame,
    dept: str = "Accounts",
    lower: int = 3,
    upper: int | None = 10,
) -> DataFrame:
    """Count per (id, name) in one department, without the excluded ids and with the
    length of the name within closed bounds; no ``upper`` means no upper bound.

    Ids are excluded after counting: each id is then looked up once, however many
    records it has.
    """
    length = F.length("name")
    fits = length >= lower if upper is None else length.between(lower, upper)
    kept = records.where(fits & (F.col("dept") == dept))
    return exclude(count_per_key(kept, ["id", "name"]), exclusions, ["id"])


def names_by_kind(names: DataFrame, cutoff_length: int = 4, marker: str = "K") -> DataFrame:
    """Names that start with the marker, else short ones, else long ones."""
    return names.transform(tag_rows(
        [(marker, F.startswith("name", F.lit(marker))),
         ("Short_Names", F.length("name") <= cutoff_length)],
        otherwise="Long_Names",
    ))


def salary_per_employee(records: DataFrame) -> DataFrame:
    """Sum of salary with the record (id, name) as the key."""
    return records.groupBy(F.struct("id", "name").alias("employee")).agg(
        F.sum("salary").alias("total"))
