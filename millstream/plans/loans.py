"""Loan defaulters.

Loans have person columns, ``loan_category``, ``due_date`` and ``payment_date``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import join_fields
from ..operators.grouping import group_by_key

# The category with its own rule, and the limits of the two rules.
MEDICAL = "Medical Loan"
MEDICAL_MIN_LATE = 3
PERSONAL_MIN_MISSED = 4
MONTHS = 12

PERSON = ("customer_id", "first_name", "last_name")


def late_flags(loans: DataFrame, person: Sequence[str] = PERSON) -> DataFrame:
    """Person, branch, due and paid day, and ``late`` (1 or 0) per record. Paying on
    the due day is in time. The branch is ``medical_loan`` or ``personal_loan``."""
    branch = F.when(F.col("loan_category") == MEDICAL, "medical_loan").otherwise("personal_loan")
    return loans.select(
        *person, branch.alias("tag"), "due_date", "payment_date",
        F.when(F.col("due_date") < F.col("payment_date"), 1).otherwise(0).alias("late"),
    )


def medical_defaulters(
    flags: DataFrame, person: Sequence[str] = PERSON, min_late: int = MEDICAL_MIN_LATE
) -> DataFrame:
    """Persons with at least ``min_late`` late payments on medical loans."""
    medical = flags.where(F.col("tag") == "medical_loan")
    late = medical.groupBy(*person).agg(F.sum("late").alias("late"))
    return late.where(F.col("late") >= min_late)


def _per_month(flags: DataFrame, person: Sequence[str]) -> DataFrame:
    """Per person and month: late medical payments, and the personal record due last
    (then paid last), NULL if there is none.

    Due and paid day are packed into one number, so that the latest record is a
    plain maximum: it is computed before the shuffle, in memory of fixed size.
    """
    medical, personal = F.col("tag") == "medical_loan", F.col("tag") == "personal_loan"
    due = F.unix_date("due_date").cast("bigint")
    paid = F.unix_date("payment_date").cast("bigint")
    packed = due * F.lit(1 << 32) + (paid + F.lit(1 << 31))
    return flags.groupBy(*person, F.month("due_date").alias("_month")).agg(
        F.coalesce(F.sum(F.when(medical, F.col("late"))), F.lit(0)).alias("_late"),
        F.max(F.when(personal, packed)).alias("_last"))


def _per_person(monthly: DataFrame, person: Sequence[str]) -> DataFrame:
    """One row per person: ``late`` (medical), ``n_personal`` months with a personal
    record, and ``missed``, a number of 12 bits of which one is set for every month
    whose record is late or absent. A person has at most 12 rows here, so nothing
    large meets in one place."""
    last_due = F.shiftright("_last", 32)
    last_paid = F.col("_last").bitwiseAND(F.lit((1 << 32) - 1)) - F.lit(1 << 31)
    month_bit = F.call_function("shiftleft", F.lit(1), F.col("_month") - 1)
    in_time = F.bit_or(F.when(last_due >= last_paid, month_bit))
    missed = F.lit((1 << MONTHS) - 1).bitwiseAND(F.bitwise_not(F.coalesce(in_time, F.lit(0))))
    return monthly.groupBy(*person).agg(
        F.sum("_late").alias("late"), F.count("_last").alias("n_personal"),
        missed.alias("missed"))


def _missed_months(flags: DataFrame, person: Sequence[str]) -> DataFrame:
    personal = flags.where(F.col("tag") == "personal_loan")
    return _per_person(_per_month(personal, person), person)


def month_flags(flags: DataFrame, person: Sequence[str] = PERSON) -> DataFrame:
    """Per person an array ``missed`` of 12 flags. A month without a record counts as
    missed; of several records of a month the one due last (then paid last) counts."""
    bits = F.transform(
        F.sequence(F.lit(0), F.lit(MONTHS - 1)), lambda i: F.getbit("missed", i).cast("int"))
    return _missed_months(flags, person).select(*person, bits.alias("missed"))


def _defaults(missed: Column, min_missed: int) -> Column:
    """Enough bits are set, or two neighbouring ones."""
    two_in_a_row = missed.bitwiseAND(F.shiftright(missed, 1)) != 0
    return (F.bit_count(missed) >= min_missed) | two_in_a_row


def personal_defaulters(
    flags: DataFrame, person: Sequence[str] = PERSON, min_missed: int = PERSONAL_MIN_MISSED
) -> DataFrame:
    """Persons who missed ``min_missed`` months or two in a row on personal loans.
    The job as first coded asked for one month more; 5 does the same."""
    missed = F.col("missed")
    months = _missed_months(flags, person).where(_defaults(missed, min_missed))
    return months.select(*person, F.bit_count(missed).alias("n_missed"))


def payments_per_person(
    flags: DataFrame, person: Sequence[str] = PERSON, chunks: int = 1
) -> DataFrame:
    """Every person's payment records as lists of structs ``value`` and ``times``, all of
    them, in ``chunks`` pieces for all persons alike."""
    return group_by_key(
        flags, person, F.struct("due_date", "payment_date", "late"), "payments", chunks)


def defaulters(
    flags: DataFrame, person: Sequence[str] = PERSON, min_missed: int = PERSONAL_MIN_MISSED
) -> DataFrame:
    """``name`` and ``tag`` (``medical_loan`` or ``personal_loan``) of both kinds of
    defaulters; someone who is both appears twice.

    Both rules are evaluated on one summary per person, so the loans are read and
    shuffled once and not once per branch.
    """
    persons = _per_person(_per_month(flags, person), person)
    kinds = F.array_compact(F.array(
        F.when(F.col("late") >= MEDICAL_MIN_LATE, "medical_loan"),
        F.when((F.col("n_personal") > 0) & _defaults(F.col("missed"), min_missed),
               "personal_loan"),
    ))
    return persons.select(join_fields(" ", *person).alias("name"), F.explode(kinds).alias("tag"))


def all_defaulters(
    flags: DataFrame, person: Sequence[str] = PERSON, min_missed: int = PERSONAL_MIN_MISSED
) -> DataFrame:
    """The names alone."""
    return defaulters(flags, person, min_missed).select("name")
