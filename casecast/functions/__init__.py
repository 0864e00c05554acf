"""Column expressions. All of them are built-in JVM expressions, so they stay inside whole-stage codegen."""

from pyspark.sql import functions as F

from casecast.schema import DIED, MALE, YES


def equals_flag(column, value):
    """1 where the column equals `value`, else 0; null gives 0."""
    return F.when(F.col(column) == value, 1).otherwise(0)


def yes_flag(column):
    return equals_flag(column, YES)


def male_flag(column="sex"):
    return equals_flag(column, MALE)


def death_label(column="classification"):
    """1.0 where the text contains the death mark (case sensitive), else 0.0; null gives 0.0."""
    return F.when(F.col(column).contains(DIED), 1.0).otherwise(0.0)


def day_gap(start, end):
    """Signed days from `start` to `end`; null if either is null."""
    return F.datediff(F.col(end), F.col(start))


def mean_up(value):
    """The mean rounded up to a whole number (bigint); nulls do not count."""
    return F.ceil(F.avg(value))


def key_hash(key):
    """Non-negative number from a row's key: the first 32 bits of the md5 of its text, the same on every layout.

    A null key counts as the empty text.
    """
    key = F.col(key) if isinstance(key, str) else key
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 8)
    return F.conv(digits, 16, 10).cast("bigint")
