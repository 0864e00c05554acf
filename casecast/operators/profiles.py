"""Counts of equal cases. Cases that agree in every model column are one row with a count, and nothing is lost."""

from pyspark.sql import functions as F

from casecast.schema import WEIGHT

COUNT = "n"


def count_profiles(table, by, count=None):
    """One row per distinct combination of the columns `by` with its number of cases.

    Equal cases are added up before the shuffle, so what travels is bounded by the distinct combinations per task and
    a combination that holds a third of all cases arrives as a handful of partial counts.
    """
    n = F.sum(count) if count else F.count(F.lit(1))
    return table.groupBy(*by).agg(n.cast("bigint").alias(COUNT))


def weighted_blocks(profiles, total=None, blocks=None):
    """Rows of `weight` equal cases each; without `blocks` every case is a row of weight 1.

    With `blocks`, `total` cases are split into blocks of nearly equal weight, none above total/blocks rounded up, so
    there are at most `blocks` plus the distinct combinations of them however many cases there are. A combination that
    holds a third of all cases is many rows either way.
    """
    width = max(1, -(-total // blocks)) if blocks else 1
    pieces = F.ceil(F.col(COUNT) / width)
    piece = F.explode(F.sequence(F.lit(1).cast("bigint"), pieces)).alias("block")
    weight = F.floor(F.col(COUNT) / pieces) + F.when(F.col("block") <= F.col(COUNT) % pieces, 1).otherwise(0)
    return profiles.select("*", piece).withColumn(WEIGHT, weight.cast("double")).drop(COUNT)


def in_stable_order(table, partitions):
    """Place and order rows by their content alone, so that a fit repeats whatever layout the table came in."""
    columns = sorted(table.columns)
    return table.repartition(partitions, *columns).sortWithinPartitions(*columns)


def dealt_evenly(table, partitions):
    """Place rows by where they stand in the table, so that equal rows, however many, do not meet in one partition.

    The table must come in a fixed order, as staged files do, or a repeated task would deal its rows otherwise.
    """
    dealt = table.withColumn("_row", F.monotonically_increasing_id())
    return dealt.repartition(partitions, "_row").drop("_row")
