"""Confusion counts and the weighted metrics made of them."""

from pyspark.sql import Window
from pyspark.sql import functions as F

METRICS = [
    "f1",
    "accuracy",
    "weighted_precision",
    "weighted_recall",
    "weighted_true_positive_rate",
    "weighted_false_positive_rate",
]


def confusion(predictions, keys=(), count=None):
    """Cases per actual and predicted class, within each combination of `keys`."""
    n = F.sum(count) if count else F.count(F.lit(1))
    return predictions.groupBy(
        *keys, F.col("label").cast("double").alias("label"), F.col("prediction").cast("double").alias("prediction")
    ).agg(n.cast("bigint").alias("n"))


def confusion_matrix(counts, classes):
    """The counts as a matrix for display: a row per actual class and a column per class of `classes`."""
    actual = counts.where(F.col("label").isin(classes))
    return actual.groupBy("label").pivot("prediction", classes).agg(F.sum("n")).na.fill(0).orderBy("label")


def _ratio(part, whole):
    return F.when(whole > 0, part / whole).otherwise(0.0)


def weighted_metrics(counts, keys=()):
    """The six metrics, one row per combination of `keys`, from the confusion counts in a single pass.

    Each count is credited to its actual class and to its predicted class, so that support, hits and predictions per
    class come out of one aggregation without joining the counts to themselves. Classes that never occur as the
    actual one weigh nothing. From here on there is one row per class.
    """
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    none = F.lit(0)

    def credit(to, support, tp, said):
        return F.struct(F.col(to).alias("class"), support.alias("support"), tp.alias("tp"), said.alias("said"))

    credits = F.array(credit("label", F.col("n"), hit, none), credit("prediction", none, none, F.col("n")))
    per_class = (
        counts.select(*keys, F.inline(credits))
        .groupBy(*keys, "class")
        .agg(F.sum("support").alias("support"), F.sum("tp").alias("tp"), F.sum("said").alias("said"))
    )
    everything = Window.partitionBy(*[F.col(key) for key in keys]) if keys else Window.partitionBy(F.lit(0))
    precision, recall = _ratio(F.col("tp"), F.col("said")), _ratio(F.col("tp"), F.col("support"))
    rates = per_class.withColumn("total", F.sum("support").over(everything)).select(
        *keys,
        (F.col("support") / F.col("total")).alias("share"),
        F.col("tp"),
        F.col("total"),
        precision.alias("precision"),
        recall.alias("recall"),
        _ratio(F.col("said") - F.col("tp"), F.col("total") - F.col("support")).alias("fpr"),
    )
    f1 = _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))

    def share_of(value):
        return F.sum(F.col("share") * value)

    return rates.groupBy(*keys).agg(
        share_of(f1).alias("f1"),
        (F.sum("tp") / F.max("total")).alias("accuracy"),
        share_of(F.col("precision")).alias("weighted_precision"),
        share_of(F.col("recall")).alias("weighted_recall"),
        share_of(F.col("recall")).alias("weighted_true_positive_rate"),
        share_of(F.col("fpr")).alias("weighted_false_positive_rate"),
    )


def metrics_long(metrics, keys=()):
    """One row per metric: the keys, its name and its value."""
    return metrics.unpivot([F.col(key) for key in keys], METRICS, "metric", "value")
