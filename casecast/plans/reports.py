"""Summaries over prepared cases and over finished runs."""

import json

from pyspark.sql import Window
from pyspark.sql import functions as F

from casecast.operators.evaluate import METRICS


def base_rates(complete):
    """Deaths and days to admission by level of care, over complete cases."""
    return complete.groupBy("icu", "ventilator").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("label").cast("bigint").alias("deaths"),
        F.round(F.avg("label"), 6).alias("death_rate"),
        F.round(F.avg("days_to_admission"), 6).alias("avg_days_to_admission"),
    )


def leaderboard(metrics, dataset="test"):
    """One row per run, feature set and model with its metrics on one set, best F1 first."""
    return (
        metrics.where(F.col("dataset") == dataset)
        .groupBy("run_id", "features", "model")
        .pivot("metric", METRICS)
        .agg(F.first("value"))
        .orderBy(F.desc("f1"), "run_id", "features", "model")
    )


def search_plan(train, grids):
    """The fits a search makes: each grid point with each fold's number of training and validation cases.

    The counts are one aggregation over the training part; after it there is one row per fold, next to which the
    literal list of points is exploded.
    """
    per_fold = train.groupBy("fold").agg(F.count(F.lit(1)).alias("n_validation"))
    counted = per_fold.withColumn("n", F.sum("n_validation").over(Window.partitionBy(F.lit(0))))
    listed = json.dumps([{"model": model, "point": point, "params": params} for model, point, params in grids])
    points = F.from_json(F.lit(listed), "array<struct<model: string, point: int, params: string>>")
    return counted.select(
        F.inline(points), "fold", (F.col("n") - F.col("n_validation")).alias("n_train"), "n_validation"
    )
