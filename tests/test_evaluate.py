import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from casecast.operators.evaluate import METRICS, confusion, confusion_matrix, metrics_long, weighted_metrics
from casecast.session import small_table

SPARK_NAMES = {
    "f1": "f1",
    "accuracy": "accuracy",
    "weighted_precision": "weightedPrecision",
    "weighted_recall": "weightedRecall",
    "weighted_true_positive_rate": "weightedTruePositiveRate",
    "weighted_false_positive_rate": "weightedFalsePositiveRate",
}


@pytest.fixture(scope="module")
def predictions(spark):
    draw = random.Random(5)
    rows = []
    for group, classes in (("two", 2), ("five", 5), ("skewed", 3)):
        for _ in range(400):
            label = 0 if group == "skewed" and draw.random() < 0.8 else draw.randrange(classes)
            said = label if draw.random() < 0.6 else draw.randrange(classes)
            rows.append((group, float(label), float(said), draw.randrange(1, 4)))
    # class 9 is only ever predicted, class 2 never is
    rows += [("odd", a, p, 1) for a, p in [(0.0, 0.0), (0.0, 9.0), (1.0, 1.0), (1.0, 0.0), (2.0, 1.0)]]
    return small_table(spark, rows, "g string, label double, prediction double, n bigint")


def test_metrics_agree_with_sparks_evaluator(predictions):
    by_group = {row["g"]: row for row in weighted_metrics(confusion(predictions, ["g"]), ["g"]).collect()}
    for group, row in by_group.items():
        part = predictions.where(F.col("g") == group)
        for ours, theirs in SPARK_NAMES.items():
            assert row[ours] == pytest.approx(MulticlassClassificationEvaluator(metricName=theirs).evaluate(part), abs=1e-9)
        assert row["weighted_recall"] == pytest.approx(row["accuracy"])
        assert row["weighted_true_positive_rate"] == row["weighted_recall"]
        assert all(0 <= row[name] <= 1 for name in METRICS)


def test_counts_stand_for_rows(predictions):
    expanded = predictions.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n"))))
    weighted, repeated = confusion(predictions, ["g"], "n"), confusion(expanded, ["g"])
    assert sorted(map(str, weighted.collect())) == sorted(map(str, repeated.collect()))


def test_confusion_adds_up(predictions):
    assert confusion(predictions).agg(F.sum("n")).first()[0] == predictions.count()


def test_single_class_gives_no_division_by_zero(spark):
    one = small_table(spark, [(1.0, 1.0)], "label double, prediction double")
    row = weighted_metrics(confusion(one)).first()
    assert [row[name] for name in METRICS] == [1.0, 1.0, 1.0, 1.0, 1.0, 0.0]


def test_matrix_and_long_form(predictions):
    odd = confusion(predictions.where("g = 'odd'"))
    matrix = confusion_matrix(odd, [0.0, 1.0, 2.0]).collect()
    assert [tuple(row) for row in matrix] == [(0.0, 1, 0, 0), (1.0, 1, 1, 0), (2.0, 0, 1, 0)]
    long = metrics_long(weighted_metrics(confusion(predictions, ["g"]), ["g"]), ["g"])
    assert long.columns == ["g", "metric", "value"] and long.count() == 4 * len(METRICS)


def test_predictions_shuffle_once_as_partial_counts(predictions):
    plan = weighted_metrics(confusion(predictions))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("partial_count") == 1


def by_hand(pairs):
    """The six metrics from their definitions, pair by pair."""
    n = len(pairs)
    sums = dict.fromkeys(METRICS, 0.0)
    for c in {label for label, _ in pairs}:
        support = sum(label == c for label, _ in pairs)
        said = sum(prediction == c for _, prediction in pairs)
        tp = sum(label == prediction == c for label, prediction in pairs)
        precision, recall = tp / said if said else 0.0, tp / support
        share = support / n
        sums["f1"] += share * (2 * precision * recall / (precision + recall) if tp else 0.0)
        sums["accuracy"] += tp / n
        sums["weighted_precision"] += share * precision
        sums["weighted_recall"] += share * recall
        sums["weighted_true_positive_rate"] += share * recall
        sums["weighted_false_positive_rate"] += share * ((said - tp) / (n - support) if n > support else 0.0)
    return sums


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 5)), min_size=1, max_size=30), min_size=5, max_size=30))
def test_metrics_agree_with_their_definitions(spark, groups):
    rows = [(i, float(a), float(p)) for i, pairs in enumerate(groups) for a, p in pairs]
    table = small_table(spark, rows, "g int, label double, prediction double")
    for row in weighted_metrics(confusion(table, ["g"]), ["g"]).collect():
        expected = by_hand([(a, p) for i, a, p in rows if i == row["g"]])
        assert {name: row[name] for name in METRICS} == pytest.approx(expected, abs=1e-9)
