import os
import random
import statistics

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from casecast.models.boosted import candidate_borders, quantile_sketch
from casecast.models.estimators import estimator
from casecast.models.grids import param_maps
from casecast.operators.prepare import assembler, complete_rows, confirmed_cases, derive
from casecast.operators.profiles import count_profiles
from casecast.schema import BASE_FEATURES
from casecast.session import small_table
from casecast.sinks.model_store import load_model, save_model
from casecast.sources import cases_from_orders


def vectors(table, *inputs):
    return VectorAssembler(inputCols=list(inputs), outputCol="features").transform(table)


def borders(rows, bins, weight="weight"):
    found = {}
    for row in candidate_borders(rows, "features", F.col(weight), bins).collect():
        found.setdefault(row.feature, []).append(row.border)
    return {feature: sorted(own) for feature, own in found.items()}


def splits(model):
    return [line for line in model.toDebugString.split("\n")[1:] if line and "Predict" not in line]


@pytest.fixture(scope="module")
def larger(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.1")
    folder = folder if os.path.isdir(folder) else sf_dir
    cases = complete_rows(derive(confirmed_cases(cases_from_orders(spark, folder)))).select(*BASE_FEATURES, "label")
    counted = count_profiles(cases, [*BASE_FEATURES, "label"]).withColumn("weight", F.col("n").cast("double"))
    return assembler().transform(cases.repartition(5)).persist(), assembler().transform(counted.coalesce(2)).persist()


def test_trees_on_counts_are_those_on_cases(larger):
    cases, counted = larger
    # Where all cases agree the rounding of sums may or may not see a gain, so splits have to gain something.
    params = {"counted_candidates": True, "maxIter": 3, "minInfoGain": 1e-9}
    a, b = estimator("gbt", **params).fit(cases), estimator("gbt", "weight", **params).fit(counted)
    assert splits(a) == splits(b) and a.numFeatures == b.numFeatures == 5 and b.getMaxBins() == 32
    margins = [
        [r[0] for r in m.transform(counted).orderBy(*BASE_FEATURES, "label").select(vector_to_array("rawPrediction")[1]).collect()]
        for m in (a, b)
    ]
    assert margins[0] == pytest.approx(margins[1], abs=1e-9)


def test_few_values_give_the_trees_of_spark(spark):
    rows = vectors(small_table(spark, [(float(i % 7) - 3, float(i % 5), float(i % 7 > 3 or i % 5 == 2)) for i in range(300)], "a double, b double, label double"), "a", "b")
    plain, own = estimator("gbt", maxIter=3).fit(rows), estimator("gbt", counted_candidates=True, maxIter=3).fit(rows)
    assert splits(plain) == splits(own)


def test_borders_part_the_weight_and_follow_it_alone(spark):
    draw = random.Random(5)
    values = [draw.choice([-1, 1]) * draw.lognormvariate(0, 4) for _ in range(3000)] + [0.0] * 500
    table = vectors(small_table(spark, [(x, float(1 + i % 3)) for i, x in enumerate(values)], "x double, weight double"), "x")
    once = vectors(small_table(spark, [(x, 1.0) for i, x in enumerate(values) for _ in range(1 + i % 3)], "x double, weight double"), "x")
    found = borders(table, 20)[0]
    assert found == borders(once.repartition(7), 20)[0] and len(found) <= 19
    weights = {x: 0 for x in values}
    for i, x in enumerate(values):
        weights[x] += 1 + i % 3
    total, heaviest = sum(weights.values()), max(weights.values())
    edges = [-float("inf"), *found, float("inf")]
    for low, high in zip(edges, edges[1:]):
        assert sum(w for x, w in weights.items() if low < x <= high) <= total / 20 + heaviest + 0.01 * total
    whole = quantile_sketch(table, "features", F.col("weight")).agg(F.sum("weight")).first()[0]
    assert whole == total and statistics.median(values) <= max(found)


def test_a_third_of_the_weight_in_one_value_leaves_the_others_apart(spark):
    rows = vectors(small_table(spark, [(7.0, 1e9), *[(float(x), 2e9 / 99) for x in range(100) if x != 7]], "x double, weight double"), "x")
    found = borders(rows, 10)[0]
    assert 6.5 in found or 7.5 in found
    assert len(found) >= 6


def test_odd_tables(spark):
    one = vectors(small_table(spark, [(5.0, 0.0, 2.0), (5.0, 1.0, 1.0)], "x double, label double, weight double"), "x")
    assert borders(one, 32) == {}
    model = estimator("gbt", "weight", counted_candidates=True, maxIter=2).fit(one)
    assert {row.prediction for row in model.transform(one).collect()} == {0.0}
    with pytest.raises(ValueError, match="no rows"):
        estimator("gbt", counted_candidates=True).fit(one.where("x > 9"))
    none = vectors(small_table(spark, [(5.0, 0.0), (6.0, 1.0), (9.0, 4.0)], "x double, weight double"), "x")
    assert borders(none, 32) == {0: [7.5]}


def test_shared_rounds_and_saved_models(spark, larger, tmp_path):
    _, counted = larger
    classifier = estimator("gbt", "weight", counted_candidates=True)
    models = dict(classifier.fitMultiple(counted, param_maps(classifier, {"maxIter": [1, 2]})))
    assert [models[i].getNumTrees for i in range(2)] == [1, 2] and splits(models[1])[: len(splits(models[0]))] == splits(models[0])
    save_model(models[1], str(tmp_path / "gbt"))
    again = load_model("gbt", str(tmp_path / "gbt"))
    assert again.toDebugString.split("\n")[1:] == models[1].toDebugString.split("\n")[1:]
