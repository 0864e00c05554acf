import threading

import pytest
from pyspark.sql import functions as F

from casecast.models.estimators import _GroupedFits, estimator, first_rounds
from casecast.models.grids import FULL, MODELS, PRESETS, REPORTED, grid_points, param_maps, point_text
from casecast.models.search import f1_evaluator, search
from casecast.session import small_table


@pytest.fixture(scope="module")
def rows(spark):
    table = spark.range(400).select(
        (F.col("id") % 7).cast("double").alias("a"),
        (F.col("id") % 5).cast("double").alias("b"),
        F.when((F.col("id") % 7 + F.col("id") % 3) > 5, 1.0).otherwise(0.0).alias("label"),
        (F.floor(F.col("id") / 11) % 3).cast("int").alias("fold"),
        F.lit(1.0).alias("weight"),
    )
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(table.coalesce(1)).persist()


def test_full_grids_have_the_published_sizes():
    assert {name: len(grid_points(FULL[name])) for name in MODELS} == {"rf": 36, "lr": 576, "svm": 100, "gbt": 12}


@pytest.mark.parametrize("preset", sorted(PRESETS))
@pytest.mark.parametrize("name", MODELS)
def test_grid_points_are_numbered_like_sparks_param_maps(spark, preset, name):
    axes = PRESETS[preset][name]
    maps = [{param.name: value for param, value in point.items()} for point in param_maps(estimator(name), axes)]
    assert maps == grid_points(axes)
    assert set(axes) <= set(REPORTED[name])


def test_point_text():
    assert point_text({"maxIter": 5, "tol": 0.0}) == "maxIter=5 tol=0.0"


def predictions(model, rows):
    return [tuple(row) for row in model.transform(rows).select("rawPrediction", "prediction").collect()]


SHARED = {
    "lr": {"maxIter": [2, 100, 300], "regParam": [0.1, 0.01], "tol": [1e-6]},
    "svm": {"maxIter": [3, 60, 90], "regParam": [0.1], "tol": [0.05]},
    "gbt": {"maxIter": [4, 2], "stepSize": [0.2, 0.3]},
}


@pytest.mark.parametrize("name", sorted(SHARED))
def test_shared_fits_equal_single_fits(rows, name):
    classifier = estimator(name)
    points = param_maps(classifier, SHARED[name])
    shared = dict(classifier.fitMultiple(rows, points))
    assert sorted(shared) == list(range(len(points)))
    for index, point in enumerate(points):
        single = classifier.fit(rows, point)
        assert predictions(shared[index], rows) == predictions(single, rows)
        assert shared[index].getMaxIter() == single.getMaxIter()
    assert len({id(model) for model in shared.values()}) == len(points)


def test_converged_fits_are_not_repeated(rows, monkeypatch):
    classifier = estimator("lr")
    fitted = []
    monkeypatch.setattr(type(classifier), "_fit", _counting(type(classifier)._fit, fitted))
    dict(classifier.fitMultiple(rows, param_maps(classifier, SHARED["lr"])))
    assert len(fitted) == 4  # per regParam: stopped at 2, then converged below 100


def _counting(fit, calls):
    def counted(self, dataset):
        calls.append(self.getMaxIter())
        return fit(self, dataset)

    return counted


def test_first_rounds_is_a_working_model(rows):
    longer = estimator("gbt", maxIter=5).fit(rows)
    shorter = first_rounds(longer, 2)
    assert shorter.getNumTrees == 2 and first_rounds(longer, 5) is longer
    assert predictions(shorter, rows) == predictions(estimator("gbt", maxIter=2).fit(rows), rows)


def test_grouped_fits_hand_out_all_models_to_many_threads():
    fits = _GroupedFits([[0, 1, 2], [3], [4, 5]], lambda group: ((i, f"m{i}") for i in group))
    got = []
    threads = [threading.Thread(target=lambda: got.append(next(fits))) for _ in range(6)]
    [t.start() for t in threads]
    [t.join(10) for t in threads]
    assert sorted(got) == [(i, f"m{i}") for i in range(6)]
    with pytest.raises(StopIteration):
        next(fits)


def test_grouped_fits_pass_errors_on():
    def fit(group):
        yield group[0], "m"
        raise RuntimeError("no memory")

    fits = _GroupedFits([[0, 1]], fit)
    assert next(fits) == (0, "m")
    with pytest.raises(RuntimeError, match="no memory"):
        next(fits)


def test_search_takes_first_of_equal_points(rows):
    result = search(rows, "lr", {"elasticNetParam": [1.0], "regParam": [10.0, 20.0]}, weight="weight")
    assert [row[4] for row in result.tuning] == [True, False]
    assert result.tuning[0][2] == result.tuning[1][2]
    assert result.model.getRegParam() == 10.0


def test_search_scores_are_the_means_over_folds(rows):
    axes = {"maxIter": [1, 3], "stepSize": [0.3]}
    result = search(rows, "gbt", axes, weight="weight", parallelism=3)
    for index, point in enumerate(grid_points(axes)):
        scores = []
        for fold in range(3):
            model = estimator("gbt", "weight", **point).fit(rows.where(F.col("fold") != fold))
            scores.append(f1_evaluator("weight").evaluate(model.transform(rows.where(F.col("fold") == fold))))
        assert result.tuning[index][2] == pytest.approx(sum(scores) / 3)
    assert max(row[2] for row in result.tuning) == [row for row in result.tuning if row[4]][0][2]


def test_search_without_fold_column(rows):
    result = search(rows, "rf", {"numTrees": [2, 3], "seed": [512]}, fold_column=None)
    assert len(result.tuning) == 2 and result.model.getNumTrees in (2, 3)


@pytest.mark.parametrize("name", ["gbt", "svm"])
def test_binary_models_refuse_three_classes(spark, name):
    three = small_table(spark, [(0.0,), (1.0,), (2.0,)], "label double").select(
        "label", F.lit(None).cast("int").alias("x")
    )
    from pyspark.ml.feature import VectorAssembler

    three = VectorAssembler(inputCols=["label"], outputCol="features").transform(three)
    with pytest.raises(Exception, match="(?i)label"):
        estimator(name).fit(three)


def test_unknown_model():
    with pytest.raises(ValueError, match="knn"):
        estimator("knn")


def test_shared_fits_of_a_single_class(rows):
    """A fold may hold survivors only. The linear SVM refuses that by itself, and says so through the shared fits."""
    survivors = rows.where("label = 0")
    axes = {"maxIter": [5, 10], "regParam": [0.1]}
    logistic, machine = estimator("lr"), estimator("svm")
    for _, model in logistic.fitMultiple(survivors, param_maps(logistic, axes)):
        assert {row.prediction for row in model.transform(survivors).collect()} == {0.0}
    with pytest.raises(Exception, match="binary"):
        list(machine.fitMultiple(survivors, param_maps(machine, axes)))


@pytest.mark.parametrize("name", ["lr", "svm"])
def test_deviations_are_learned_once_for_each_fold(rows, name, monkeypatch):
    from casecast.models import estimators

    calls, plain = [], estimators.frequency_deviations
    monkeypatch.setattr(estimators, "frequency_deviations", lambda *args: calls.append(args[1:]) or plain(*args))
    axes = {"regParam": [0.1, 0.2, 0.3], "maxIter": [3, 9]}
    result = search(rows, name, axes, weight="weight", parallelism=3)
    assert calls == [("features", "weight")] * 4  # three folds and the refit
    classifier = estimator(name, "weight")
    for index, point in enumerate(param_maps(classifier, axes)):
        single = classifier.fit(rows, point)
        again = dict(classifier.fitMultiple(rows, [point]))[0]
        assert predictions(single, rows) == predictions(again, rows)
        if result.tuning[index][4]:
            assert predictions(result.model, rows) == predictions(single, rows)


def test_of_several_starts_the_best_is_kept(spark, rows, tmp_path):
    from casecast.models.estimators import frequency_deviations, hinge_objective
    from casecast.sinks.model_store import load_model, save_model

    deviations = frequency_deviations(rows, "features", "weight")

    def reached(model, penalty):
        return hinge_objective(rows, model, penalty, deviations, "label", "features", F.col("weight"))

    for weight, penalty in (("weight", 0.05), (None, 0.05)):
        one, more = (estimator("svm", weight, starts=n, regParam=penalty, maxIter=6).fit(rows) for n in (1, 3))
        assert reached(more, penalty) <= reached(one, penalty) + 1e-12
        assert more.getRegParam() == penalty and more.getMaxIter() == 6
    machine = estimator("svm", "weight", starts=2)
    points = param_maps(machine, {"maxIter": [2, 4], "regParam": [0.2]})
    shared = dict(machine.fitMultiple(rows, points))
    for index, point in enumerate(points):
        assert predictions(shared[index], rows) == predictions(machine.fit(rows, point), rows)
    save_model(shared[1], str(tmp_path / "svm"))
    again = load_model("svm", str(tmp_path / "svm"))
    assert again.getRegParam() == 0.2 and predictions(again, rows) == predictions(shared[1], rows)
