"""The four classifiers. Three of them share the work of grid points that differ only in `maxIter`.

Weights count equal cases. A linear fit on counted rows is the fit on the cases they stand for (`_CountsCases`).
"""

import queue
import threading

from pyspark import SparkContext
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LinearSVC,
    LinearSVCModel,
    LogisticRegression,
    LogisticRegressionModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import ElementwiseProduct
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import functions as F


# The seed of fits that name none.
SEED = 2048


class _GroupedFits:
    """Iterator of (index, model) for `fitMultiple`, safe to call from the threads of a cross-validation.

    Each call first fits one group of points that is not taken yet, if any, and then hands out one finished model.
    """

    def __init__(self, groups, fit_group):
        self._waiting = iter(groups)
        self._left = sum(len(group) for group in groups)
        self._fit_group = fit_group
        self._lock = threading.Lock()
        self._done = queue.Queue()

    def __iter__(self):
        return self

    def __next__(self):
        with self._lock:
            if self._left == 0:
                raise StopIteration
            self._left -= 1
            group = next(self._waiting, None)
        if group is not None:
            try:
                for finished in self._fit_group(group):
                    self._done.put(finished)
            except Exception as error:
                # Whoever waits for a model of this group gets the error instead of waiting forever.
                for _ in group:
                    self._done.put(error)
        finished = self._done.get()
        if isinstance(finished, Exception):
            raise finished
        return finished


class _SharesIterations:
    """`fitMultiple` that treats points which agree in everything but `maxIter` (`shared_param`) as one group."""

    shared_param = "maxIter"

    def fitMultiple(self, dataset, paramMaps):
        groups = {}
        for index, point in enumerate(paramMaps):
            rest = frozenset((param.name, value) for param, value in point.items() if param.name != self.shared_param)
            groups.setdefault(rest, []).append((self.copy(point).getOrDefault(self.shared_param), index))
        ordered = [sorted(group) for group in groups.values()]
        return _GroupedFits(ordered, lambda group: self._fit_group(dataset, paramMaps, group))


class _StopsByItself(_SharesIterations):
    """An optimiser that ended before `maxIter` gives the same model under any larger `maxIter`."""

    def _fit_group(self, dataset, paramMaps, group):
        model = converged = None
        for max_iter, index in group:
            if not converged:
                model = self.fit(dataset, paramMaps[index])
                converged = self._iterations(model) < max_iter
            yield index, model.copy(paramMaps[index])


def frequency_deviations(dataset, features, weight):
    """Each feature's standard deviation over the cases that the weights count, in one aggregation.

    Values are shifted by those of one row first, so that squares of large values do not drown their spread.
    """
    first = dataset.select(features).first()
    if first is None:
        raise ValueError("there are no rows to fit")
    values, origin = vector_to_array(features), first[0].toArray()
    shifted = [values[i] - float(x) for i, x in enumerate(origin)]
    n, *sums = dataset.agg(
        F.sum(weight),
        *[F.sum(F.col(weight) * x) for x in shifted],
        *[F.sum(F.col(weight) * x * x) for x in shifted],
    ).first()
    size = len(shifted)
    if n <= 1:
        return [0.0] * size
    return [max(0.0, (sums[size + i] - sums[i] * sums[i] / n) / (n - 1)) ** 0.5 for i in range(size)]


class _CountsCases:
    """Fits weighted rows as the cases they count.

    `fitMultiple`, which a search calls once for each fold, learns the deviations once for all its points.

    Spark divides a feature by its standard deviation, and with weights takes that of weighted observations, which is
    not the one over as many single rows. So the scaling is done here, by the deviations over the counted cases, the
    fit is left to Spark without its own, and the coefficients are scaled back. A feature that never varies gets 0.
    """

    _known = None  # the columns and the deviations that hold for all fits of one `fitMultiple`

    def _counts(self):
        return self.isDefined(self.weightCol) and self.getStandardization()

    def _deviations(self, dataset):
        columns = self.getFeaturesCol(), self.getWeightCol()
        if self._known is None or self._known[0] != columns:
            return frequency_deviations(dataset, *columns)
        return self._known[1]

    def fitMultiple(self, dataset, paramMaps):
        shared = self.copy()
        if self._counts():
            shared._known = (self.getFeaturesCol(), self.getWeightCol()), self._deviations(dataset)
        return super(_CountsCases, shared).fitMultiple(dataset, paramMaps)

    def _fit(self, dataset):
        if not self._counts():
            return super()._fit(dataset)
        features = self.getFeaturesCol()
        deviations = self._deviations(dataset)
        factors = [1.0 / x if x > 0 else 0.0 for x in deviations]
        scaled = f"{features}_scaled"
        product = ElementwiseProduct(scalingVec=Vectors.dense(factors), inputCol=features, outputCol=scaled)
        inner = self.copy({self.featuresCol: scaled, self.standardization: False})
        fitted = super(_CountsCases, inner)._fit(product.transform(dataset))
        model = self._scaled_back(fitted, DenseVector([c * f for c, f in zip(fitted.coefficients, factors)]))
        model.iterations = self._iterations(fitted)
        return self._copyValues(model)


def _java_vector(vector):
    sc = SparkContext.getOrCreate()
    values = sc._gateway.new_array(sc._jvm.double, len(vector))
    for i, value in enumerate(vector):
        values[i] = float(value)
    return sc._jvm.org.apache.spark.ml.linalg.Vectors.dense(values)


class CaseLogisticRegression(_CountsCases, _StopsByItself, LogisticRegression):
    @staticmethod
    def _iterations(model):
        return model.iterations if hasattr(model, "iterations") else model.summary.totalIterations

    def _scaled_back(self, fitted, coefficients):
        classes = SparkContext.getOrCreate()._jvm.org.apache.spark.ml.classification
        made = classes.LogisticRegressionModel(fitted.uid, _java_vector(coefficients), fitted.intercept)
        return LogisticRegressionModel(made)


def hinge_objective(dataset, model, penalty, deviations, label, features, weight):
    """What a linear SVM minimises: the mean hinge loss of the cases that the weights count, and the penalty."""
    values = vector_to_array(features)
    plane = sum((values[i] * float(c) for i, c in enumerate(model.coefficients)), F.lit(float(model.intercept)))
    loss = F.greatest(F.lit(0.0), 1 - (2 * F.col(label) - 1) * plane)
    total, cases = dataset.agg(F.sum(weight * loss), F.sum(weight)).first()
    return total / cases + penalty / 2 * sum((c * d) ** 2 for c, d in zip(model.coefficients, deviations))


class CaseLinearSVC(_CountsCases, _StopsByItself, LinearSVC):
    """The hinge loss has corners, at which Spark's solver may stop short of the least objective.

    With `starts` above 1 it is run as often, under penalties that differ by a thousandth or so and lead it along other paths, and
    the model whose objective under the wanted penalty is least is kept.
    """

    starts = 1

    def _fit(self, dataset):
        if self.starts == 1:
            return super()._fit(dataset)
        features, label, wanted = self.getFeaturesCol(), self.getLabelCol(), self.getRegParam()
        weight = F.col(self.getWeightCol()) if self.isDefined(self.weightCol) else F.lit(1.0)
        deviations = [1.0] * len(dataset.select(features).first()[0])
        if self.getStandardization():
            cases = dataset.withColumn("_cases", weight)
            deviations = self._deviations(dataset) if self._counts() else frequency_deviations(cases, features, "_cases")
        fitted = []
        for start in range(self.starts):
            shift = (-1) ** start * ((start + 1) // 2) * 0.001
            penalty = wanted * (1 + shift) if wanted else abs(shift) * 0.01
            model = super(CaseLinearSVC, self.copy({self.regParam: penalty}))._fit(dataset)
            fitted.append((hinge_objective(dataset, model, wanted, deviations, label, features, weight), start, model))
        best = self._copyValues(min(fitted)[2])
        best.iterations = max(self._iterations(model) for _, _, model in fitted)
        return best

    @staticmethod
    def _iterations(model):
        return model.iterations if hasattr(model, "iterations") else model.summary().totalIterations

    def _scaled_back(self, fitted, coefficients):
        classes = SparkContext.getOrCreate()._jvm.org.apache.spark.ml.classification
        return LinearSVCModel(classes.LinearSVCModel(fitted.uid, _java_vector(coefficients), fitted.intercept))


class CaseGBTClassifier(_SharesIterations, GBTClassifier):
    """A boosted model of n rounds is the first n trees of a longer one, so one fit serves all round counts."""

    def _fit_group(self, dataset, paramMaps, group):
        longest = self.fit(dataset, paramMaps[group[-1][1]])
        for rounds, index in group:
            yield index, first_rounds(longest, rounds).copy(paramMaps[index])


def first_rounds(model, rounds):
    """The boosted model made of the first `rounds` trees."""
    if rounds >= model.getNumTrees:
        return model
    sc = SparkContext.getOrCreate()
    ml = sc._jvm.org.apache.spark.ml
    trees = sc._gateway.new_array(ml.regression.DecisionTreeRegressionModel, rounds)
    weights = sc._gateway.new_array(sc._jvm.double, rounds)
    all_trees, all_weights = model._java_obj.trees(), model._java_obj.treeWeights()
    for i in range(rounds):
        trees[i], weights[i] = all_trees[i], all_weights[i]
    shorter = ml.classification.GBTClassificationModel(model.uid, trees, weights)
    return model._copyValues(GBTClassificationModel(shorter))


ESTIMATORS = {
    "rf": RandomForestClassifier,
    "lr": CaseLogisticRegression,
    "svm": CaseLinearSVC,
    "gbt": CaseGBTClassifier,
}

MODEL_CLASSES = {
    "rf": RandomForestClassificationModel,
    "lr": LogisticRegressionModel,
    "svm": LinearSVCModel,
    "gbt": GBTClassificationModel,
}


def estimator(name, weight=None, *, counted_forest=False, counted_candidates=False, starts=1, **params):
    """One of the four classifiers over `features` and `label`, at Spark's defaults but for `params`.

    `counted_forest` makes forests draw the cases that rows count (`models/forests.py`) instead of the rows, and
    `counted_candidates` has boosted trees take split candidates from the counted cases (`models/boosted.py`). `starts` is how
    often the solver of a support vector machine is run, of whose models the best is kept.

    A seed is always set: PySpark's default one comes from a string hash that changes with every Python process.
    """
    if name not in ESTIMATORS:
        raise ValueError(f"unknown model {name!r}, not one of {sorted(ESTIMATORS)}")
    if weight:
        params["weightCol"] = weight
    if name in ("rf", "gbt"):
        params = {"seed": SEED} | params
    kind = ESTIMATORS[name]
    if name == "rf" and counted_forest:
        from casecast.models.forests import CountedForestClassifier as kind
    if name == "gbt" and counted_candidates:
        from casecast.models.boosted import CountedGBTClassifier as kind
    made = kind(featuresCol="features", labelCol="label", **params)
    if name == "svm":
        made.starts = starts
    return made
