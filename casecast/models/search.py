"""Cross-validated grid search on weighted F1."""

from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel

from casecast.models.estimators import SEED, estimator
from casecast.models.grids import grid_points, param_maps, point_text
from casecast.operators.split import FOLDS


@dataclass
class SearchResult:
    """The refitted best model, and a (point, params, avg_f1, std_f1, best) row per grid point."""

    model: object
    tuning: list


def f1_evaluator(weight=None):
    evaluator = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="f1")
    return evaluator.setWeightCol(weight) if weight else evaluator


class JournaledCrossValidator(CrossValidator):
    """Cross-validation that enters each score into `journal` as it comes, and fits only points of a fold not entered yet."""

    journal, texts = None, []

    def _missing_scores(self, fold, missing, train, held_out):
        """(point, score) of the points `missing` on one fold, as they are done."""
        points, evaluator = self.getEstimatorParamMaps(), self.getEvaluator()
        fits = self.getEstimator().fitMultiple(train, [points[i] for i in missing])

        def one(_):
            index, model = next(fits)
            point = missing[index]
            score = float(evaluator.evaluate(model.transform(held_out, points[point])))
            self.journal.add(fold, point, self.texts[point], score)
            return point, score

        with ThreadPool(min(self.getParallelism(), len(missing))) as pool:
            yield from pool.imap_unordered(inheritable_thread_target(train.sparkSession)(one), missing)

    def _fit(self, dataset):
        if self.journal is None:
            return super()._fit(dataset)
        points, known = self.getEstimatorParamMaps(), self.journal.scores(self.texts)
        scores = np.zeros((self.getNumFolds(), len(points)))
        for fold, (train, held_out) in enumerate(self._kFold(dataset)):
            missing = [i for i in range(len(points)) if (fold, i) not in known]
            for i in set(range(len(points))) - set(missing):
                scores[fold, i] = known[fold, i]
            if missing:
                train, held_out = train.persist(), held_out.persist()
                try:
                    for i, score in self._missing_scores(fold, missing, train, held_out):
                        scores[fold, i] = score
                finally:
                    train.unpersist()
                    held_out.unpersist()
        averages = scores.mean(axis=0)
        best = self.getEstimator().fit(dataset, points[int(averages.argmax())])
        return self._copyValues(CrossValidatorModel(best, averages.tolist(), [], scores.std(axis=0).tolist()))


def search(train, name, axes, *, weight=None, fold_column="fold", folds=FOLDS, parallelism=2, journal=None, **params):
    """Fit and score every grid point on every fold, then refit the best one on all of `train`.

    Of points with equal averages the first in grid order wins. Without a fold column Spark draws the folds. A `journal`
    (`sinks/journal.py`) keeps the scores, which needs folds that come with the rows.
    """
    if journal is not None and not fold_column:
        raise ValueError("scores of folds that Spark draws anew cannot be kept")
    classifier = estimator(name, weight, **params)
    validator = JournaledCrossValidator(
        estimator=classifier,
        estimatorParamMaps=param_maps(classifier, axes),
        evaluator=f1_evaluator(weight),
        numFolds=folds,
        parallelism=parallelism,
        collectSubModels=False,
        seed=SEED,
    )
    validator.journal, validator.texts = journal, [point_text(point) for point in grid_points(axes)]
    if fold_column:
        validator.setFoldCol(fold_column)
    fitted = validator.fit(train)
    averages, deviations = [float(x) for x in fitted.avgMetrics], [float(x) for x in fitted.stdMetrics]
    best = averages.index(max(averages))
    tuning = [
        (i, point_text(point), averages[i], deviations[i], i == best) for i, point in enumerate(grid_points(axes))
    ]
    return SearchResult(fitted.bestModel, tuning)
