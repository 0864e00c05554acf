"""Saved classifiers, their tuned parameters, and the saved preparation."""

from pyspark.ml import PipelineModel

from casecast.models.estimators import MODEL_CLASSES
from casecast.models.grids import REPORTED
from casecast.session import small_table


def save_model(model, path, overwrite=False):
    """Save a model or pipeline. An existing path raises unless overwriting was asked for."""
    writer = model.write()
    (writer.overwrite() if overwrite else writer).save(path)


def load_model(name, path):
    return MODEL_CLASSES[name].load(path)


def load_preparation(path):
    return PipelineModel.load(path)


def tuned_params(spark, paths, models):
    """The tuned parameters as the saved models carry them: one (run_id, model, param, value) row each."""
    rows = []
    for name in models:
        model = load_model(name, paths.model(name))
        for param in REPORTED[name]:
            rows.append((paths.run_id, name, param, str(model.getOrDefault(model.getParam(param)))))
    return small_table(spark, rows, "run_id string, model string, param string, value string")
