"""The scoring job: a saved run's preparation and model over new cases."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from casecast.operators.prepare import confirmed_cases, derive, kept_keys
from casecast.schema import KEY
from casecast.sinks.model_store import load_model, load_preparation


def with_scores(model, inputs, key=KEY):
    """Key, label, prediction, raw margin of death and, for models that have one, its probability. Narrow."""
    scored = model.transform(inputs)
    raw = vector_to_array("rawPrediction")[1].alias("margin")
    probability = (
        [vector_to_array("probability")[1].alias("probability")] if "probability" in scored.columns else []
    )
    return scored.select(*kept_keys(inputs, key), "label", "prediction", raw, *probability)


def score_cases(spark, cases, paths, name, key=KEY):
    """Scores of the confirmed cases that have all inputs. Every row is scored where it is read; nothing shuffles."""
    inputs = load_preparation(paths.preparation).transform(derive(confirmed_cases(cases, key), key))
    return with_scores(load_model(name, paths.model(name)), inputs, key).withColumn("model", F.lit(name))


def write_scores(spark, cases, paths, name, out, key=KEY):
    score_cases(spark, cases, paths, name, key).write.mode("errorifexists").parquet(out)
