"""Case-outcome analytics on Spark: preparation, model search, evaluation and scoring of case records."""

from casecast.plans.reports import base_rates, leaderboard
from casecast.plans.scoring import score_cases, write_scores
from casecast.plans.training import TrainingSettings, train, train_rounds
from casecast.sinks.model_store import tuned_params
from casecast.sinks.paths import RunPaths
from casecast.sinks.tables import read_table
from casecast.sources import read_cases

__all__ = [
    "RunPaths",
    "TrainingSettings",
    "base_rates",
    "leaderboard",
    "read_cases",
    "read_table",
    "score_cases",
    "train",
    "train_rounds",
    "tuned_params",
    "write_scores",
]
