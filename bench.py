"""Time the headline queries and fits. Prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores (default 8).
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from casecast.models.estimators import estimator  # noqa: E402
from casecast.models.search import search  # noqa: E402
from casecast.operators.impute import GroupMeanImputer  # noqa: E402
from casecast.operators.prepare import assembler, complete_rows, confirmed_cases, derive, prepared_as_computed  # noqa: E402
from casecast.operators.profiles import COUNT, count_profiles, in_stable_order, weighted_blocks  # noqa: E402
from casecast.operators.split import with_split  # noqa: E402
from casecast.plans.training import training_rows  # noqa: E402
from casecast.queries import QUERIES  # noqa: E402
from casecast.schema import BASE_FEATURES, LABEL, WEIGHT  # noqa: E402
from casecast.session import checkpoint_dir, local_session  # noqa: E402
from casecast.sources import cases_from_orders  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

HEADLINES = [
    "base_rates",
    "csv_scan_roundtrip",
    "confirmed_cases",
    "prepared_as_computed",
    "model_inputs_base",
    "impute_age_by_sex",
    "impute_event_value",
    "case_profiles",
    "split_counts",
    "metrics_by_split",
    "metrics_multiclass",
    "saved_model_scores",
    "cross_validation_majority",
]

FITS = [
    ("fit_rf_20", "rf", {"numTrees": 20}),
    ("fit_rf_100", "rf", {"numTrees": 100}),
    ("fit_lr", "lr", {"maxIter": 100, "regParam": 0.1, "elasticNetParam": 0.15, "tol": 0.0}),
    ("fit_svm_20", "svm", {"maxIter": 20, "regParam": 0.1}),
    ("fit_gbt_10", "gbt", {"maxIter": 10}),
]
LR_SEARCH = {"maxIter": [100, 300], "elasticNetParam": [0.15], "regParam": [0.1, 0.3], "tol": [0.0]}


def filled_ages(derived):
    """Unknown ages only are filled, by sex."""
    age = {"inputCol": "age", "outputCol": "age", "groupCols": ["male"], "meanCol": "age_of_stated_sex"}
    return GroupMeanImputer(**age).fit(derived).transform(derived)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("casecast-bench", os.environ.get("BENCH_CPUS", "8"), os.environ.get("BENCH_MEMORY", "12g"))
    spark.sparkContext.setLogLevel("OFF")
    checkpoint_dir(spark)
    seconds = {}

    def timed(name, work):
        start = time.perf_counter()
        result = work()
        seconds[name] = round(time.perf_counter() - start, 3)
        return result

    def drain(df):
        df.write.format("noop").mode("overwrite").save()

    drain(QUERIES["base_rates"](spark, sf_dir))  # start-up of the session is not a query
    for name in HEADLINES:
        timed(name, lambda: drain(QUERIES[name](spark, sf_dir)))
        spark.catalog.clearCache()

    def prepare(known_ages=False):
        """From the case table to cached, counted training profiles, with the means over all confirmed cases."""
        derived = derive(confirmed_cases(cases_from_orders(spark, sf_dir)))
        prepared = filled_ages(derived) if known_ages else prepared_as_computed(derived)
        parted = with_split(complete_rows(prepared)).where(F.col("split") == "train")
        profiles = count_profiles(parted, ["fold", *BASE_FEATURES, LABEL]).persist()
        total, distinct = profiles.agg(F.sum(COUNT), F.count(F.lit(1))).first()
        return profiles, total, distinct

    profiles, total, distinct = timed("prepare_training_profiles", prepare)

    rows = {}
    for name, model, params in FITS:
        if model not in rows:
            rows[model] = training_rows(profiles, total, distinct, model).persist()
            rows[model].count()
        timed(name, lambda: estimator(model, WEIGHT, **params).fit(rows[model]))
    timed("search_lr_4_points", lambda: search(rows["lr"], "lr", LR_SEARCH, weight=WEIGHT, parallelism=2))

    # The default rule keeps known ages, which leaves many more combinations; and boosting on single cases, for comparison.
    known, total, distinct = timed("prepare_known_ages", lambda: prepare(True))
    for name, model, params in FITS[2:]:
        counted = training_rows(known, total, distinct, model).persist()
        counted.count()
        timed(f"{name}_known_ages", lambda: estimator(model, WEIGHT, **params).fit(counted))
    single = assembler().transform(in_stable_order(weighted_blocks(profiles), 8)).persist()
    single.count()
    timed("fit_gbt_10_cases", lambda: estimator("gbt", WEIGHT, maxIter=10).fit(single))
    spark.catalog.clearCache()
    timed("training_run", lambda: drain(QUERIES["training_run"](spark, sf_dir)))

    line = {
        "metric": "total seconds of headline queries and fits",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
