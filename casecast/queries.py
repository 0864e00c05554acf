"""Every operator as a query over the test tables: name -> f(spark, sf_dir) -> DataFrame."""

from functools import partial
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casecast.models.boosted import candidate_borders
from casecast.models.estimators import estimator, frequency_deviations, hinge_objective
from casecast.models.forests import with_draws
from casecast.models.grids import FULL, SMOKE, grid_points, point_text
from casecast.models.search import f1_evaluator, search
from casecast.operators.evaluate import METRICS, confusion, confusion_matrix, metrics_long, weighted_metrics
from casecast.operators.impute import GroupMeanImputer
from casecast.operators.prepare import (
    complete_rows,
    confirmed_cases,
    derive,
    group_means,
    model_inputs,
    prepared_as_computed,
)
from casecast.operators.profiles import COUNT, count_profiles, dealt_evenly, in_stable_order
from casecast.operators.split import PARTS, with_split
from casecast.plans import reports
from casecast.plans.scoring import score_cases, with_scores
from casecast.plans.training import TrainingSettings, full_partitions, laid_out, train, training_rows
from casecast.schema import BASE_FEATURES, CASE_SCHEMA, FEATURE_SETS, KEY, LABEL, WEIGHT
from casecast.session import checkpoint_dir, scratch_path, small_table, staged
from casecast.sinks.journal import SearchJournal
from casecast.sinks.model_store import load_model, save_model, tuned_params
from casecast.sinks.paths import RunPaths, claim_run
from casecast.sinks.report import report_lines, write_report
from casecast.sinks.tables import SCHEMAS, read_table
from casecast.sources import cases_from_orders, read_cases_csv, read_cases_parquet

DIGITS = 6


def rounded(column, digits=DIGITS):
    return F.round(F.col(column), digits).alias(column)


def confirmed(spark, sf_dir):
    return confirmed_cases(cases_from_orders(spark, sf_dir))


def derived(spark, sf_dir):
    return derive(confirmed(spark, sf_dir))


def prepared(spark, sf_dir):
    return prepared_as_computed(derived(spark, sf_dir))


# Sources


def csv_scan_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "cases-csv")
    cases_from_orders(spark, sf_dir).write.option("header", True).csv(path)
    return read_cases_csv(spark, path, types={KEY: T.LongType()})


def csv_scan_inferred(spark, sf_dir):
    path = scratch_path(spark, "cases-csv")
    cases_from_orders(spark, sf_dir).write.option("header", True).option("sep", ";").csv(path)
    cases = read_cases_csv(spark, path, sep=";", infer=True)
    return cases.withColumn(KEY, F.col(KEY).cast("bigint"))


def csv_scan_other_headers(spark, sf_dir):
    """Files whose columns come in two orders, with inferred types and a column for lines that do not parse."""
    path = scratch_path(spark, "cases-csv")
    cases = cases_from_orders(spark, sf_dir)
    even = F.col(KEY) % 2 == 0
    cases.where(even).write.option("header", True).csv(path)
    cases.where(~even).select(*reversed(cases.columns)).write.mode("append").option("header", True).csv(path)
    read = read_cases_csv(spark, path, infer=True, corrupt_column="bad")
    return read.where("bad IS NULL").select(F.col(KEY).cast("bigint").alias(KEY), *CASE_SCHEMA.names)


def parquet_scan_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "cases-parquet")
    cases_from_orders(spark, sf_dir).write.parquet(path)
    return read_cases_parquet(spark, path).select(KEY, *CASE_SCHEMA.names)


# Preparation


def care_flags(spark, sf_dir):
    return derived(spark, sf_dir).select(KEY, "male", "icu", "ventilator")


def three_means(spark, sf_dir):
    return group_means(derived(spark, sf_dir))


def death_label(spark, sf_dir):
    return derived(spark, sf_dir).select(KEY, LABEL)


def age_as_computed(spark, sf_dir):
    return prepared(spark, sf_dir).select(KEY, "age")


def day_gaps(spark, sf_dir):
    return derived(spark, sf_dir).select(KEY, "days_to_admission", "days_to_diagnosis")


def fill_days_to_diagnosis(spark, sf_dir):
    return prepared(spark, sf_dir).select(KEY, "days_to_diagnosis")


def inputs_of(features, spark, sf_dir):
    inputs = model_inputs(prepared(spark, sf_dir), features)
    values = vector_to_array("features")
    return inputs.select(KEY, *[values[i].alias(name) for i, name in enumerate(FEATURE_SETS[features])], LABEL)


def impute_age_by_sex(spark, sf_dir):
    cases = derived(spark, sf_dir)
    imputer = GroupMeanImputer(inputCol="age", outputCol="age", groupCols=["male"], meanCol="age_of_stated_sex")
    return imputer.fit(cases).transform(cases).select(KEY, "age")


def events_with_gaps(spark, sf_dir):
    """Readings below the detection limit count as missing."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "event_type", "user_id", "value")
    return events.withColumn("value", F.when(F.col("value") >= 5.0, F.col("value")))


def impute_event_value(spark, sf_dir):
    events = events_with_gaps(spark, sf_dir)
    imputer = GroupMeanImputer(inputCol="value", outputCol="value", groupCols=["event_type"])
    return imputer.fit(events).transform(events).select("event_id", "event_type", rounded("value"))


def impute_event_value_many_groups(spark, sf_dir):
    """As above by user, with a broadcast bound so low that the means meet the events in a shuffle.

    Users without any value get the mean over all.
    """
    events = events_with_gaps(spark, sf_dir)
    imputer = GroupMeanImputer(
        inputCol="value", outputCol="value", groupCols=["user_id"], broadcastGroups=2, unknownMean="overall"
    )
    return imputer.fit(events).transform(events).select("event_id", "user_id", rounded("value"))


# Parts, folds and profiles


def parted(spark, sf_dir):
    return with_split(complete_rows(prepared(spark, sf_dir)))


def part_counts(spark, sf_dir):
    counts = F.count(F.lit(1)).alias("n"), F.sum(LABEL).cast("bigint").alias("deaths")
    return parted(spark, sf_dir).groupBy("split").agg(*counts)


def fold_counts(spark, sf_dir):
    counts = F.count(F.lit(1)).alias("n"), F.sum(LABEL).cast("bigint").alias("deaths")
    return parted(spark, sf_dir).where(F.col("split") == "train").groupBy("fold").agg(*counts)


def random_split_cover(spark, sf_dir):
    """The drawn parts of a run: every case in one of them, and each part at its share within four deviations."""
    drawn = with_split(complete_rows(prepared(spark, sf_dir)), "random").select(KEY, "split")
    per_case = drawn.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("times"), *[F.sum((F.col("split") == part).cast("int")).alias(part) for part in PARTS]
    )
    n = F.sum("times")
    kept = [F.abs(F.sum(part) / n - share) <= 4 * F.sqrt(share * (1 - share) / n) for part, share in PARTS.items()]
    return per_case.agg(
        F.count(F.lit(1)).alias("cases"),
        n.alias("rows"),
        F.max("times").alias("most_parts_of_a_case"),
        (kept[0] & kept[1] & kept[2]).alias("shares_kept"),
    )


def case_profiles(spark, sf_dir):
    return count_profiles(parted(spark, sf_dir), ["split", "fold", *BASE_FEATURES, LABEL])


def search_plan(spark, sf_dir):
    points = [(m, i, point_text(p)) for m, axes in FULL.items() for i, p in enumerate(grid_points(axes))]
    return reports.search_plan(parted(spark, sf_dir).where(F.col("split") == "train"), points)


# Evaluation: the ICU flag as the prediction of death, and a ten-class rule over the embeddings


def icu_rule(spark, sf_dir):
    return parted(spark, sf_dir).withColumn("prediction", F.col("icu").cast("double"))


def largest_entry_rule(spark, sf_dir):
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    largest = F.array_position("embedding", F.array_max("embedding")) - 1
    return embeddings.select(F.col("label").cast("double").alias("label"), (largest % 10).alias("prediction"))


def confusion_of(rule, keys, spark, sf_dir):
    return confusion(rule(spark, sf_dir), keys)


def metrics_of(rule, keys, spark, sf_dir):
    metrics = weighted_metrics(confusion(rule(spark, sf_dir), keys), keys)
    return metrics.select(*keys, *[rounded(name) for name in METRICS])


def metrics_by_name(spark, sf_dir):
    metrics = weighted_metrics(confusion(icu_rule(spark, sf_dir), ["split"]), ["split"])
    return metrics_long(metrics, ["split"]).select("split", "metric", rounded("value"))


def matrix_of_confusion(spark, sf_dir):
    return confusion_matrix(confusion(icu_rule(spark, sf_dir)), [0.0, 1.0])


def selection_metric(spark, sf_dir):
    """The F1 by which a search chooses, from Spark's evaluator over counted predictions."""
    counts = confusion(icu_rule(spark, sf_dir))
    return small_table(spark, [(f1_evaluator("n").evaluate(counts),)], "f1 double").select(rounded("f1"))


def evaluation_report(spark, sf_dir):
    counts = confusion(icu_rule(spark, sf_dir).where(F.col("split") != "train"), ["split"])
    rows = counts.collect()  # one row per part and pair of classes
    counts = small_table(spark, rows, counts.schema)
    metrics = {row["split"]: row for row in weighted_metrics(counts, ["split"]).collect()}
    sections = [
        (part.capitalize(), [(r.label, r.prediction, r.n) for r in rows if r["split"] == part], metrics[part])
        for part in ("test", "validation")
    ]
    path = scratch_path(spark, "report")
    write_report(spark, report_lines("icu rule", sections), path)
    return spark.read.text(path).withColumnRenamed("value", "Text")


def base_rates(spark, sf_dir):
    return reports.base_rates(complete_rows(prepared(spark, sf_dir)))


# Models whose answers are known in closed form, fitted on all confirmed cases with the ICU flag as the only input


PROFILE = [*BASE_FEATURES, LABEL]


def icu_rows(name, cases, columns=()):
    """Training rows as a run makes them, from counts over all features, but with the ICU flag as the only input."""
    checkpoint_dir(cases.sparkSession)
    profiles = staged(count_profiles(cases, [*PROFILE, *columns]), "profiles")
    total, distinct = profiles.agg(F.sum(COUNT), F.count(F.lit(1))).first()
    rows = VectorAssembler(inputCols=["icu"], outputCol="features").transform(laid_out(profiles, total, distinct, name))
    return rows.select("features", LABEL, WEIGHT, *columns)


def fitted(name, rows, **params):
    rows = rows.persist()
    try:
        return estimator(name, WEIGHT, **params).fit(rows)
    finally:
        rows.unpersist()


def fitted_on_icu(name, spark, sf_dir, **params):
    """The fitted model, and the two levels of its input to score."""
    cases = derived(spark, sf_dir)
    levels = VectorAssembler(inputCols=["icu"], outputCol="features").transform(cases.select("icu").distinct())
    return fitted(name, icu_rows(name, cases), **params), levels


def forest_stump(spark, sf_dir):
    model, levels = fitted_on_icu("rf", spark, sf_dir, numTrees=1, maxDepth=1, bootstrap=False)
    return model.transform(levels).select("icu", F.round(vector_to_array("probability")[1], DIGITS).alias("p"))


def forest_counted(spark, sf_dir):
    """What the trees of a forest on counted rows draw: the death rate of each level of care, tree by tree.

    A tree's rate is that of about as many cases drawn with replacement, so over the trees its mean and its deviation are
    known, up to the error of 200 trees (four deviations of it).
    """
    cases, trees = derived(spark, sf_dir), 200
    rows = with_draws(count_profiles(cases, ["icu", LABEL]), COUNT, ["icu", LABEL], 7, draws=trees)
    drawn = rows.select("icu", LABEL, F.posexplode("draws").alias("tree", "draw")).groupBy("icu", "tree")
    drawn = drawn.agg((F.sum(F.col("draw") * F.col(LABEL)) / F.sum("draw")).alias("rate"))
    over_trees = drawn.groupBy("icu").agg(F.avg("rate").alias("mean"), F.stddev("rate").alias("spread"))
    known = cases.groupBy("icu").agg(F.count(F.lit(1)).alias("n"), F.avg(LABEL).alias("p"))
    deviation = F.sqrt(F.col("p") * (1 - F.col("p")) / F.col("n"))
    return over_trees.join(known, "icu").select(
        "icu",
        (F.abs(F.col("mean") - F.col("p")) <= 4 * deviation / trees**0.5).alias("mean_kept"),
        F.col("spread").between(0.8 * deviation, 1.2 * deviation).alias("spread_kept"),
    )


def logit_intercept(spark, sf_dir):
    model, levels = fitted_on_icu("lr", spark, sf_dir, elasticNetParam=1.0, regParam=10.0)
    return levels.select("icu", F.round(F.lit(float(model.intercept)), DIGITS).alias("intercept"))


def logit_saturated(spark, sf_dir):
    model, levels = fitted_on_icu("lr", spark, sf_dir, tol=1e-12, maxIter=200)
    margin = vector_to_array("rawPrediction")[1]
    return model.transform(levels).select("icu", F.round(margin, 4).alias("margin"))


def boost_stump(spark, sf_dir):
    model, levels = fitted_on_icu("gbt", spark, sf_dir, maxIter=1, maxDepth=1)
    # One round fits the labels as -1 and +1, so a level's margin is the mean of those, 2p - 1.
    return model.transform(levels).select("icu", F.round(vector_to_array("rawPrediction")[1], DIGITS).alias("margin"))


def boost_counted_stump(spark, sf_dir):
    """The same stump with split candidates from the counted cases and its split set back to the value of the flag."""
    model, levels = fitted_on_icu("gbt", spark, sf_dir, maxIter=1, maxDepth=1, counted_candidates=True)
    return model.transform(levels).select("icu", F.round(vector_to_array("rawPrediction")[1], DIGITS).alias("margin"))


def split_candidates(spark, sf_dir):
    """Where boosted trees may split the age and the days to admission: quantiles of the cases, learned from counts."""
    inputs = ["age", "days_to_admission"]
    counted = count_profiles(derived(spark, sf_dir).dropna(subset=inputs), inputs)
    rows = VectorAssembler(inputCols=inputs, outputCol="features").transform(counted)
    return candidate_borders(rows, "features", F.col(COUNT).cast("double"), bins=16)


def svm_majority(spark, sf_dir):
    """Without regularisation a level's hinge loss is least on its majority's side.

    The solver approaches the best margins, -1 and +1, only slowly where the loss is flat, so the side is what counts.
    """
    model, levels = fitted_on_icu("svm", spark, sf_dir, maxIter=50, regParam=0.0)
    return model.transform(levels).select("icu", "prediction")


def svm_hinge(spark, sf_dir):
    """The mean hinge loss that the machine reaches, against the least there is: twice each level's smaller share."""
    model, _ = fitted_on_icu("svm", spark, sf_dir, maxIter=200, regParam=0.0, tol=1e-9)
    slope, intercept = float(model.coefficients[0]), float(model.intercept)
    cases = derived(spark, sf_dir)
    loss = F.greatest(F.lit(0.0), 1 - (2 * F.col(LABEL) - 1) * (F.col("icu") * slope + intercept))
    per_level = cases.groupBy("icu").agg(F.count(F.lit(1)).alias("n"), F.sum(LABEL).alias("d"), F.sum(loss).alias("loss"))
    least = F.sum(2 * F.least(F.col("d"), F.col("n") - F.col("d"))) / F.sum("n")
    return per_level.agg(
        F.round(least, DIGITS).alias("least"), (F.sum("loss") / F.sum("n") <= 1.01 * least).alias("reached")
    )


def svm_on_counts(spark, sf_dir):
    """The objective over five features that fits on counts reach, against that of a fit on the single cases.

    The counts are staged, and both tables dealt over as many partitions as their rows ask for, so that no task holds more
    of either as the input grows. The fits are over a thousand very short jobs, so partitions are as large as a fit's may be.
    """
    cases = staged(complete_rows(derived(spark, sf_dir)).select(*PROFILE), "cases")
    profiles = staged(count_profiles(cases, PROFILE), "profiles")
    total, distinct = profiles.agg(F.sum(COUNT), F.count(F.lit(1))).first()
    inputs, penalty = VectorAssembler(inputCols=BASE_FEATURES, outputCol="features"), 0.1
    weighted = profiles.withColumn(WEIGHT, F.col(COUNT).cast("double"))
    counted = inputs.transform(in_stable_order(weighted, full_partitions(distinct))).persist()
    single = inputs.transform(dealt_evenly(cases, full_partitions(total or 0))).persist()
    deviations = frequency_deviations(counted, "features", WEIGHT)

    def reached(model):
        return hinge_objective(counted, model, penalty, deviations, LABEL, "features", F.col(WEIGHT))

    try:
        on_counts = reached(estimator("svm", WEIGHT, starts=3, regParam=penalty, maxIter=60).fit(counted))
        on_cases = reached(estimator("svm", regParam=penalty, maxIter=60).fit(single))
    finally:
        counted.unpersist()
        single.unpersist()
    return cases.agg(F.count(F.lit(1)).alias("n"), F.lit(bool(on_counts <= 1.01 * on_cases)).alias("reached"))


def svm_score_consistency(spark, sf_dir):
    """Batch scores of every complete case against the sign of the plane that the model reports."""
    inputs = model_inputs(prepared(spark, sf_dir))
    profiles = count_profiles(complete_rows(prepared(spark, sf_dir)), PROFILE).withColumn("fold", F.lit(0))
    profiles = staged(profiles, "profiles")
    total, distinct = profiles.agg(F.sum(COUNT), F.count(F.lit(1))).first()
    model = fitted("svm", training_rows(profiles, total, distinct, "svm"), maxIter=5, regParam=0.1)
    values = vector_to_array("features")
    plane = sum((values[i] * float(w) for i, w in enumerate(model.coefficients)), F.lit(float(model.intercept)))
    wrong = F.when((plane > 0).cast("double") != F.col("prediction"), 1).otherwise(0)
    return model.transform(inputs).agg(F.count(F.lit(1)).alias("n"), F.sum(wrong).alias("mismatches"))


def searched_on_icu(spark, sf_dir, grid, name="lr", **params):
    training_part = with_split(derived(spark, sf_dir)).where(F.col("split") == "train")
    rows = icu_rows(name, training_part, ["fold"]).persist()
    try:
        tuning = search(rows, name, grid, weight=WEIGHT, parallelism=4, **params).tuning
    finally:
        rows.unpersist()
    table = small_table(spark, tuning, SCHEMAS["tuning"])
    return table.select("point", "params", rounded("avg_f1"), rounded("std_f1"), "best")


def cross_validation_majority(spark, sf_dir):
    """Penalties that leave only the intercept: every fold predicts survival, and all points tie, so the first wins."""
    return searched_on_icu(spark, sf_dir, {"elasticNetParam": [1.0], "regParam": [10.0, 20.0]})


def cross_validation_winner(spark, sf_dir):
    """Of a point that leaves only the intercept and one without penalty the second wins: it follows the ICU flag."""
    return searched_on_icu(spark, sf_dir, {"elasticNetParam": [1.0], "regParam": [10.0, 0.0], "tol": [1e-9]})


def search_resumed(spark, sf_dir):
    """The search of `cross_validation_winner` when the scores of its first point are in the journal already."""
    journal = SearchJournal(spark, scratch_path(spark, "search"))
    first = {"elasticNetParam": [1.0], "regParam": [10.0], "tol": [1e-9]}
    searched_on_icu(spark, sf_dir, first, journal=journal)
    return searched_on_icu(spark, sf_dir, first | {"regParam": [10.0, 0.0]}, journal=journal)


def search_forest_winner(spark, sf_dir):
    """A tree without a split predicts survival; one with a split follows the ICU flag and wins."""
    return searched_on_icu(spark, sf_dir, {"numTrees": [1], "maxDepth": [0, 1]}, "rf", bootstrap=False)


def search_boosted_winner(spark, sf_dir):
    """As for the forest, with one round of boosting, whose margins have the sign of a level's majority."""
    return searched_on_icu(spark, sf_dir, {"maxIter": [1], "maxDepth": [0, 1]}, "gbt")


def search_svm_winner(spark, sf_dir):
    """A penalty that leaves only the intercept against none, which takes each level's majority side."""
    return searched_on_icu(spark, sf_dir, {"maxIter": [5], "regParam": [10.0, 0.0], "tol": [0.01]}, "svm")


# Runs


def saved_model_scores(spark, sf_dir):
    """A stump saved, loaded and applied to every confirmed case."""
    model, _ = fitted_on_icu("rf", spark, sf_dir, numTrees=1, maxDepth=1, bootstrap=False)
    path = scratch_path(spark, "model")
    save_model(model, path)
    cases = VectorAssembler(inputCols=["icu"], outputCol="features").transform(derived(spark, sf_dir))
    scores = with_scores(load_model("rf", path), cases)
    return scores.select(KEY, LABEL, "prediction", rounded("probability"))


def smoke_run(spark, sf_dir, models, features="base", age_rule="keep_known"):
    paths = RunPaths(scratch_path(spark, "run"), "smoke", features)
    settings = TrainingSettings(models=models, grids=SMOKE, features=features, age_rule=age_rule, parallelism=4)
    train(spark, cases_from_orders(spark, sf_dir), paths, settings)
    return paths


def stored_results(spark, paths):
    """Per model and part its cases and deaths, and how many stored metrics differ from those of the stored confusion."""
    keys = ["model", "dataset"]
    counts = read_table(spark, paths, "confusion")
    expected = metrics_long(weighted_metrics(counts, keys), keys).withColumnRenamed("value", "expected")
    stored = read_table(spark, paths, "metrics").select(*keys, "metric", "value")
    differs = F.coalesce(F.abs(F.col("value") - F.col("expected")) > 1e-9, F.lit(True)).cast("int")
    compared = stored.join(expected, [*keys, "metric"], "full").groupBy(*keys)
    compared = compared.agg(F.count(F.lit(1)).alias("metrics"), F.sum(differs).alias("mismatches"))
    deaths = F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("deaths")
    return counts.groupBy(*keys).agg(F.sum("n").alias("n"), deaths).join(compared, keys)


def training_run(spark, sf_dir):
    return stored_results(spark, smoke_run(spark, sf_dir, ["rf", "lr", "svm", "gbt"]))


def training_run_with_diagnosis(spark, sf_dir):
    return stored_results(spark, smoke_run(spark, sf_dir, ["lr", "rf"], "with_diagnosis", "as_computed"))


TUNED_GRIDS = {
    "rf": {"impurity": ["entropy"], "seed": [512], "numTrees": [3]},
    "lr": {"maxIter": [20], "elasticNetParam": [0.5], "regParam": [0.2], "tol": [0.1]},
    "svm": {"maxIter": [3], "regParam": [0.4], "tol": [0.2]},
    "gbt": {"maxIter": [2], "seed": [1024], "stepSize": [0.2]},
}


def tuned_parameters(spark, sf_dir):
    """Grids of one point each, read back from the models that were saved."""
    paths = RunPaths(scratch_path(spark, "run"), "tuned")
    train(spark, cases_from_orders(spark, sf_dir), paths, TrainingSettings(grids=TUNED_GRIDS, parallelism=4))
    return tuned_params(spark, paths, list(TUNED_GRIDS))


def scored_cases(spark, sf_dir):
    """Every complete case, and whether its prediction lies off its margin's side."""
    paths = smoke_run(spark, sf_dir, ["gbt"])
    scores = score_cases(spark, cases_from_orders(spark, sf_dir), paths, "gbt")
    off = (F.col("margin") > 0).cast("double") != F.col("prediction")
    return scores.select(KEY, LABEL, off.cast("int").alias("off_side"))


# Whole runs with penalties that leave only the intercept, so that every output has a closed form


MAJORITY_GRIDS = {
    "rf": {"impurity": ["gini"], "seed": [512, 1024], "numTrees": [2]},
    "lr": {"maxIter": [100, 300], "elasticNetParam": [1.0], "regParam": [10.0, 20.0], "tol": [0.1, 0.2]},
    "svm": {"maxIter": [20, 30], "regParam": [100.0], "tol": [0.1]},
    "gbt": {"maxIter": [1, 2], "seed": [1024], "stepSize": [0.2]},
}
NO_SPLITS = {"rf": {"maxDepth": 0}, "gbt": {"maxDepth": 0}}


def majority_run(spark, sf_dir, features="base", models=("rf", "lr", "svm", "gbt")):
    paths = RunPaths(scratch_path(spark, "run"), "majority", features)
    settings = TrainingSettings(
        models=list(models), grids=MAJORITY_GRIDS, features=features, parallelism=4, params=NO_SPLITS
    )
    train(spark, cases_from_orders(spark, sf_dir), paths, settings)
    return paths


def stamped_runs(spark, sf_dir):
    """Two runs begun in the same minute under the default stamp: each has its own folders and results."""
    base, cases = scratch_path(spark, "run"), cases_from_orders(spark, sf_dir)

    def run(_):
        train(spark, cases, claim_run(spark, base), TrainingSettings(models=["lr"], grids=SMOKE))

    with ThreadPool(2) as pool:
        pool.map(inheritable_thread_target(spark)(run), range(2))
    stored = read_table(spark, RunPaths(base), "metrics").groupBy("dataset", "metric")
    same = (F.min("value") == F.max("value")).alias("agree")
    return stored.agg(F.count_distinct("run_id").alias("runs"), F.count(F.lit(1)).alias("n"), same)


def majority_run_metrics(spark, sf_dir):
    metrics = read_table(spark, majority_run(spark, sf_dir), "metrics")
    return metrics.select("run_id", "features", "model", "dataset", "metric", rounded("value"))


def majority_run_confusion(spark, sf_dir):
    return read_table(spark, majority_run(spark, sf_dir, "with_diagnosis"), "confusion")


def majority_run_leaderboard(spark, sf_dir):
    board = reports.leaderboard(read_table(spark, majority_run(spark, sf_dir), "metrics"))
    return board.select("run_id", "features", "model", *[rounded(name) for name in METRICS])


def majority_run_parameters(spark, sf_dir):
    """All points tie, so the parameters of the first one come back from the saved models."""
    return tuned_params(spark, majority_run(spark, sf_dir), list(MAJORITY_GRIDS))


def majority_run_scores(spark, sf_dir):
    scores = score_cases(spark, cases_from_orders(spark, sf_dir), majority_run(spark, sf_dir, models=["lr"]), "lr")
    return scores.select(KEY, LABEL, "prediction", rounded("margin"), rounded("probability"), "model")


QUERIES = {
    "csv_scan_roundtrip": csv_scan_roundtrip,
    "csv_scan_inferred": csv_scan_inferred,
    "csv_scan_other_headers": csv_scan_other_headers,
    "parquet_scan_roundtrip": parquet_scan_roundtrip,
    "confirmed_cases": confirmed,
    "care_flags": care_flags,
    "group_means": three_means,
    "death_label": death_label,
    "age_as_computed": age_as_computed,
    "day_gaps": day_gaps,
    "fill_days_to_diagnosis": fill_days_to_diagnosis,
    "prepared_as_computed": prepared,
    "model_inputs_base": partial(inputs_of, "base"),
    "model_inputs_with_diagnosis": partial(inputs_of, "with_diagnosis"),
    "impute_age_by_sex": impute_age_by_sex,
    "impute_event_value": impute_event_value,
    "impute_event_value_many_groups": impute_event_value_many_groups,
    "split_counts": part_counts,
    "fold_counts": fold_counts,
    "random_split_cover": random_split_cover,
    "case_profiles": case_profiles,
    "search_plan": search_plan,
    "confusion": partial(confusion_of, icu_rule, []),
    "confusion_by_split": partial(confusion_of, icu_rule, ["split"]),
    "confusion_matrix": matrix_of_confusion,
    "confusion_multiclass": partial(confusion_of, largest_entry_rule, []),
    "metrics": partial(metrics_of, icu_rule, []),
    "metrics_by_split": partial(metrics_of, icu_rule, ["split"]),
    "metrics_multiclass": partial(metrics_of, largest_entry_rule, []),
    "metrics_by_name": metrics_by_name,
    "selection_metric": selection_metric,
    "evaluation_report": evaluation_report,
    "base_rates": base_rates,
    "forest_stump": forest_stump,
    "forest_counted": forest_counted,
    "logit_intercept": logit_intercept,
    "logit_saturated": logit_saturated,
    "boost_stump": boost_stump,
    "boost_counted_stump": boost_counted_stump,
    "split_candidates": split_candidates,
    "svm_majority": svm_majority,
    "svm_hinge": svm_hinge,
    "svm_on_counts": svm_on_counts,
    "svm_score_consistency": svm_score_consistency,
    "cross_validation_majority": cross_validation_majority,
    "cross_validation_winner": cross_validation_winner,
    "search_resumed": search_resumed,
    "search_forest_winner": search_forest_winner,
    "search_boosted_winner": search_boosted_winner,
    "search_svm_winner": search_svm_winner,
    "saved_model_scores": saved_model_scores,
    "stamped_runs": stamped_runs,
    "majority_run_metrics": majority_run_metrics,
    "majority_run_confusion": majority_run_confusion,
    "majority_run_leaderboard": majority_run_leaderboard,
    "majority_run_parameters": majority_run_parameters,
    "majority_run_scores": majority_run_scores,
    "training_run": training_run,
    "training_run_with_diagnosis": training_run_with_diagnosis,
    "tuned_parameters": tuned_parameters,
    "scored_cases": scored_cases,
}
