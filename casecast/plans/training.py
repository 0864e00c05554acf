"""The training job: one pass over the cases, then a search per model over weighted rows."""

from dataclasses import dataclass, field, replace
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from casecast.models.grids import MODELS, PRESETS
from casecast.models.search import SearchResult, search
from casecast.operators.evaluate import METRICS, confusion, weighted_metrics
from casecast.operators.impute import AsComputedAge, GroupMeanImputer
from casecast.operators.prepare import assembler, complete_rows, confirmed_cases, derive
from casecast.operators.profiles import COUNT, count_profiles, in_stable_order, weighted_blocks
from casecast.operators.split import with_split
from casecast.schema import FEATURE_SETS, KEY, LABEL, WEIGHT
from casecast.session import checkpoint_dir, small_table
from casecast.sinks.journal import SearchJournal
from casecast.sinks.manifest import check_same, describe, read_manifest, write_manifest
from casecast.sinks.model_store import load_model, save_model
from casecast.sinks.paths import RunPaths, is_written
from casecast.sinks.report import report_lines, write_report
from casecast.sinks.tables import SCHEMAS, write_part

# Rows that make a partition worth its task: a linear fit is hundreds of very short jobs, a tree fit is a few long ones.
ROWS_PER_PARTITION = {"lr": 1_000, "svm": 1_000, "rf": 5_000, "gbt": 1_000}
# From as many partitions on they grow instead of becoming more, up to as many rows.
MANY_PARTITIONS, MAX_ROWS_PER_PARTITION = {"lr": 8, "svm": 8, "rf": 64, "gbt": 16}, 200_000

# Parameters of boosted trees that count rows, which stand for many cases each.
COUNTING_ROWS = ("minInstancesPerNode", "subsamplingRate")

HELD_OUT = ["test", "validation"]


@dataclass
class TrainingSettings:
    """What a run does.

    `age_rule` is `keep_known` or `as_computed`, `means_from` is `train` or `all`, `split` is `hash` or `random`.
    The second choice of each is what `as_published` sets: known ages are overwritten, the means see the held-out
    cases, and parts and folds are drawn at random. `parallelism` is the number of concurrent fits of one model's
    search, of which `models_at_once` run side by side.

    `unknown_mean` says what fills a case of unknown age where its sex has no known age at all: `error`, or `overall`
    for the mean over everyone.

    `forest_blocks` bounds the rows a forest is fitted on: equal cases are put together into about so many blocks,
    which the bootstrap then draws whole, so a forest of blocks is another forest than one of cases, whatever the
    number of cases. Without it, as by default and as published, forests draw single cases.

    `forest_rows` is `cases`, or `counts` for forests that are fitted on the counted rows and draw each of the cases they
    count (`models/forests.py`): the same law as on cases, on rows bounded by the distinct combinations.

    `boost_candidates` is `rows`, or `counts` for boosted trees whose split candidates are quantiles of the counted cases
    (`models/boosted.py`): the trees that as many cases would give, also beyond 10,000 rows, where Spark looks at a sample.

    `svm_starts` is how often the solver of a support vector machine is run for a model, of which the best is kept
    (`models/estimators.py`).

    `resume` takes up a run that broke off, which must have been begun with the same settings on the same input: profiles
    that were written completely are used again, models whose metrics were published are loaded, and the others go on at
    the first point of a fold that has no score in the search's journal.
    """

    models: list = field(default_factory=lambda: list(MODELS))
    grids: dict = field(default_factory=lambda: PRESETS["small"])
    features: str = "base"
    age_rule: str = "keep_known"
    means_from: str = "train"
    split: str = "hash"
    key: str = KEY
    parallelism: int = 2
    models_at_once: int = 4
    unknown_mean: str = "error"
    forest_blocks: int = None
    forest_rows: str = "cases"
    boost_candidates: str = "rows"
    svm_starts: int = 1
    resume: bool = False
    params: dict = field(default_factory=dict)

    @classmethod
    def as_published(cls, **settings):
        return cls(
            **{"grids": PRESETS["full"], "age_rule": "as_computed", "means_from": "all", "split": "random"} | settings
        )

    def check(self):
        """Raise if any setting cannot be carried out, before anything is read."""
        choices = {
            "features": (self.features, FEATURE_SETS),
            "age_rule": (self.age_rule, ["keep_known", "as_computed"]),
            "means_from": (self.means_from, ["train", "all"]),
            "split": (self.split, ["hash", "random"]),
            "unknown_mean": (self.unknown_mean, ["error", "overall"]),
            "forest_rows": (self.forest_rows, ["cases", "counts"]),
            "boost_candidates": (self.boost_candidates, ["rows", "counts"]),
        }
        for name, (value, known) in choices.items():
            if value not in known:
                raise ValueError(f"unknown {name.replace('_', ' ')} {value!r}, not one of {sorted(known)}")
        if not self.models:
            raise ValueError("no model is named")
        for name in self.models:
            if name not in MODELS:
                raise ValueError(f"unknown model {name!r}, not one of {sorted(MODELS)}")
            if not self.grids.get(name):
                raise ValueError(f"no grid for the model {name!r}")
        counting = [name for name in COUNTING_ROWS if name in {**self.params.get("gbt", {}), **self.grids.get("gbt", {})}]
        if "gbt" in self.models and counting:
            raise ValueError(f"boosted trees are fitted on counted rows, which {counting} would take for cases")
        if self.svm_starts < 1:
            raise ValueError("svm_starts is a number of runs of the solver")
        if self.forest_blocks is not None and self.forest_blocks < 1:
            raise ValueError("forest_blocks is a number of blocks")
        if self.forest_blocks is not None and self.forest_rows == "counts":
            raise ValueError("forests are fitted on blocks or on counts, not both")


def profile_columns(features):
    return ["split", "fold", *FEATURE_SETS[features], "age_of_stated_sex", LABEL]


def case_profiles(cases, settings):
    """Counts of equal confirmed cases per part and fold: the only pass over the cases themselves."""
    derived = derive(confirmed_cases(cases, settings.key), settings.key)
    return count_profiles(with_split(derived, settings.split, settings.key), profile_columns(settings.features))


def staged_profiles(spark, cases, paths, settings):
    """Count the cases into the run folder and go on from there. What the run is begun with is written first, and a run
    that is resumed must be the same."""
    counted = case_profiles(cases, settings)
    manifest = describe(cases, settings)
    if settings.resume and is_written(spark, paths.profiles):
        begun = read_manifest(spark, paths.manifest)
        check_same(begun, manifest, paths.root)
        if begun["models"] != (known := begun["models"] | manifest["models"]):
            write_manifest(spark, manifest | {"models": known}, paths.manifest, "overwrite")
    else:
        write_manifest(spark, manifest, paths.manifest, "overwrite" if settings.resume else "errorifexists")
        # What a broken run left of them is no use.
        counted.write.mode("overwrite" if settings.resume else "errorifexists").parquet(paths.profiles)
    return spark.read.schema(counted.schema).parquet(paths.profiles)


def fit_preparation(profiles, settings):
    """Learn the imputation from counted profiles, as a pipeline that also assembles the feature vector."""
    if settings.age_rule == "keep_known":
        age = GroupMeanImputer(
            inputCol="age",
            outputCol="age",
            groupCols=["male"],
            meanCol="age_of_stated_sex",
            weightCol=COUNT,
            unknownMean=settings.unknown_mean,
        )
    else:
        age = AsComputedAge(weightCol=COUNT)
    stages = [age]
    if settings.features == "with_diagnosis":
        gap = "days_to_diagnosis"
        stages.append(GroupMeanImputer(inputCol=gap, outputCol=gap, weightCol=COUNT))
    seen = profiles if settings.means_from == "all" else profiles.where(F.col("split") == "train")
    return Pipeline(stages=[*stages, assembler(settings.features)]).fit(seen)


def complete_profiles(profiles, preparation, settings):
    """Profiles with their gaps filled and incomplete ones dropped, added up again where filling made them equal."""
    imputation = PipelineModel(preparation.stages[:-1])
    inputs = FEATURE_SETS[settings.features]
    filled = complete_rows(imputation.transform(profiles), settings.features)
    return count_profiles(filled, ["split", "fold", *inputs, LABEL], COUNT)


def full_partitions(rows):
    """The fewest partitions for `rows` rows of which none is to hold more than a fit's may."""
    return max(1, -(-rows // MAX_ROWS_PER_PARTITION))


def fit_partitions(name, rows):
    """Partitions for a fit over `rows` rows: by the rows alone, so that a model does not depend on the cluster."""
    wanted = -(-rows // ROWS_PER_PARTITION[name])
    return max(min(wanted, MANY_PARTITIONS[name]), full_partitions(rows))


def laid_out(profiles, total, distinct, name, forest_blocks=None, forest_rows="cases"):
    """Counted profiles as weighted rows for one model, placed and ordered by their content.

    `total` is the number of cases the profiles stand for and `distinct` the number of profiles. Linear models and
    boosted trees take the counts whole: their sums are the same whether equal cases are one weighted row or many.
    Forests draw rows, so theirs are single cases, or blocks of them where that is asked for, unless they count.
    """
    if name == "rf" and forest_rows == "cases":
        rows = weighted_blocks(profiles, total, forest_blocks)
        expected = min(total, distinct + forest_blocks) if forest_blocks else total
    else:
        rows, expected = profiles.withColumn(WEIGHT, F.col(COUNT).cast("double")).drop(COUNT), distinct
    return in_stable_order(rows, fit_partitions(name, expected))


def training_rows(profiles, total, distinct, name, features="base", forest_blocks=None, forest_rows="cases"):
    """The rows of `laid_out` as `features`, `label`, `fold` and `weight`."""
    placed = laid_out(profiles, total, distinct, name, forest_blocks, forest_rows)
    return assembler(features).transform(placed).select("features", LABEL, "fold", WEIGHT)


def train_model(profiles, total, distinct, name, settings, journal=None) -> SearchResult:
    """Search one model's grid. Folds come with the rows, so that equal cases need not share one."""
    train = training_rows(profiles, total, distinct, name, settings.features, settings.forest_blocks, settings.forest_rows)
    counted = {"counted_forest": True} if name == "rf" and settings.forest_rows == "counts" else {}
    if name == "gbt" and settings.boost_candidates == "counts":
        counted = {"counted_candidates": True}
    if name == "svm":
        counted = {"starts": settings.svm_starts}
    train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return search(
            train,
            name,
            settings.grids[name],
            weight=WEIGHT,
            parallelism=settings.parallelism,
            journal=journal,
            **counted,
            **settings.params.get(name, {}),
        )
    finally:
        train.unpersist()


def evaluate_model(model, held_out, features="base"):
    """Confusion counts of the held-out parts. Equal cases get equal predictions, so each profile is scored once."""
    scored = model.transform(assembler(features).transform(held_out))
    return confusion(scored.withColumnRenamed("split", "dataset"), ["dataset"], COUNT)


def write_evaluation(spark, paths, name, model, counts, mode="errorifexists"):
    """Report, confusion table and metrics table of one model. The metrics come last: they say that a model is done."""
    rows = counts.collect()  # one row per part and pair of classes
    counts = small_table(spark, rows, SCHEMAS["confusion"])
    metrics = weighted_metrics(counts, ["dataset"])
    by_part = {row["dataset"]: row for row in metrics.collect()}
    sections = [
        (part.capitalize(), [(r.label, r.prediction, r.n) for r in rows if r.dataset == part], by_part[part])
        for part in HELD_OUT
        if part in by_part
    ]
    write_report(spark, report_lines(type(model).__name__, sections), paths.report(name), mode)
    write_part(counts, paths, "confusion", name, mode)
    values = [(part, metric, row[metric]) for part, row in by_part.items() for metric in METRICS]
    write_part(small_table(spark, values, SCHEMAS["metrics"]), paths, "metrics", name, mode)


def checked(spark, settings):
    """The settings, or the defaults, once everything that a run needs is known to be there."""
    settings = settings or TrainingSettings()
    settings.check()
    checkpoint_dir(spark)
    return settings


def train(spark, cases, paths: RunPaths, settings: TrainingSettings = None):
    """Search, refit, evaluate and save every model of the settings. Returns the best models by name."""
    settings = checked(spark, settings)
    return train_counted(spark, staged_profiles(spark, cases, paths, settings), paths, settings)


def train_rounds(spark, cases, paths: RunPaths, settings: TrainingSettings = None, rounds=tuple(FEATURE_SETS)):
    """Train once per feature set, each below its own path, on a single count of the cases.

    The cases are counted by the largest set; the smaller ones add those counts up. Returns the models by round.
    """
    settings = checked(spark, settings)
    for features in rounds:
        replace(settings, features=features).check()
    widest = max(rounds, key=lambda features: len(FEATURE_SETS[features]))
    profiles = staged_profiles(spark, cases, replace(paths, features=widest), replace(settings, features=widest))
    best = {}
    for features in rounds:
        counted = profiles if features == widest else count_profiles(profiles, profile_columns(features), COUNT)
        best[features] = train_counted(
            spark, counted, replace(paths, features=features), replace(settings, features=features)
        )
    return best


def train_counted(spark, profiles, paths, settings):
    """The run from counted profiles on. A model is saved before anything of it is published."""
    preparation = fit_preparation(profiles, settings)
    save_model(preparation, paths.preparation, overwrite=settings.resume)
    mode = "overwrite" if settings.resume else "errorifexists"
    complete = complete_profiles(profiles, preparation, settings).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        train_profiles = complete.where(F.col("split") == "train").drop("split")
        total, distinct = train_profiles.agg(F.sum(COUNT), F.count(F.lit(1))).first()
        if not total:
            raise ValueError("no complete confirmed case falls into the training part")
        held_out = complete.where(F.col("split").isin(HELD_OUT))

        def one_model(name):
            if settings.resume and is_written(spark, paths.table_part("metrics", name)):
                return name, load_model(name, paths.model(name))
            journal = SearchJournal(spark, paths.journal(name))
            result = train_model(train_profiles, total, distinct, name, settings, journal)
            save_model(result.model, paths.model(name), overwrite=settings.resume)
            write_part(small_table(spark, result.tuning, SCHEMAS["tuning"]), paths, "tuning", name, mode)
            counts = evaluate_model(result.model, held_out, settings.features)
            write_evaluation(spark, paths, name, result.model, counts, mode)
            return name, result.model

        # Counted rows are few, so a fit is a chain of short jobs that leaves most of a cluster to the other models.
        with ThreadPool(min(settings.models_at_once, len(settings.models))) as pool:
            return dict(pool.map(inheritable_thread_target(spark)(one_model), settings.models))
    finally:
        complete.unpersist()
