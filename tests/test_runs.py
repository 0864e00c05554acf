import shutil
from multiprocessing.pool import ThreadPool

import pytest
from pyspark.sql import functions as F

from casecast.__main__ import main
from casecast.models.grids import SMOKE, grid_points
from casecast.operators.evaluate import METRICS
from casecast.operators.prepare import confirmed_cases, derive
from casecast.plans.reports import leaderboard
from casecast.plans.scoring import score_cases, write_scores
from casecast.plans.training import TrainingSettings, train
from casecast.plans.training import case_profiles as original
from casecast.plans.training import count_profiles as original_count
from casecast.plans.training import train_model as original_fit
from casecast.sinks.journal import SearchJournal
from casecast.sinks.model_store import load_model, load_preparation, save_model, tuned_params
from casecast.sinks.paths import RunPaths, claim_run, new_run_id
from casecast.sinks.report import report_lines, write_report
from casecast.sinks.tables import read_table
from casecast.session import small_table
from casecast.sources import cases_from_orders

MODELS = ["rf", "lr", "svm", "gbt"]


@pytest.fixture(scope="module")
def cases(spark, sf_dir):
    return cases_from_orders(spark, sf_dir)


@pytest.fixture(scope="module")
def run(spark, cases, tmp_path_factory):
    paths = RunPaths(str(tmp_path_factory.mktemp("base")), "r1")
    best = train(spark, cases, paths, TrainingSettings(grids=SMOKE, parallelism=3))
    return paths, best


def test_metrics_and_confusion_of_every_model(spark, run, cases):
    paths, best = run
    assert list(best) == MODELS
    metrics = read_table(spark, paths, "metrics").collect()
    assert len(metrics) == 4 * 2 * len(METRICS) and {m.run_id for m in metrics} == {"r1"}
    assert all(0 <= m.value <= 1 for m in metrics)
    sizes = read_table(spark, paths, "confusion").groupBy("model", "dataset").agg(F.sum("n")).collect()
    assert {(dataset, n) for _, dataset, n in sizes} == {("test", 162), ("validation", 69)}


def test_tuning_has_every_grid_point(spark, run):
    paths, _ = run
    tuning = read_table(spark, paths, "tuning").collect()
    for name in MODELS:
        assert len([row for row in tuning if row.model == name]) == len(grid_points(SMOKE[name]))
        assert len([row for row in tuning if row.model == name and row.best]) == 1


def test_report_is_one_file_in_order(run):
    import glob

    paths, _ = run
    (part,) = glob.glob(f"{paths.report('rf')}/part-*")
    lines = open(part).read().splitlines()
    assert lines[0] == "How RandomForestClassificationModel did on held-out cases"
    assert lines.index("Test set") == 1 and lines.index("Validation set") == 1 + (len(lines) - 1) // 2
    assert [line.split(" ")[1] for line in lines[2:] if line.startswith("Test:")] == [
        "Confusion", "actual", "actual", "F1-Score", "Accuracy", "Weighted", "Weighted", "Weighted", "Weighted",
    ]


def test_loaded_models_predict_the_same(spark, run, cases):
    paths, best = run
    inputs = load_preparation(paths.preparation).transform(derive(confirmed_cases(cases)))
    for name, model in best.items():
        loaded = load_model(name, paths.model(name))
        a, b = (m.transform(inputs).select("case_id", "prediction", "rawPrediction").collect() for m in (model, loaded))
        assert sorted(map(str, a)) == sorted(map(str, b))


def test_scores_agree_with_the_counted_evaluation(spark, run, cases):
    """Scoring case by case gives the confusion that evaluation got from one prediction per profile."""
    from casecast.operators.evaluate import confusion
    from casecast.operators.split import with_split

    paths, _ = run
    for name in MODELS:
        scores = with_split(score_cases(spark, cases, paths, name)).where("split <> 'train'")
        by_case = confusion(scores.withColumnRenamed("split", "dataset"), ["dataset"])
        counted = read_table(spark, paths, "confusion").where(F.col("model") == name).select(by_case.columns)
        assert sorted(map(str, by_case.collect())) == sorted(map(str, counted.collect()))


def test_scores_are_written_once(spark, run, cases, tmp_path):
    paths, _ = run
    out = str(tmp_path / "scores")
    write_scores(spark, cases, paths, "gbt", out)
    written = spark.read.parquet(out)
    assert written.columns == ["case_id", "label", "prediction", "margin", "probability", "model"]
    assert written.count() == 812
    with pytest.raises(Exception, match="(?i)exists"):
        write_scores(spark, cases, paths, "gbt", out)
    plan = score_cases(spark, cases, paths, "gbt")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hash" not in plan and "SortMergeJoin" not in plan


def test_tuned_parameters_come_from_the_saved_models(spark, run):
    paths, _ = run
    params = {(row.model, row.param): row.value for row in tuned_params(spark, paths, MODELS).collect()}
    assert len(params) == 13
    assert params["rf", "numTrees"] == "10" and params["rf", "impurity"] == "gini"
    assert params["lr", "elasticNetParam"] == "0.15" and params["svm", "maxIter"] == "5"
    assert params["gbt", "maxIter"] in ("3", "5")


def test_leaderboard(spark, run):
    board = leaderboard(read_table(spark, run[0], "metrics")).collect()
    assert {row.model for row in board} == set(MODELS)
    assert [row.f1 for row in board] == sorted((row.f1 for row in board), reverse=True)


def test_nothing_is_overwritten_by_accident(spark, run, cases):
    paths, best = run
    with pytest.raises(Exception, match="(?i)exists"):
        train(spark, cases, paths, TrainingSettings(grids=SMOKE))
    with pytest.raises(Exception, match="(?i)exists"):
        save_model(best["lr"], paths.model("lr"))
    save_model(best["lr"], paths.model("lr"), overwrite=True)
    with pytest.raises(Exception, match="(?i)exists"):
        write_report(spark, report_lines("x", []), paths.report("lr"))


def test_published_settings_need_no_key(spark, cases, tmp_path):
    paths = RunPaths(str(tmp_path), "r2", "with_diagnosis")
    settings = TrainingSettings.as_published(models=["lr"], grids=SMOKE, features="with_diagnosis")
    best = train(spark, cases.drop("case_id"), paths, settings)
    assert best["lr"].numFeatures == 6
    sizes = read_table(spark, paths, "confusion").groupBy("dataset").agg(F.sum("n")).collect()
    assert 150 < sum(n for _, n in sizes) < 330
    ages = spark.read.parquet(paths.profiles)
    prepared = load_preparation(paths.preparation).transform(ages).select("age").distinct().collect()
    assert sorted(row.age for row in prepared) == [43.0, 59.0]


def test_forests_of_blocks_where_asked_for(spark, cases, tmp_path):
    paths = RunPaths(str(tmp_path), "r3")
    best = train(spark, cases, paths, TrainingSettings(models=["rf", "svm"], grids=SMOKE, forest_blocks=50))
    assert set(best) == {"rf", "svm"}
    assert sum(row.n for row in read_table(spark, paths, "confusion").collect()) == 2 * (162 + 69)


def test_settings_are_checked_before_anything_is_read(spark, cases, tmp_path):
    wrong = [
        {"models": ["lr", "tree"]},
        {"models": []},
        {"age_rule": "guessed"},
        {"split": "alphabetical"},
        {"means_from": "test"},
        {"features": "all"},
        {"unknown_mean": "zero"},
        {"grids": {"lr": SMOKE["lr"]}},
        {"params": {"gbt": {"minInstancesPerNode": 5}}},
        {"params": {"gbt": {"subsamplingRate": 0.5}}},
        {"forest_blocks": 0},
        {"forest_rows": "some"},
        {"forest_rows": "counts", "forest_blocks": 9},
        {"boost_candidates": "some"},
        {"svm_starts": 0},
    ]
    for settings in wrong:
        with pytest.raises(ValueError):
            train(spark, cases, RunPaths(str(tmp_path), "w"), TrainingSettings(**{"grids": SMOKE} | settings))
    assert not (tmp_path / "training").exists()


def test_a_model_that_cannot_be_saved_is_not_published(spark, cases, tmp_path, monkeypatch):
    from casecast.plans import training

    def full(model, path, **settings):
        if "/lr/" in path:
            raise OSError("disk full")
        return save_model(model, path, **settings)

    paths = RunPaths(str(tmp_path), "r6")
    settings = {"models": ["lr", "svm"], "grids": SMOKE}
    with monkeypatch.context() as patched:
        patched.setattr(training, "save_model", full)
        with pytest.raises(OSError, match="disk full"):
            train(spark, cases, paths, TrainingSettings(**settings))
    board = leaderboard(read_table(spark, paths, "metrics"))
    assert "lr" not in {row.model for row in board.collect()}
    counted = []
    monkeypatch.setattr(training, "count_profiles", lambda *args: counted.append(args[0]) or original_count(*args))
    fits = []
    monkeypatch.setattr(training, "train_model", lambda *args: fits.append(args[3]) or original_fit(*args))
    best = train(spark, cases, paths, TrainingSettings(**settings, resume=True))
    assert set(best) == {"lr", "svm"} and "svm" not in fits
    assert {row.model for row in leaderboard(read_table(spark, paths, "metrics")).collect()} == {"lr", "svm"}


def test_a_run_is_not_resumed_as_another(spark, cases, tmp_path):
    paths = RunPaths(str(tmp_path), "r7")
    settings = {"models": ["lr"], "grids": SMOKE}
    train(spark, cases, paths, TrainingSettings(**settings))
    for other, named in (
        ({"split": "random"}, "split"),
        ({"age_rule": "as_computed", "means_from": "all"}, "age_rule, means_from"),
        ({"grids": SMOKE | {"lr": SMOKE["lr"] | {"regParam": [0.7]}}}, "grid of lr"),
        ({"params": {"lr": {"fitIntercept": False}}}, "grid of lr"),
    ):
        with pytest.raises(ValueError, match=named):
            train(spark, cases, paths, TrainingSettings(**settings | other, resume=True))
    with pytest.raises(ValueError, match="input"):
        train(spark, cases.withColumn("more", F.lit(1)), paths, TrainingSettings(**settings, resume=True))
    both = train(spark, cases, paths, TrainingSettings(**settings | {"models": ["lr", "svm"]}, parallelism=3, resume=True))
    assert set(both) == {"lr", "svm"}
    with pytest.raises(ValueError, match="grid of svm"):
        grids = SMOKE | {"svm": SMOKE["svm"] | {"maxIter": [4]}}
        train(spark, cases, paths, TrainingSettings(models=["svm"], grids=grids, resume=True))
    shutil.rmtree(tmp_path / "training" / "r7" / "base" / "manifest")
    with pytest.raises(ValueError, match="does not say"):
        train(spark, cases, paths, TrainingSettings(**settings, resume=True))


def test_a_broken_search_goes_on_at_the_next_point(spark, cases, tmp_path, monkeypatch):
    grids = {"lr": {"regParam": [0.1, 0.2, 0.3], "maxIter": [5, 10]}}
    whole = RunPaths(str(tmp_path), "whole")
    train(spark, cases, whole, TrainingSettings(models=["lr"], grids=grids))
    paths, settings, plain, entered = RunPaths(str(tmp_path), "broken"), {"models": ["lr"], "grids": grids}, SearchJournal.add, []

    def breaks(journal, fold, point, *rest):
        if len(entered) == 8:
            raise OSError("lost")
        entered.append((fold, point))
        plain(journal, fold, point, *rest)

    with monkeypatch.context() as patched:
        patched.setattr(SearchJournal, "add", breaks)
        with pytest.raises(OSError, match="lost"):
            train(spark, cases, paths, TrainingSettings(**settings, parallelism=1))
    points = [f"regParam={r} maxIter={m}" for r in (0.1, 0.2, 0.3) for m in (5, 10)]
    kept = SearchJournal(spark, paths.journal("lr"))
    assert set(kept.scores(points)) == set(entered) and len(entered) == 8
    assert kept.scores(["another"] * 6) == {}
    later = []
    monkeypatch.setattr(SearchJournal, "add", lambda j, fold, point, *rest: later.append((fold, point)) or plain(j, fold, point, *rest))
    train(spark, cases, paths, TrainingSettings(**settings, resume=True))
    assert not set(later) & set(entered) and len(later) == 3 * 6 - 8
    tuning = read_table(spark, paths, "tuning").drop("run_id")
    one, other = (sorted(map(tuple, tuning.where(F.input_file_name().contains(f"run_id={r}/")).collect())) for r in ("whole", "broken"))
    assert len(one) == 6 and one == other


def test_journals_read_whole_files_only(spark, tmp_path):
    journal = SearchJournal(spark, str(tmp_path / "search"))
    assert journal.scores(["a", "b"]) == {}
    journal.add(0, 1, "b", 0.1 + 0.2)
    journal.add(0, 1, "b", 0.1 + 0.2)
    (tmp_path / "search" / "_fold-0-point-0.json").write_text('{"fold": 0')
    assert journal.scores(["a", "b"]) == {(0, 1): 0.1 + 0.2}


def test_runs_of_one_minute_do_not_meet(spark, tmp_path):
    with ThreadPool(6) as pool:
        claimed = pool.map(lambda _: claim_run(spark, str(tmp_path), run_id="2020-01-02-03-04"), range(6))
    numbers = sorted(p.run_id.removeprefix("2020-01-02-03-04") for p in claimed)
    assert numbers == ["", "-2", "-3", "-4", "-5", "-6"]
    assert claim_run(spark, str(tmp_path), "with_diagnosis").run_id == new_run_id()[: len("2020-01-02-03-04")]


def test_the_whole_leaderboard_is_printed(spark, run, tmp_path, capsys):
    paths, _ = run
    rows = [(f"run{i:02}", "base", "lr", "test", metric, i / 100) for i in range(30) for metric in METRICS]
    columns = "run_id string, features string, model string, dataset string, metric string, value double"
    table = small_table(spark, rows, columns)
    table.write.partitionBy("run_id", "features", "model").parquet(f"{tmp_path}/tables/metrics")
    main(["leaderboard", "--base", str(tmp_path)])
    lines = [line for line in capsys.readouterr().out.splitlines() if line.startswith("run")]
    assert len(lines) == 31 and lines[1].startswith("run29") and lines[30].startswith("run00")
    main(["leaderboard", "--base", str(tmp_path), "--top", "3"])
    assert sum(line.startswith("run") for line in capsys.readouterr().out.splitlines()) == 4
    main(["leaderboard", "--base", str(tmp_path), "--out", str(tmp_path / "board")])
    assert spark.read.parquet(str(tmp_path / "board")).count() == 30


def test_no_training_rows(spark, cases, tmp_path):
    nobody = cases.withColumn("fecha_internacion", F.lit(None).cast("date"))
    with pytest.raises(ValueError, match="training part"):
        train(spark, nobody, RunPaths(str(tmp_path), "r4"), TrainingSettings(grids=SMOKE))


def test_paths():
    paths = RunPaths("hdfs://host/x/", "2020-01-02-03-04", "with_diagnosis")
    assert paths.model("rf") == "hdfs://host/x/training/2020-01-02-03-04/with_diagnosis/rf/model"
    assert RunPaths("/x", "a").model("rf") != RunPaths("/x", "a", "with_diagnosis").model("rf")
    assert len(new_run_id()) == len("2020-01-02-03-04") and RunPaths("/x").run_id[:2] == "20"


def test_command_line(spark, cases, tmp_path, capsys):
    source, base = str(tmp_path / "cases"), str(tmp_path / "base")
    cases.write.option("header", True).csv(source)
    common = ["--base", base, "--run", "r5", "--models", "lr"]
    main(["train", "--cases", source, *common, "--grid", "small"])
    main(["params", *common])
    main(["leaderboard", "--base", base])
    main(["score", "--cases", source, "--out", str(tmp_path / "out"), *common])
    printed = capsys.readouterr().out
    assert "elasticNetParam" in printed and "weighted_false_positive_rate" in printed
    assert spark.read.parquet(str(tmp_path / "out")).count() == 812
    with pytest.raises(SystemExit):
        main(["score", "--cases", source, "--out", "x", "--base", base, "--run", "r5"])


def test_command_line_choices():
    from casecast.__main__ import parser, settings_of

    common = ["train", "--cases", "c", "--base", "b", "--models", "lr", "gbt"]
    for asked in (["--split", "random"], ["--grid", "full"], ["--forest-rows", "counts"], ["--forest-blocks", "9"]):
        with pytest.raises(SystemExit, match=asked[0]):
            settings_of(parser().parse_args([*common, "--as-published", *asked]))
    assert settings_of(parser().parse_args([*common, "--unknown-mean", "overall"])).unknown_mean == "overall"
    plain = settings_of(parser().parse_args([*common, "--grid", "smoke", "--key", "id"]))
    assert (plain.models, plain.key, plain.split, plain.age_rule) == (["lr", "gbt"], "id", "hash", "keep_known")
    assert plain.grids is SMOKE
    published = settings_of(parser().parse_args([*common, "--as-published"]))
    assert (published.split, published.age_rule, published.means_from) == ("random", "as_computed", "all")
    assert [len(grid_points(published.grids[name])) for name in MODELS] == [36, 576, 100, 12]
    assert parser().parse_args([*common, "--features", "base", "with_diagnosis"]).features == ["base", "with_diagnosis"]
    assert parser().parse_args(common).features == ["base"]


def test_two_rounds_count_the_cases_once(spark, cases, tmp_path, monkeypatch):
    """Both feature rounds from one count agree with each round on its own."""
    from casecast.plans import training

    calls = []
    monkeypatch.setattr(training, "case_profiles", lambda *args: calls.append(args) or original(*args))
    settings = TrainingSettings(models=["lr"], grids=SMOKE)
    together = RunPaths(str(tmp_path / "a"), "r")
    best = training.train_rounds(spark, cases, together, settings)
    assert len(calls) == 1 and {name: models["lr"].numFeatures for name, models in best.items()} == {
        "base": 5, "with_diagnosis": 6,
    }
    for features in best:
        alone = RunPaths(str(tmp_path / "b"), "r", features)
        model = train(spark, cases, alone, TrainingSettings(models=["lr"], grids=SMOKE, features=features))["lr"]
        assert list(model.coefficients) == list(best[features]["lr"].coefficients)
    a, b = (read_table(spark, paths, "metrics").collect() for paths in (together, alone))
    assert len(a) == 2 * 2 * len(METRICS) and sorted(map(str, a)) == sorted(map(str, b))
