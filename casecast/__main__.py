"""Command line: train on a case file, show tuned parameters or the leaderboard, score new cases.

    python -m casecast train --cases hdfs:///surveillance/cases.csv --base hdfs:///surveillance --key id
"""

import argparse
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from casecast.models.grids import MODELS, PRESETS
from casecast.plans.reports import leaderboard
from casecast.plans.scoring import write_scores
from casecast.plans.training import TrainingSettings, train_rounds
from casecast.schema import FEATURE_SETS, KEY
from casecast.session import local_session
from casecast.sinks.model_store import tuned_params
from casecast.sinks.paths import RunPaths, claim_run
from casecast.sinks.tables import read_table
from casecast.sources import read_cases


def parser():
    commands = argparse.ArgumentParser(prog="casecast", description=__doc__.split("\n")[0])
    commands.add_argument("--local", metavar="CPUS", help="run in this process instead of on the submitted cluster")
    subcommands = commands.add_subparsers(dest="command", required=True)

    def command(name, help, run_needed=True, rounds=None):
        sub = subcommands.add_parser(name, help=help)
        sub.add_argument("--base", required=True, help="base URI of all outputs")
        sub.add_argument("--run", required=run_needed, help="run id")
        default = ["base"] if rounds else "base"
        sub.add_argument("--features", choices=list(FEATURE_SETS), nargs=rounds, default=default)
        sub.add_argument("--models", nargs="+", choices=MODELS, default=list(MODELS))
        return sub

    def with_cases(sub):
        sub.add_argument("--cases", required=True, help="URI of the case file or folder")
        sub.add_argument("--format", choices=["csv", "parquet"], default="csv")
        sub.add_argument("--sep", default=",")
        sub.add_argument("--infer", action="store_true", help="let Spark guess the types in an extra pass")
        sub.add_argument("--key", default=KEY, help="column that identifies a case")
        return sub

    training = with_cases(command("train", "search, evaluate and save the models", run_needed=False, rounds="+"))
    training.add_argument("--grid", choices=list(PRESETS), default="small")
    training.add_argument("--age-rule", choices=["keep_known", "as_computed"], default="keep_known")
    training.add_argument("--means-from", choices=["train", "all"], default="train")
    training.add_argument("--split", choices=["hash", "random"], default="hash")
    training.add_argument(
        "--as-published", action="store_true", help="full grids, ages overwritten, means over all cases, random split"
    )
    training.add_argument("--parallelism", type=int, default=2, help="concurrent fits")
    training.add_argument("--resume", action="store_true", help="take up the run named by --run where it broke off")
    training.add_argument(
        "--forest-blocks", type=int, help="fit forests on about so many blocks of equal cases instead of single cases"
    )
    training.add_argument(
        "--forest-rows", choices=["cases", "counts"], default="cases", help="fit forests on cases, or on counted rows with the same law"
    )
    training.add_argument(
        "--boost-candidates", choices=["rows", "counts"], default="rows", help="take splits of boosted trees from rows, or from the cases they count"
    )
    training.add_argument("--svm-starts", type=int, default=1, help="runs of the solver of a support vector machine, the best is kept")
    training.add_argument(
        "--unknown-mean", choices=["error", "overall"], default="error", help="what fills ages of a sex without any known age"
    )
    command("params", "print the tuned parameters of the saved models")
    board = command("leaderboard", "print the metrics of all runs, best first", run_needed=False)
    board.add_argument("--dataset", choices=["test", "validation"], default="test")
    board.add_argument("--out", help="URI to write the leaderboard to, as Parquet, instead of printing it")
    board.add_argument("--top", type=int, help="only so many of the best rows")
    scoring = with_cases(command("score", "score cases with one saved model"))
    scoring.add_argument("--out", required=True, help="URI of the scores")
    return commands


def cases_of(spark, args, keyed):
    if args.format == "parquet":
        return read_cases(spark, args.cases, "parquet")
    types = {args.key: T.StringType()} if keyed and not args.infer else None
    return read_cases(spark, args.cases, "csv", sep=args.sep, infer=args.infer, types=types)


#: What `--as-published` decides by itself, with the values that say nothing was asked for.
DECIDED = {
    "grid": "small",
    "age_rule": "keep_known",
    "means_from": "train",
    "split": "hash",
    "forest_blocks": None,
    "forest_rows": "cases",
    "boost_candidates": "rows",
    "svm_starts": 1,
}


def settings_of(args):
    chosen = {
        "models": args.models,
        "key": args.key,
        "parallelism": args.parallelism,
        "resume": args.resume,
        "unknown_mean": args.unknown_mean,
    }
    if args.as_published:
        asked = [f"--{name.replace('_', '-')}" for name, usual in DECIDED.items() if getattr(args, name) != usual]
        if asked:
            raise SystemExit(f"--as-published decides {', '.join(asked)} by itself")
        return TrainingSettings.as_published(**chosen)
    return TrainingSettings(
        grids=PRESETS[args.grid],
        age_rule=args.age_rule,
        means_from=args.means_from,
        split=args.split,
        forest_blocks=args.forest_blocks,
        forest_rows=args.forest_rows,
        boost_candidates=args.boost_candidates,
        svm_starts=args.svm_starts,
        **chosen,
    )


def print_table(df):
    """All rows in order, tab-separated under a header, a partition at a time."""
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join(map(str, row)))


def main(argv=None):
    args = parser().parse_args(argv)
    spark = local_session(cpus=args.local) if args.local else SparkSession.builder.appName("casecast").getOrCreate()
    if args.command == "train":
        paths = RunPaths(args.base, args.run) if args.run else claim_run(spark, args.base)
        settings = settings_of(args)
        train_rounds(spark, cases_of(spark, args, settings.split == "hash"), paths, settings, args.features)
        for features in args.features:
            of_round = replace(paths, features=features)
            print(f"round {features} of run {paths.run_id}, under {of_round.root}")
            print_table(tuned_params(spark, of_round, args.models))
        return
    paths = RunPaths(args.base, args.run or "", args.features)
    if args.command == "params":
        print_table(tuned_params(spark, paths, args.models))
    elif args.command == "leaderboard":
        board = leaderboard(read_table(spark, paths, "metrics"), args.dataset)
        board = board if args.top is None else board.limit(args.top)
        if args.out:
            board.write.mode("errorifexists").parquet(args.out)
        else:
            print_table(board)
    elif args.command == "score":
        if len(args.models) != 1:
            raise SystemExit("score takes one model: --models rf")
        write_scores(spark, cases_of(spark, args, True), paths, args.models[0], args.out, args.key)


if __name__ == "__main__":
    main()
