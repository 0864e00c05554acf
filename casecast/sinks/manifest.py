"""What a run was begun with, kept beside its outputs so that it is never resumed as another."""

import hashlib
import json

from casecast.session import small_table
from casecast.sinks.paths import is_written

#: Settings that decide what a run computes; how many fits run at once, say, does not.
DECIDING = [
    "features",
    "age_rule",
    "means_from",
    "split",
    "key",
    "unknown_mean",
    "forest_blocks",
    "forest_rows",
    "boost_candidates",
    "svm_starts",
]


def describe(cases, settings):
    """The manifest of a run of `settings` over `cases`: the input is named by its columns and the list of its files."""
    named = "\n".join([cases.schema.json(), *sorted(cases.inputFiles())])
    models = {name: {"grid": settings.grids[name], "params": settings.params.get(name, {})} for name in settings.models}
    known = {
        "input": hashlib.sha256(named.encode()).hexdigest(),
        "settings": {name: getattr(settings, name) for name in DECIDING},
        "models": models,
    }
    return json.loads(json.dumps(known))


def read_manifest(spark, path):
    """The manifest under `path`, or None if none was written completely."""
    if not is_written(spark, path):
        return None
    return json.loads("\n".join(row.value for row in spark.read.text(path).collect()))  # one line


def write_manifest(spark, manifest, path, mode="errorifexists"):
    small_table(spark, [(json.dumps(manifest, sort_keys=True),)], "value string").coalesce(1).write.mode(mode).text(path)


def check_same(old, new, path):
    """Raise if a run begun as `old` would go on as `new`. Models may be added; those of both must have equal grids."""
    if old is None:
        raise ValueError(f"{path} does not say what its run was begun with; begin another run")
    other = [name for name, value in new["settings"].items() if old["settings"].get(name) != value]
    other += ["input"] * (old["input"] != new["input"])
    other += [f"grid of {name}" for name, had in old["models"].items() if new["models"].get(name, had) != had]
    if other:
        raise ValueError(f"{path} was begun with another {', '.join(other)}; resume it as it was or begin another run")
