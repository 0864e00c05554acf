"""Parameter grids as data, in the order in which their points are numbered."""

from itertools import product

from pyspark.ml.tuning import ParamGridBuilder

MODELS = ["rf", "lr", "svm", "gbt"]

# The full grids of 36, 576, 100 and 12 points.
FULL = {
    "rf": {"impurity": ["gini", "entropy"], "seed": [512, 1024, 2048], "numTrees": [100, 200, 400, 600, 800, 1000]},
    "lr": {
        "maxIter": [100, 300, 500, 700],
        "elasticNetParam": [0.8, 0.7, 0.5, 0.4, 0.3, 0.15],
        "regParam": [0.1, 0.2, 0.3, 0.4, 0.5, 0.7],
        "tol": [0.0, 0.1, 0.2, 0.3],
    },
    "svm": {
        "maxIter": [100, 300, 500, 700, 900],
        "regParam": [0.1, 0.2, 0.3, 0.4, 0.5],
        "tol": [0.0, 0.1, 0.2, 0.3],
    },
    "gbt": {"maxIter": [100, 300, 500], "seed": [1024, 2048], "stepSize": [0.2, 0.3]},
}

SMALL = {
    "rf": {"impurity": ["gini", "entropy"], "numTrees": [50, 100]},
    "lr": {"maxIter": [100], "elasticNetParam": [0.8, 0.15], "regParam": [0.1, 0.3], "tol": [0.0]},
    "svm": {"maxIter": [50, 100], "regParam": [0.1, 0.3], "tol": [0.1]},
    "gbt": {"maxIter": [20, 50], "stepSize": [0.2, 0.3]},
}

SMOKE = {
    "rf": {"impurity": ["gini"], "numTrees": [10]},
    "lr": {"maxIter": [100], "elasticNetParam": [0.15], "regParam": [0.1], "tol": [0.1]},
    "svm": {"maxIter": [5], "regParam": [0.1], "tol": [0.1]},
    "gbt": {"maxIter": [3, 5], "stepSize": [0.3]},
}

PRESETS = {"full": FULL, "small": SMALL, "smoke": SMOKE}

# The tuned parameters reported per model.
REPORTED = {
    "rf": ["impurity", "seed", "numTrees"],
    "lr": ["elasticNetParam", "maxIter", "regParam", "tol"],
    "gbt": ["seed", "maxIter", "stepSize"],
    "svm": ["maxIter", "regParam", "tol"],
}


def grid_points(axes):
    """The points of a grid as dictionaries."""
    return [dict(zip(axes, values)) for values in product(*axes.values())]


def param_maps(estimator, axes):
    """The same points, in the same order, as Spark's parameter maps for `estimator`."""
    builder = ParamGridBuilder()
    for name, values in axes.items():
        builder.addGrid(estimator.getParam(name), values)
    return builder.build()


def point_text(point):
    """One line per point, e.g. `maxIter=100 tol=0.1`."""
    return " ".join(f"{name}={value}" for name, value in point.items())
