"""Train, test and validation parts, and folds of the training part."""

from pyspark.sql import functions as F

from casecast.functions import key_hash
from casecast.schema import KEY

# Part sizes, seed and number of folds.
PARTS = {"train": 0.7, "test": 0.2, "validation": 0.1}
SPLIT_SEED = 2048
FOLDS = 3


def _part(position, parts, scale):
    """The part whose share of [0, scale) holds `position`."""
    total = sum(parts.values())
    names = list(parts)
    expression, upper = None, 0.0
    for name in names[:-1]:
        upper += parts[name] / total
        below = position < round(upper * scale, 6)
        expression = F.when(below, name) if expression is None else expression.when(below, name)
    return F.lit(names[-1]) if expression is None else expression.otherwise(names[-1])


def with_split(df, mode="hash", key=KEY, parts=PARTS, seed=SPLIT_SEED, folds=FOLDS):
    """Add `split` and `fold` in one narrow pass.

    `hash` draws both from the key, so a case stays where it is on any layout, in any run and in any engine. `random`
    needs no key but depends on how the rows lie in partitions.
    """
    if mode == "hash":
        if key not in df.columns:
            raise ValueError(f"the hash split needs the key column {key!r}; use mode='random' for tables without one")
        # Without a key the record itself decides, so that such rows are spread like any others.
        record = F.concat(F.lit("record:"), F.to_json(F.struct(*[F.col(f"`{name}`") for name in df.columns])))
        h = key_hash(F.when(F.col(key).isNull(), record).otherwise(F.col(key).cast("string")))
        fold = F.floor(h / 1000) % folds
        return df.withColumns({"split": _part(h % 1000, parts, 1000), "fold": fold.cast("int")})
    if mode == "random":
        # One draw per row: the comparisons read the drawn column instead of drawing again.
        drawn = df.withColumn("_draw", F.rand(seed))
        fold = F.floor(F.rand(seed + 1) * folds)
        return drawn.withColumns({"split": _part(F.col("_draw"), parts, 1.0), "fold": fold.cast("int")}).drop("_draw")
    raise ValueError(f"unknown split mode {mode!r}")
