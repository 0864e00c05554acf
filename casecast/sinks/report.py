"""The plain-text evaluation report of one model."""

from casecast.session import small_table

# What a report shows for each set, in this order, after the confusion matrix.
SHOWN = [
    ("F1-Score", "f1"),
    ("Accuracy", "accuracy"),
    ("Weighted precision", "weighted_precision"),
    ("Weighted recall", "weighted_recall"),
    ("Weighted true positive rate", "weighted_true_positive_rate"),
    ("Weighted false positive rate", "weighted_false_positive_rate"),
]


def matrix_lines(counts):
    """A line per actual class in ascending order; classes that are only ever predicted do not show."""
    cells = {(label, prediction): n for label, prediction, n in counts}
    classes = sorted({label for label, _ in cells})
    yield f"Confusion matrix, predicted {' '.join(str(c) for c in classes)}"
    for actual in classes:
        yield f"actual {actual}: {' '.join(str(cells.get((actual, predicted), 0)) for predicted in classes)}"


def report_lines(model_class, sections):
    """Header, then each (set name, confusion counts, metrics) section. The counts are one row per pair of classes."""
    yield f"How {model_class} did on held-out cases"
    for name, counts, metrics in sections:
        yield f"{name} set"
        yield from (f"{name}: {line}" for line in matrix_lines(counts))
        yield from (f"{name}: {title} {metrics[metric]:.6f}" for title, metric in SHOWN)


def write_report(spark, lines, path, mode="errorifexists"):
    """Write the lines in order as a single text file; by default a report that exists already is an error."""
    rows = [(number, text) for number, text in enumerate(lines)]
    table = small_table(spark, rows, "line int, Text string")
    table.coalesce(1).sortWithinPartitions("line").select("Text").write.mode(mode).text(path)
