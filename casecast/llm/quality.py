"""Document quality: ridge regression on random Fourier features of text statistics, calibrated to probabilities."""

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casecast.llm.common import DOC_ID, TEXT, in_small_batches, text_or_empty
from casecast.session import staged

FOLDS = 4
RIDGES = (1e-4, 1e-3, 1e-2, 1e-1, 1.0)
#: Rows of the normal equations that travel together, and groups in which tasks' sums meet before the last sum.
BLOCK, SALTS = 64, 32
#: Bins of raw scores over [-0.5, 1.5] that calibration pools; bounds what reaches the driver.
BINS = 2000

STATISTICS = (
    "log_chars log_words mean_word sd_word upper digits symbols non_ascii spaces distinct_words top_word "
    "repeats_before distinct_pairs loud_words symbol_ends single_symbols line_words distinct_lines ends_with_stop "
    "byte_entropy"
).split()

_UPPER = np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[ord("0") : ord("9") + 1] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[33:127] = True
_SYMBOL[[c for c in range(33, 127) if chr(c).isalnum() or chr(c) in ".,;:'\"-()"]] = False
_ENDS = tuple(b"!#$%&*+=<>@^_|~")


def statistics(text):
    """The numbers in `STATISTICS` for one whole text; all are 0 for an empty one."""
    data = text.encode()
    words = data.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n = len(words)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    total = counts.sum()
    shares = counts[counts > 0] / total
    lengths = np.fromiter(map(len, words), np.int64, n)
    tally = Counter(words)
    pairs = len(set(zip(words, words[1:]))) if n > 1 else 1
    lines = [line for line in data.split(b"\n") if line]
    loud = sum(word.isupper() for word in words if len(word) > 2)
    return [
        np.log1p(total),
        np.log1p(n),
        lengths.mean(),
        lengths.std(),
        counts[_UPPER].sum() / total,
        counts[_DIGIT].sum() / total,
        counts[_SYMBOL].sum() / total,
        counts[128:].sum() / total,
        counts[_SPACE].sum() / total,
        len(tally) / n**0.8,
        max(tally.values()) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        pairs / max(1, n - 1),
        loud / n,
        sum(word[-1] in _ENDS for word in words) / n,
        sum(len(word) == 1 and word[0] in _ENDS for word in words) / n,
        np.log1p(n / len(lines)),
        len(set(lines)) / len(lines),
        sum(line[-1] in b".!?" for line in lines) / len(lines),
        float(-(shares * np.log(shares)).sum()),
    ]


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def text_statistics(texts: pd.Series) -> pd.Series:
    return pd.Series([statistics(text or "") for text in texts])


@dataclass
class FourierFeatures:
    """Standardised statistics to cosines whose inner products approximate a Gaussian kernel, and a constant."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray

    @classmethod
    def drawn(cls, mean, scale, features, width, seed):
        draw = np.random.default_rng(seed)
        directions = draw.normal(0, 1 / width, (len(mean), features))
        return cls(np.array(mean), np.array(scale), directions, draw.uniform(0, 2 * np.pi, features))

    def __call__(self, rows):
        standard = np.clip((rows - self.mean) / self.scale, -8, 8)
        cosines = np.sqrt(2 / len(self.phases)) * np.cos(standard @ self.directions + self.phases)
        return np.hstack([cosines, np.ones((len(rows), 1))])


def _normal_sums(features):
    """Per task and fold the sums Z'Z, Z'y and y'y, as blocks of rows of one matrix."""

    def run(batches):
        size = len(features.phases) + 2  # the features, the constant, and the target as the last column
        sums = {}
        for batch in batches:
            folds = batch.column(0).to_numpy(zero_copy_only=False)
            target = batch.column(1).to_numpy(zero_copy_only=False)
            rows = np.array(batch.column(2).to_pylist(), np.float64).reshape(len(folds), -1)
            for fold in np.unique(folds):
                chosen = folds == fold
                z = np.hstack([features(rows[chosen]), target[chosen, None]])
                sums.setdefault(int(fold), np.zeros((size, size)))
                sums[int(fold)] += z.T @ z
        salt = TaskContext.get().partitionId() % SALTS
        cells = [(f, i, salt, m[i : i + BLOCK].tobytes()) for f, m in sums.items() for i in range(0, size, BLOCK)]
        if cells:
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*cells), kinds)], ["fold", "block", "salt", "sums"]
            )

    return run


def _added(group: pd.DataFrame) -> pd.DataFrame:
    first = group.iloc[:1].copy()
    first["sums"] = [sum(np.frombuffer(x) for x in group["sums"]).tobytes()]
    return first


def _pooled(counts, sums):
    """Pool adjacent violators: the non-decreasing means that fit best."""
    blocks = []
    for weight, total in zip(counts, sums):
        blocks.append([weight, total, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            weight, total, n = blocks.pop()
            blocks[-1] = [blocks[-1][0] + weight, blocks[-1][1] + total, blocks[-1][2] + n]
    return np.concatenate([np.full(n, total / weight) for weight, total, n in blocks])


@dataclass
class QualityModel:
    """Scores statistics of texts; without any label every score is `prior`."""

    prior: float
    features: FourierFeatures = None
    weights: np.ndarray = None
    raw_at: np.ndarray = None
    calibrated: np.ndarray = None

    def predict(self, rows):
        if self.features is None:
            return np.full(len(rows), self.prior)
        return np.clip(np.interp(self.features(rows) @ self.weights, self.raw_at, self.calibrated), 0, 1)

    def score(self, statistics_col):
        """A column of scores for a column of statistics."""
        predict = self.predict

        @F.pandas_udf("double")
        def scores(values: pd.Series) -> pd.Series:
            return pd.Series(predict(np.stack(values.to_numpy())) if len(values) else [], dtype="float64")

        return scores(statistics_col)


def fit_quality(statistics_of_docs, labels, features=256, width=4.0, seed=11, label_col="quality", id_col=DOC_ID):
    """Learn from `labels` (`id_col`, `label_col` of 0 or 1) what `statistics_of_docs` (`doc_id`, `statistics`) say.

    All labelled rows are used. Each task adds up its part of the normal equations per fold; parts are summed by
    blocks of rows in two rounds, so no task holds more than one block of a share of the tasks, and the driver gets
    four square matrices of `features` + 2 whatever the input. It picks the ridge penalty by the error on the fold
    left out, which the sums give without another pass, and solves. Scores of rows by the model that left out their
    fold are counted in 2,000 bins, on which isotonic regression calibrates.

    Defined cases: label rows with a null id or a label other than 0 and 1 are left out, several rows of one id count
    as their mean; rows of documents that repeat an id are one observation each. Without any labelled document, as with an
    empty table of either kind, every score is 0.5. Equal statistics have equal scores; of equally good penalties the
    first counts. Only the named columns are read, so others cannot clash.
    """
    known = labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).cast("bigint").alias("_id"))
    known = known.agg(F.avg(F.col(label_col).cast("double")).alias("target"))
    fold = F.pmod(F.xxhash64("_id"), F.lit(FOLDS)).cast("int").alias("fold")
    rows = statistics_of_docs.join(known, F.col("doc_id") == F.col("_id")).select(fold, "target", "statistics")
    rows = staged(rows, "quality-training")
    at = [F.col("statistics")[i] for i in range(len(STATISTICS))]
    moments = [F.count(F.lit(1)), F.avg("target"), *map(F.avg, at), *map(F.stddev_pop, at)]
    n, prior, *rest = rows.agg(*moments).first()
    if not n:
        return QualityModel(0.5)
    mean, spread = np.array(rest[: len(at)]), np.array(rest[len(at) :])
    drawn = FourierFeatures.drawn(mean, np.where(spread > 1e-9, spread, 1.0), features, width, seed)
    schema = "fold int, block int, salt int, sums binary"
    parts = rows.mapInArrow(_normal_sums(drawn), schema)
    parts = parts.groupBy("fold", "block", "salt").applyInPandas(_added, schema)
    whole = parts.groupBy("fold", "block").applyInPandas(_added, schema).collect()
    size = features + 2
    grams = np.zeros((FOLDS, size, size))
    for cell in whole:
        block = np.frombuffer(cell["sums"]).reshape(-1, size)
        grams[cell["fold"], cell["block"] : cell["block"] + len(block)] = block

    def solved(gram, ridge):
        z = gram[:-1, :-1] + ridge * np.diag([1.0] * features + [1e-9])
        return np.linalg.lstsq(z, gram[:-1, -1], rcond=None)[0]

    def error(gram, w):
        return w @ gram[:-1, :-1] @ w - 2 * w @ gram[:-1, -1] + gram[-1, -1]

    total = grams.sum(axis=0)
    errors = [sum(error(grams[f], solved(total - grams[f], r * n / features)) for f in range(FOLDS)) for r in RIDGES]
    ridge = RIDGES[int(np.argmin(errors))] * n / features
    left_out = np.stack([solved(total - grams[f], ridge) for f in range(FOLDS)])

    @F.pandas_udf("int")
    def binned(folds: pd.Series, values: pd.Series) -> pd.Series:
        raw = (drawn(np.stack(values.to_numpy())) * left_out[folds.to_numpy()]).sum(axis=1)
        return pd.Series(np.clip(((raw + 0.5) / 2 * BINS).astype(int), 0, BINS - 1))

    bins = rows.select(binned("fold", "statistics").alias("bin"), "target")
    bins = bins.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("target").alias("sum")).orderBy("bin").collect()
    level = _pooled([b["n"] for b in bins], [b["sum"] for b in bins])
    raw_at = (np.array([b["bin"] for b in bins]) + 0.5) / BINS * 2 - 0.5
    return QualityModel(prior, drawn, solved(total, ridge), raw_at, level)


def statistics_table(docs, id_col=DOC_ID, text_col=TEXT):
    """`doc_id` and `statistics` of every row, staged.

    Defined cases: a null text is an empty one, whose statistics are all 0. A very long text is looked at whole, in one
    task. Repeated rows and null ids stay. Only the two named columns are read; an empty table gives an empty result.
    """
    statistics_col = text_statistics(text_or_empty(text_col)).alias("statistics")
    found = in_small_batches(docs).select(F.col(id_col).cast("bigint").alias("doc_id"), statistics_col)
    return staged(found, "quality-statistics")


def keep_good(docs, labels, threshold=0.3, id_col=DOC_ID, text_col=TEXT):
    """The rows of `docs` whose score is at least `threshold`, by a model learned from `labels` on these rows.

    The statistics are computed once for the fit, as narrow rows, and again where a row is judged, so texts are not
    shuffled. Rows without an id are scored like any other, as are null texts (empty ones) and repeated rows, which stay
    or go together. Columns come back as they are, whatever their names; an empty table stays empty.
    """
    model = fit_quality(statistics_table(docs, id_col, text_col), labels)
    return docs.where(model.score(text_statistics(text_or_empty(text_col))) >= threshold)
