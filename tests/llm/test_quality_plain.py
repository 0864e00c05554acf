"""The classifier against a plain fit: statistics by definition, ridge by least squares over all rows, isotonic by min-max."""

import math
from collections import Counter

import numpy as np
import odd
import pytest
from pyspark.sql import functions as F

from casecast.llm.quality import BINS, FOLDS, RIDGES, STATISTICS, fit_quality, statistics, statistics_table

SPACES = " \t\n\x0b\x0c\r"
ENDS = "!#$%&*+=<>@^_|~"


def plain_statistics(text):
    data = text.encode()
    words = "".join(" " if c in SPACES else c for c in text).split(" ")
    words = [w.encode() for w in words if w]
    if not words:
        return dict.fromkeys(STATISTICS, 0.0)
    n, total = len(words), len(data)
    lengths = [len(w) for w in words]
    mean = sum(lengths) / n
    lines = [line for line in data.split(b"\n") if line]
    shares = [c / total for c in Counter(data).values()]

    def share(wanted):
        return sum(wanted(c) for c in data) / total

    def is_symbol(c):
        return 33 <= c < 127 and not chr(c).isalnum() and chr(c) not in ".,;:'\"-()"

    return {
        "log_chars": math.log(1 + total),
        "log_words": math.log(1 + n),
        "mean_word": mean,
        "sd_word": math.sqrt(sum((x - mean) ** 2 for x in lengths) / n),
        "upper": share(lambda c: 65 <= c <= 90),
        "digits": share(lambda c: 48 <= c <= 57),
        "symbols": share(is_symbol),
        "non_ascii": share(lambda c: c >= 128),
        "spaces": share(lambda c: chr(c) in SPACES),
        "distinct_words": len(set(words)) / n**0.8,
        "top_word": max(Counter(words).values()) / n,
        "repeats_before": sum(words[i] == words[i + 1] for i in range(n - 1)) / n,
        "distinct_pairs": (len({(words[i], words[i + 1]) for i in range(n - 1)}) if n > 1 else 1) / max(1, n - 1),
        "loud_words": sum(len(w) > 2 and w.isupper() for w in words) / n,
        "symbol_ends": sum(chr(w[-1]) in ENDS for w in words) / n,
        "single_symbols": sum(len(w) == 1 and chr(w[0]) in ENDS for w in words) / n,
        "line_words": math.log(1 + n / len(lines)),
        "distinct_lines": len(set(lines)) / len(lines),
        "ends_with_stop": sum(chr(line[-1]) in ".!?" for line in lines) / len(lines),
        "byte_entropy": -sum(p * math.log(p) for p in shares),
    }


def plain_isotonic(counts, sums):
    n = len(counts)
    average = lambda a, b: sum(sums[a : b + 1]) / sum(counts[a : b + 1])
    return [max(min(average(a, b) for b in range(i, n)) for a in range(i + 1)) for i in range(n)]


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


def test_statistics_by_definition(texts):
    for text in [*texts.values(), *[row[1] or "" for row in odd.odd_rows()], "!! A-B\n\nWOW !! ok.", "x"]:
        expected = plain_statistics(text)
        assert statistics(text) == pytest.approx([expected[name] for name in STATISTICS], abs=1e-12)


def test_scores_of_a_plain_fit(spark, sf_dir, texts):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    features, width, seed = 24, 4.0, 11
    model = fit_quality(statistics_table(docs.repartition(5)), labels, features=features, width=width, seed=seed)

    fold = F.pmod(F.xxhash64(F.col("doc_id").cast("bigint")), F.lit(FOLDS)).alias("fold")
    known = [r for r in labels.select("doc_id", "quality", fold).collect() if r.quality in (0, 1) and r.doc_id in texts]
    rows = np.array([[plain_statistics(texts[r.doc_id])[s] for s in STATISTICS] for r in known])
    target, folds = np.array([float(r.quality) for r in known]), np.array([r.fold for r in known])
    spread = rows.std(axis=0)
    draw = np.random.default_rng(seed)
    directions = draw.normal(0, 1 / width, (len(STATISTICS), features))
    phases = draw.uniform(0, 2 * np.pi, features)

    def design(x):
        standard = np.clip((x - rows.mean(axis=0)) / np.where(spread > 1e-9, spread, 1.0), -8, 8)
        return np.hstack([math.sqrt(2 / features) * np.cos(standard @ directions + phases), np.ones((len(x), 1))])

    z = design(rows)

    def ridge_fit(chosen, penalty):
        """Least squares over the rows themselves and one more row for each penalised weight."""
        more = np.diag(np.sqrt(penalty * np.array([1.0] * features + [1e-9])))
        return np.linalg.lstsq(np.vstack([z[chosen], more]), np.concatenate([target[chosen], np.zeros(features + 1)]), rcond=None)[0]

    def left_out(penalty):
        raw = np.zeros(len(z))
        for f in range(FOLDS):
            raw[folds == f] = z[folds == f] @ ridge_fit(folds != f, penalty)
        return raw

    penalties = [r * len(z) / features for r in RIDGES]
    penalty = min(penalties, key=lambda p: ((left_out(p) - target) ** 2).sum())
    bins = np.clip(((left_out(penalty) + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)
    met = sorted(set(bins.tolist()))
    level = plain_isotonic([(bins == b).sum() for b in met], [target[bins == b].sum() for b in met])
    raw_at = [(b + 0.5) / BINS * 2 - 0.5 for b in met]

    every = np.array([[plain_statistics(t)[s] for s in STATISTICS] for t in texts.values()])
    raw = design(every) @ ridge_fit(np.ones(len(z), bool), penalty)
    assert design(every) @ model.weights == pytest.approx(raw, abs=1e-6)
    expected = np.clip(np.interp(raw, raw_at, level), 0, 1)
    scored = statistics_table(docs).select("doc_id", model.score(F.col("statistics")).alias("score")).collect()
    found = {r.doc_id: r.score for r in scored}
    assert [found[i] for i in texts] == pytest.approx(expected.tolist(), abs=1e-3)
