import random

import numpy as np
import pytest

from casecast.llm import topk
from casecast.llm.topk import SortedLists, quantised, top_k

SCHEMA = "id bigint, vector array<bigint>"


def brute(queries, candidates, k):
    found = {}
    for q, v in queries:
        scores = sorted((-sum(a * b for a, b in zip(v, w)), c) for c, w in candidates if c != q and len(w) == len(v))
        found[q] = [(rank, c, -s) for rank, (s, c) in enumerate(scores[:k], 1)]
    return found


def found_by(frame):
    found = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return found


@pytest.mark.parametrize("blocks", [(8192, 2048), (16, 3)])
def test_against_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "BLOCK_ROWS", blocks[0])
    monkeypatch.setattr(topk, "BLOCK_QUERIES", blocks[1])
    draw = random.Random(3)
    rows = [(i, [draw.randrange(-3, 4) for _ in range(5)]) for i in range(120)]  # many ties
    rows += [(200, [0] * 5), (201, [9] * 5), (202, [9] * 5)]
    table = spark.createDataFrame(rows, SCHEMA)
    queries = [row for row in rows if row[0] % 10 == 0 or row[0] > 200]
    assert found_by(top_k(spark.createDataFrame(queries, SCHEMA), table, 4)) == brute(queries, rows, 4)


def test_stops_early_where_the_bound_allows(monkeypatch):
    draw = np.random.default_rng(1)
    vectors = draw.integers(0, 10, (5000, 3))
    vectors[7] = [1000, 1000, 1000]
    vectors[8] = [900, 900, 900]
    scored = []
    plain = topk._products
    monkeypatch.setattr(topk, "_products", lambda rows, query: scored.append(len(rows)) or plain(rows, query))
    ids, scores = SortedLists(np.arange(5000), vectors).top(np.array([1, 2, 3]), 2, -1)
    assert ids.tolist() == [7, 8] and scores.tolist() == [6000, 5400] and sum(scored) < 100


def test_blocks_and_copies(spark, monkeypatch):
    """Candidates are staged once, in blocks that hold each different row once, whatever the number of waves."""
    monkeypatch.setattr(topk, "BLOCK_ROWS", 40)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 20)
    staged, plain = [], topk.staged
    monkeypatch.setattr(topk, "staged", lambda df, name: staged.append((name, plain(df, name))) or staged[-1][1])
    rows = [(i, [i % 7, i % 11, -i % 5]) for i in range(300)] + [(5, [5, 5, 0])] * 400 + [(7, [1, 2])] * 2
    table = spark.createDataFrame(rows, SCHEMA)
    different = [(i, list(v)) for i, v in sorted({(i, tuple(v)) for i, v in rows})]
    asked = [row for row in different if row[0] % 3 == 0]
    found = found_by(top_k(spark.createDataFrame(asked, SCHEMA), table, 3))
    assert found == brute(asked, different, 3)
    blocks = [df for name, df in staged if name == "search-blocks"]
    assert len(blocks) == 1 and sum(name == "search-hits" for name, _ in staged) > 3
    ids = np.concatenate([np.frombuffer(row.ids, np.int64) for row in blocks[0].collect()])
    assert sorted(ids.tolist()) == [i for i, _ in different] and blocks[0].count() > 10


def test_what_is_held_ends_a_block_early(monkeypatch):
    vectors = np.random.default_rng(1).integers(0, 10, (5000, 3))
    scored, plain = [], topk._products
    monkeypatch.setattr(topk, "_products", lambda rows, query: scored.append(len(rows)) or plain(rows, query))
    held = np.array([9000, 9001]), np.array([70, 60])
    ids, scores = SortedLists(np.arange(5000), vectors).top(np.array([1, 2, 3]), 2, -1, held)
    assert ids.tolist() == [9000, 9001] and scores.tolist() == [70, 60] and sum(scored) < 100


def test_numbers_beyond_floating_point(spark):
    big = 1 << 28
    rows = [(1, [big + 1, 1]), (2, [big, 1]), (3, [big + 1, 0]), (4, [-big, 5])]
    assert found_by(top_k(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(rows, SCHEMA), 5)) == brute(rows, rows, 5)


def test_odd_vectors(spark):
    rows = [
        (1, [1.0, 2.0]),
        (2, [0.999, -0.001]),  # floors to 255 and -1
        (2, [0.999, -0.001]),  # a repeated row
        (3, None),
        (4, [1.0, None]),
        (5, [float("nan"), 1.0]),
        (6, [float("inf"), 1.0]),
        (7, []),
        (8, [1.0, 2.0, 3.0]),
        (None, [1.0, 2.0]),
        (9, [-1.0, 0.5]),
    ]
    table = spark.createDataFrame([(*row, "mine") for row in rows], "vec_id bigint, embedding array<double>, score string")
    vectors = quantised(table)
    good = [(1, [256, 512]), (2, [255, -1]), (8, [256, 512, 768]), (9, [-256, 128])]
    expected = {q: hits for q, hits in brute(good, good, 5).items() if hits}
    assert found_by(top_k(vectors, vectors, 5)) == expected
    assert top_k(vectors.where("false"), vectors).collect() == []
    assert top_k(vectors, vectors.where("false")).collect() == []
