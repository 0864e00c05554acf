import hashlib
from collections import defaultdict

import odd
import pytest

from casecast.llm.mixing import mix, source_targets


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    """Share out, cut off at the bounds, and share the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {name: weights[i % len(weights)] for i, name in enumerate(names)}
    open_, target, left = set(names), {}, float(sum(sizes.values()))
    while open_:
        share = {n: left * weight[n] / sum(weight[x] for x in open_) for n in open_}
        over = {n for n in open_ if share[n] > most * sizes[n]}
        if not over:
            return target | share
        for n in over:
            target[n] = most * sizes[n]
            left -= target[n]
        open_ -= over
    return target


def size(text):
    for space in "\t\n\x0b\x0c\r":
        text = (text or "").replace(space, " ")
    return len([w for w in text.split(" ") if w])


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    import random

    draw = random.Random(seed)
    sizes = {f"s{i}": draw.choice([0, 1, 10, 1000, 50_000]) for i in range(9)} | {None: 70, "é": 5}
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    found = {r.source: r.target for r in source_targets(table).collect()}
    expected = plain_targets(sizes)
    assert found.keys() == expected.keys() and all(abs(found[s] - expected[s]) < 1e-6 * (1 + expected[s]) for s in found)


@pytest.mark.parametrize("clashing", [False, True])
def test_odd_documents(spark, clashing):
    docs = odd.table(spark, clashing=clashing)
    done = mix(docs)
    rows = done.collect()
    sizes = defaultdict(int)
    for row in odd.odd_rows():
        sizes[row[3]] += size(row[1])
    expected = plain_targets(sizes)
    assert sorted(r["size"] for r in rows) == sorted(size(row[1]) for row in odd.odd_rows())
    assert all(r.source_size == sizes[r.source] and abs(r.target - expected[r.source]) < 1e-6 for r in rows)
    assert all(0 <= r.copies <= 3 for r in rows)
    results = {"size", "source_size", "target", "copies"}
    assert [c for c in done.columns if c not in results] == [c for c in docs.columns if c not in results]
    assert len({r.copies for r in rows if r.doc_id == 2}) == 1  # repeated rows stay together


def test_taken_words_come_near_and_repeat(spark):
    rows = [(i, odd.prose(i, 5 + i % 40), "en", "big" if i % 3 else f"s{i % 7}", None) for i in range(1500)]
    docs = odd.table(spark, rows)
    once = {r.doc_id: (r.source, r.target, r["size"], r.copies) for r in mix(docs).collect()}
    again = {r.doc_id: (r.source, r.target, r["size"], r.copies) for r in mix(docs.repartition(7)).collect()}
    assert once == again
    taken, target = defaultdict(int), {}
    for source, goal, words, copies in once.values():
        taken[source] += words * copies
        target[source] = goal
    assert all(abs(taken[s] - target[s]) <= 45 for s in target)


def test_hash_is_md5(spark):
    from casecast.llm.mixing import mix_hash

    (row,) = odd.table(spark, [(12, "x")]).select(mix_hash().alias("h")).collect()
    assert row.h == int(hashlib.md5(b"mix:12").hexdigest()[:15], 16)


def test_empty_and_wordless(spark):
    assert mix(odd.empty(spark)).collect() == []
    rows = mix(odd.table(spark, [(1, None), (2, "")])).collect()
    assert [(r["size"], r.target) for r in rows] == [(0, 0.0)] * 2


def test_no_python_in_the_plan(spark):
    plan = mix(odd.table(spark, [(1, "a b")]))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
