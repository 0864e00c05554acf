import hashlib
import random
import zlib

import pytest

from casecast.llm import trie
from casecast.llm.trie import PRIME, after, inverse, of_turn, prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
CLASHING = ", part string, place string, a string, b string, depth string, h string, head string"


def brute(rows, head_turns=6, group=100):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(turns, key=lambda t: t[:2])] for c, turns in convs.items()}
    rebuilt = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % head_turns
        rest = c % group if c >= 0 else -(-c % group)
        rebuilt[c] = tuple(convs.get(c - rest, [])[:h] + turns[h:])
    nodes = {}
    for c, turns in rebuilt.items():
        for depth in range(len(turns) + 1):
            nodes.setdefault(turns[:depth], []).append(c)
    children = {path: [p for p in nodes if p and p[:-1] == path] for path in nodes}
    found = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        ends = ",".join(str(c) for c in sorted(c for c in members if rebuilt[c] == path))
        found.append(
            (
                min(members),
                len(path),
                min(nodes[path[:-1]]) if path else None,
                len(members),
                len(children[path]),
                sum(not children[p] for p in below),
                sum((len(nodes[p]) - 1) * len(p[-1][1]) for p in below if p),
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(found, key=str)


def found_by(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def talks(seed, convs=60):
    """Conversations of a few different turns, so that many share some."""
    draw, rows = random.Random(seed), []
    for c in draw.sample(range(-150, 420), convs) + [0, 100, 200]:
        for turn in range(draw.randrange(1, 12)):
            rows.append((c, turn, ["user", "assistant"][turn % 2], draw.choice(["hi", "no", "é中", ""]) * draw.choice([1, 1, 1, 50])))
    return list(dict.fromkeys(rows))


def test_products():
    draw = random.Random(1)
    turns = [of_turn(draw.getrandbits(64) - (1 << 63), draw.getrandbits(64) - (1 << 63)) for _ in range(9)]
    whole = (1, 0)
    for t in turns:
        whole = after(whole, t)
    head, rest = (1, 0), (1, 0)
    for t in turns[:4]:
        head = after(head, t)
    for t in turns[4:]:
        rest = after(rest, t)
    assert after(head, rest) == whole and after(inverse(head), whole) == rest and after(head, inverse(head)) == (1, 0)
    assert all(0 < a < PRIME and 0 <= b < PRIME for a, b in turns)


@pytest.mark.parametrize("seed, partitions", [(1, 4), (2, 29)])
def test_against_brute_force(spark, seed, partitions):
    rows = talks(seed)
    random.Random(seed).shuffle(rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", partitions < 10)
    try:
        assert found_by(prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)


def test_one_long_conversation_over_many_tasks(spark):
    rows = [(3, i, "user", f"turn {i % 7}") for i in range(400)] + [(c, i, "user", f"turn {i % 7}") for c in (0, 5, 9) for i in range(c * 3)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        assert found_by(prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(5))) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(trie, "SEGMENT", 10)
    rows = [(1, None, "user", "first"), (1, 0, None, None), (1, 1, "user", "x" * 300_000), (2, None, "user", "first"), (2, 0, "", "")]
    rows += [(None, 0, "user", "a"), (None, None, None, None), (7, 0, "user", "again"), (7, 0, "user", "again"), (307, 0, "user", "z")]
    rows += [(c, 0, "user", "same") for c in range(1000, 1100)] + [(-3, 0, "user", "b"), (-3, 1, "user", "c")]
    table = spark.createDataFrame([(*r, *["mine"] * 7) for r in rows], SCHEMA + CLASHING)
    assert found_by(prefix_trie(table)) == brute(rows)


def test_colliding_fingerprints_are_found(spark, monkeypatch):
    rows = talks(3, 20)
    plain, attempts = trie._turns, []

    def turns(conversations, attempt):
        attempts.append(attempt)
        found = plain(conversations, attempt)
        if attempt:
            return found
        return found.selectExpr("part", "conv_id", "place", "1L AS a", "0L AS b", "1L AS pa", "0L AS pb", "chars", *trie.REFERENCE)

    monkeypatch.setattr(trie, "_turns", turns)
    assert found_by(prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    assert attempts == [0, 1]


def test_empty(spark):
    assert prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []
