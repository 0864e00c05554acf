import odd
import pytest
from pyspark.sql import functions as F

from casecast.llm import sketch as module
from casecast.llm.queries import QUERIES
from casecast.llm.sketch import bottom_k, containment, distinct_shingles, merged, merged_by, resemblance, with_next, with_sketches


def shingles(text, n=5):
    words = [w.lower() for w in (text or "").split()]
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def test_sketch_in_chunks_and_equal_texts(monkeypatch):
    text = odd.prose(3, 3000)
    whole = bottom_k(text)
    monkeypatch.setattr(module, "CHUNK", 50)
    assert bottom_k(text).tolist() == whole.tolist() == bottom_k(text.upper()).tolist() == sorted(whole)
    assert len(whole) == 128 and len(bottom_k("")) == 0 and len(bottom_k("a b")) == 1


def test_estimates(spark):
    long = odd.prose(1, 4000)
    pairs = [
        (long, long),
        (long, long[: len(long) // 2] + odd.prose(2, 2000)),
        (long, long[: len(long) // 2]),
        (long, odd.prose(5, 4000)),
        (odd.prose(6, 60), odd.prose(6, 50)),  # fewer shingles than k: exact
        ("", ""),
        ("", "one"),
        (None, long),
    ]
    table = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    done = with_sketches(table, {"a": "x", "b": "y"}).select(
        "i", resemblance("x", "y").alias("r"), containment("x", "y").alias("c"), distinct_shingles("x").alias("n"), merged("x", "y").alias("m")
    )
    for row in done.collect():
        a, b = map(shingles, pairs[row.i])
        exact = len(a | b) <= 128
        assert row.r == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0, abs=1e-9 if exact else 0.13)
        assert row.c == pytest.approx(len(a & b) / len(a) if a else 1.0, abs=1e-9 if exact else 0.2)
        assert row.n == pytest.approx(len(a), rel=0.3)
        assert len(row.m) == min(128, len(a | b))


def test_merged_over_parts(spark):
    rows = odd.odd_rows()
    table = with_sketches(odd.table(spark).withColumn("g", F.coalesce(F.col("source"), F.lit("-"))), {"text": "sketch"})
    found = {r.g: r.sketch for r in merged_by(table, "g").collect()}
    for group, got in found.items():
        every = sorted({h for r in rows if (r[3] or "-") == group for h in bottom_k(r[1] or "").tolist()})
        assert got == every[:128]


@pytest.mark.parametrize("per_part", [3, 1000])
def test_next_row(spark, per_part):
    rows = [(i * 7 % 101, f"t{i}") for i in range(101)]
    found = {r.doc_id: r.next_text for r in with_next(odd.table(spark, rows).repartition(5), "doc_id", ["text"], per_part).collect()}
    text = dict(rows)
    assert found == {i: text[(i + 1) % 101] for i in range(101)}


def test_next_of_odd_rows(spark):
    rows = [(None, "n"), (1, "a"), (1, "b"), (2, None), (1 << 60, "z")]
    found = with_next(odd.table(spark, rows, clashing=True), "doc_id", ["text"], 1).collect()
    assert sorted((r.text or "", r.next_text or "") for r in found) == [("", "z"), ("a", "b"), ("b", ""), ("n", "a"), ("z", "n")]
    assert with_next(odd.empty(spark), "doc_id", ["text"]).collect() == []
    (alone,) = with_next(odd.table(spark, [(5, "x")]), "doc_id", ["text"]).collect()
    assert alone.next_text == "x"


def test_next_where_one_id_holds_a_third_of_the_rows(spark):
    rows = [(7 if i % 3 == 0 else i, f"{i * 31 % 97:02} text") for i in range(300)] + [(None, f"n{i:02}") for i in range(40)]
    found = with_next(odd.table(spark, rows).repartition(4), "doc_id", ["text"], 10).select("doc_id", "text", "next_text")
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    expected = [(a[0], a[1], b[1]) for a, b in zip(order, order[1:] + order[:1])]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" in plan and plan.count("rangepartitioning") >= 1


def test_hashes_of_a_plain_definition():
    """The k smallest of independent 64-bit mixes of whole shingles, from Python's integers."""
    import xxhash

    def mix(x):
        x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) % 2**64
        x = ((x ^ x >> 27) * 0x94D049BB133111EB) % 2**64
        return x ^ x >> 31

    def plain(text, k=128, n=5):
        words = text.lower().split()
        found = set()
        for i in range(max(1, len(words) - n + 1)) if words else ():
            own = words[i : i + n]
            value = min(n, len(words))
            for word in own:
                value = mix((value + xxhash.xxh64(word.encode(), seed=7).intdigest()) % 2**64)
            found.add(value >> 4)
        return sorted(found)[:k]

    for text in ("", "one", "a b c d", odd.prose(1, 5), odd.prose(2, 400), "same " * 50):
        assert bottom_k(text).tolist() == plain(text)


def test_query_by_hand(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    ids = sorted(texts)
    import hashlib

    for r in QUERIES["op8_document_fingerprints"](spark, sf_dir).collect():
        text, after = texts[r.doc_id], texts[ids[(ids.index(r.doc_id) + 1) % len(ids)]]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == "".join(f"{h:015x}" for h in bottom_k(text))
        assert r.edited_fingerprint == "".join(f"{h:015x}" for h in bottom_k(edited))
        a, b, c = map(shingles, (text, edited, after))
        assert r.near_edited == pytest.approx(len(a & b) / len(a | b), abs=0.2)
        assert r.near_next == pytest.approx(len(a & c) / len(a | c), abs=0.2)


@pytest.mark.parametrize("clashing", [False, True])
def test_odd_documents(spark, clashing):
    docs = odd.table(spark, clashing=clashing)
    found = with_sketches(docs, {"text": "sketch"})
    assert found.columns == [*docs.columns, "sketch"]
    assert {(r.text, tuple(r.sketch)) for r in found.collect()} == {(r[1], tuple(bottom_k(r[1] or "").tolist())) for r in odd.odd_rows()}
    assert with_sketches(odd.empty(spark), {"text": "sketch"}).collect() == []
