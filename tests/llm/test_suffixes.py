import random
import unittest.mock

import numpy as np
import odd
import pytest

from casecast.llm import suffixes
from casecast.llm.suffixes import Shape, anchors, common_prefixes, decoded, front_coded, merge, remove_repeats
from casecast.session import staged


@pytest.fixture(autouse=True)
def small_filter(monkeypatch):
    monkeypatch.setattr(suffixes, "FILTER_BITS", 20)


def plain(rows, width):
    """Every string of every document, by brute force."""
    earliest, texts = {}, [(r[0], (r[1] or "").encode()) for r in rows]
    last = 1 << 62
    for doc_id, text in texts:
        for i in range(len(text) - width + 1):
            string = text[i : i + width]
            earliest[string] = min(earliest.get(string, last), last if doc_id is None else doc_id)
    out = []
    for doc_id, text in texts:
        gone = bytearray(len(text))
        for i in range(len(text) - width + 1):
            if earliest[text[i : i + width]] < (last if doc_id is None else doc_id):
                gone[i : i + width] = b"\1" * width
        spans = sum(1 for i, x in enumerate(gone) if x and not (i and gone[i - 1]))
        out.append((doc_id, bytes(b for b, x in zip(text, gone) if not x), len(text), sum(gone), spans))
    return sorted(out, key=str)


def found_by(frame):
    return sorted(((r.doc_id, bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in frame.collect()), key=str)


@pytest.mark.parametrize("clashing", [False, True])
def test_odd_documents(spark, clashing):
    docs = odd.table(spark, clashing=clashing)
    done = remove_repeats(docs)
    results = ["kept", "n_bytes", "n_removed", "n_spans", "spans"]
    assert [c for c in done.columns if c not in results] == [c for c in docs.columns if c not in results]
    expected = plain(odd.odd_rows(), 50)
    assert found_by(done) == expected and sum(r[3] for r in expected) > 300


def tangled(seed, docs=60):
    """Texts from few letters and shared passages, cut at any place, so that repeats start and end everywhere."""
    draw = random.Random(seed)
    passages = ["".join(draw.choice("ab \x00") for _ in range(draw.randrange(10, 200))) for _ in range(6)]
    rows = []
    for i in range(docs):
        parts = []
        for _ in range(draw.randrange(5)):
            passage = draw.choice(passages)
            a = draw.randrange(len(passage))
            parts += [passage[a : a + draw.randrange(120)], "".join(draw.choice("abé") for _ in range(draw.randrange(30)))]
        rows.append((draw.randrange(40) if i else None, "".join(parts)))
    return rows


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("width, crowd", [(50, 5_000), (50, 6), (16, 3)])
def test_tangled_texts(spark, monkeypatch, seed, width, crowd):
    monkeypatch.setattr(suffixes, "CROWD", crowd)
    monkeypatch.setattr(suffixes, "CROWD_LOCAL", 1)
    monkeypatch.setattr(suffixes, "PART_BYTES", 100)
    monkeypatch.setattr(suffixes, "RUN_BYTES", 300)
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 1000)
    rows = tangled(seed)
    docs = odd.table(spark, rows).repartition(3)
    assert found_by(remove_repeats(staged(docs, "tangled"), width)) == plain(rows, width)


def test_filter_that_lets_everything_through(spark, monkeypatch):
    shape = Shape(50)
    assert shape.gram == 24 and shape.span == 27
    plain_filter = suffixes.repeated_grams
    every = np.full((1 << suffixes.FILTER_BITS) // 8, 255, np.uint8)
    full = lambda *given: (suffixes._packed(every), plain_filter(*given)[1])
    monkeypatch.setattr(suffixes, "repeated_grams", full)
    assert found_by(remove_repeats(odd.table(spark))) == plain(odd.odd_rows(), 50)


def test_crowded_grams_are_found(spark):
    passage = odd.prose(7, 30)
    rows = [(i, f"{odd.prose(100 + i, 12)} {passage} {odd.prose(900 + i, 12)}") for i in range(300)]
    inputs = odd.table(spark, rows).selectExpr("doc_id AS id", "doc_id AS h", "CAST(text AS BINARY) AS text")
    with unittest.mock.patch.object(suffixes, "CROWD", 200):
        _, crowded = suffixes.repeated_grams(inputs, Shape(50))
    assert 1 <= len(crowded) <= 6  # those at the edges of the passage
    assert found_by(remove_repeats(odd.table(spark, rows))) == plain(rows, 50)


def sorted_rows(seed, n, width):
    draw = np.random.default_rng(seed)
    rows = draw.integers(0, 2, (n, width)).astype(np.uint8)
    rows[: n // 3] = rows[0]
    rows = rows[np.lexsort(rows.T[::-1])]
    return rows


@pytest.mark.parametrize("sizes", [[5], [0, 3], [7, 1, 30], [20] * 9, [0, 0], [40, 0, 3, 8, 1]])
def test_merge_and_front_coding(sizes):
    width = 9
    runs = [sorted_rows(i, n, width) if n else np.empty((0, width), np.uint8) for i, n in enumerate(sizes)]
    for rows in runs:
        if len(rows):
            assert (decoded(*front_coded(rows), width) == rows).all()
    listed = [(list(map(bytes, rows)), common_prefixes(rows).tolist() if len(rows) else []) for rows in runs]
    order, prefixes = merge(listed, width)
    at, merged = [0] * len(runs), []
    for run in order:
        merged.append(listed[run][0][at[run]])
        at[run] += 1
    assert merged == sorted(row for rows, _ in listed for row in rows)
    if merged:
        assert prefixes[1:] == common_prefixes(np.array([list(row) for row in merged], np.uint8)).tolist()[1:]


def test_each_string_has_one_anchor():
    shape, draw = Shape(50), np.random.default_rng(2)
    data = draw.integers(97, 100, 5000).astype(np.uint8)
    first, last, at, _ = anchors(data, np.array([1000, 1030, 5000]), shape)
    starts = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last)])
    assert starts.tolist() == [*range(0, 951), *range(1030, 4951)]
    assert (at >= last).all() and (at + shape.gram <= first + shape.width).all()


def test_empty(spark):
    assert remove_repeats(odd.empty(spark)).collect() == []


def marks(spark, texts):
    inputs = odd.table(spark, list(enumerate(texts))).selectExpr("doc_id AS id", "doc_id AS h", "CAST(text AS BINARY) AS text")
    return suffixes._unpacked(suffixes.repeated_grams(inputs, Shape(50))[0])[0]


def test_filter_takes_no_room_for_what_comes_once(spark):
    """Grams that come once must not fill the filter, however many there are: all later work grows with what passes."""
    draw = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz "
    texts = ["".join(draw.choices(letters, k=50_000)) for _ in range(80)]  # 300,000 grams in 2^20 bits
    assert np.unpackbits(marks(spark, texts)).mean() < 0.001
    again = marks(spark, [*texts[:40], *texts[:4]])
    assert 0.01 < np.unpackbits(again).mean() < 0.1


@pytest.mark.parametrize("depth", [0, 4, 9])
def test_filter_lets_all_repeats_through(depth):
    grams = np.random.default_rng(5).integers(0, 1 << 60, 30_000, dtype=np.uint64)
    keys = np.sort(suffixes._keys(grams))
    share = np.bincount((keys >> np.uint64(63 - depth) >> np.uint64(1)).astype(np.int64), minlength=1 << depth)
    assert share.max() < 2 * len(grams) / (1 << depth)  # slices are even, though least hashes are small
    size, slices, begin = 18, [], 0
    for count in share:
        low = suffixes._low(keys[begin : begin + count], depth)
        begin += count
        assert (suffixes._unlisted(suffixes._listed(low)) == low).all()
        blobs = [suffixes._packed(suffixes._listed(part)) for part in (low, low[::7], low[:0])]
        found = suffixes._repeated(size - depth)(suffixes.pd.DataFrame({"slice": 0, "salt": 0, "blob": blobs}))
        slices.append((low[::7], suffixes._unpacked(found["blob"].iloc[0])[0]))
    bits = np.concatenate([bits for _, bits in slices])
    passing = suffixes._passing(bits, depth, grams)
    again = np.isin(suffixes._low(suffixes._keys(grams), depth), np.concatenate([low for low, _ in slices]))
    assert passing[again].all() and passing.mean() < 0.25


@pytest.mark.parametrize("width", [16, 50])
def test_shared_strings_whatever_their_hashes(monkeypatch, width):
    """Strings of different texts around one gram, against brute force; also where all of them have one hash."""
    shape, draw = Shape(width), random.Random(6)
    gram = "g" * shape.gram
    texts = set()
    for _ in range(60):
        left = "".join(draw.choices("ab", k=2)) * (shape.span // 2)
        right = draw.choice(["xy", "x\0", "yy"]) * (shape.width // 2)
        left, right = left[: draw.randrange(shape.span)], gram + right[: shape.width - shape.gram]
        if len(left) + len(right) >= width:
            texts.add((left.encode(), right.encode()))
    texts = sorted(texts)
    rows = np.zeros((len(texts), shape.row), np.uint8)
    for row, (left, right) in zip(rows, texts):
        row[: len(left) + len(right)] = list(right + left[::-1])
        row[-2:] = len(right), len(left)
    least = np.array([draw.randrange(20) for _ in texts])
    earliest = {}
    for (left, right), own in zip(texts, least):
        for i in range(len(left + right) - width + 1):
            string = (left + right)[i : i + width]
            earliest[string] = min(earliest.get(string, 99), own)
    expected = {
        (t, i + j)
        for t, (left, right) in enumerate(texts)
        for i in range(len(left + right) - width + 1)
        for j in range(width)
        if earliest[(left + right)[i : i + width]] < least[t]
    }
    for mixed in (suffixes._mixed, lambda words: np.zeros(len(words[0]), np.uint64)):
        monkeypatch.setattr(suffixes, "_mixed", mixed)
        found = zip(*suffixes._shared_strings(rows, least, shape))
        assert {(t, i) for t, begin, reach in found for i in range(begin, begin + reach)} == expected and expected


def test_runs_are_decoded_together():
    runs = [sorted_rows(i, n, 9) for i, n in enumerate([30, 1, 12])]
    parts = [np.concatenate(x) for x in zip(*map(front_coded, runs))]
    assert (decoded(*parts, 9) == np.concatenate(runs)).all()
