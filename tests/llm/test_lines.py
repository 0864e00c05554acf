import re

import odd
import pytest

from casecast.llm.lines import dedup_lines

SPACES = " \t\n\x0b\x0c\r"


def plain(rows, min_chars=20, min_docs=3):
    keys = lambda text: [re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(SPACES)) for x in (text or "").split("\n")]
    held = {}
    for n, row in enumerate(rows):
        for key in set(keys(row[1])):
            held.setdefault(key, []).append(row[0])
    out = []
    for row in rows:
        lines = (row[1] or "").split("\n")
        stays = []
        for line, key in zip(lines, keys(row[1])):
            ids = [i for i in held[key] if i is not None]
            drop = len(key) >= min_chars and len(held[key]) >= min_docs and ids and row[0] != max(ids)
            stays += [] if drop else [line]
        out.append((row[0], "\n".join(stays), len(lines), len(lines) - len(stays)))
    return sorted(out, key=str)


@pytest.mark.parametrize("clashing", [False, True])
def test_odd_documents(spark, clashing):
    docs = odd.table(spark, clashing=clashing)
    done = dedup_lines(docs)
    assert [c for c in done.columns if c not in ("kept", "n_lines", "n_dropped")] == [c for c in docs.columns if c != "kept"]
    found = sorted(((r.doc_id, r.kept, r.n_lines, r.n_dropped) for r in done.collect()), key=str)
    assert found == plain(odd.odd_rows())
    assert sum(r[3] for r in found) > 5


def test_boundaries_of_length_and_count(spark):
    long, short, two = "x" * 20, "y" * 19, "z" * 30
    rows = [(i, f"{long}\n {short}\n{two if i < 2 else i}\n\n\t{long.upper()} \n") for i in range(4)]
    found = {r.doc_id: r for r in dedup_lines(odd.table(spark, rows)).collect()}
    assert [found[i].n_dropped for i in range(4)] == [2, 2, 2, 0]
    assert found[0].kept == f" {short}\n{two}\n\n" and found[3].kept == rows[3][1] and found[0].n_lines == 6


def test_all_lines_dropped_and_very_many_lines(spark):
    shared = [f"a line that all share {i}" for i in range(3000)]
    found = {r.doc_id: r for r in dedup_lines(odd.table(spark, [(i, "\n".join(shared)) for i in range(3)])).collect()}
    assert [(found[i].kept, found[i].n_dropped) for i in range(2)] == [("", 3000)] * 2
    assert found[2].kept == "\n".join(shared) and found[2].n_lines == 3000


def test_repeated_rows_count_once(spark):
    line, other = "a line that two documents hold", "a line that three documents hold"
    rows = [(1, f"{line}\n{other}"), (1, f"{line}\n{other}"), (2, f"{line}\n{other}"), (3, other)]
    found = sorted((r.doc_id, r.kept, r.n_dropped) for r in dedup_lines(odd.table(spark, rows)).collect())
    assert found == [(1, line, 1), (1, line, 1), (2, line, 1), (3, other, 0)]


def test_empty(spark):
    assert dedup_lines(odd.empty(spark)).collect() == []


def test_no_python_in_the_plan(spark):
    plan = dedup_lines(odd.table(spark))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
