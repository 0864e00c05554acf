import hashlib
import random
import re
import time

import odd
import pytest
from pyspark.sql import functions as F

from casecast.llm import pii
from casecast.llm.pii import KINDS, _share, redact, summary, with_private

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value // 10 + value % 10
    return total % 10 == 0


def plain(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")),
                "card": lambda: 13 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]()
            if good:
                found.append(f"{kind}:{m.start()}:{m.end()}")
    return found


CARD, PHONE, IP = "4465758382889437", "+1 (988) 555-2485", "74.213.31.89"

ODD_TEXTS = [
    "a@b.c",
    "x.a_b%+-@d-e.f-g.h..i a@b a@.b @c.d e@f.",
    "a@b.co_x@y.zz a@b.c@d.e é.a@ñ.b",
    "1.2.3.4.5.6.7.8 1.2.3 256.1.1.1 0.0.0.00255 1..2.3.4 12.34.56.78.",
    f"{CARD} {CARD}",
    f"{CARD[:4]} {CARD[4:8]}-{CARD[8:12]} {CARD[12:]}",
    f"{CARD[:4]}  {CARD[4:]} 5 {CARD}- {CARD[:-1]}1",
    "0000000000000 00000000000000000000 1 2 3",
    f"{PHONE} +1 +12 3 +123456789 +1234567890123456 ++4420 7946 0958) +1(2",
    f"\x01\x02 {CARD}\x04\x05{IP}\x03 \x04{PHONE}\x05",
    f"\U0001f600é中 {IP} \U0001f600 a@b.c \U0001f600{CARD}",
    "9" * 3000 + " " + "1 " * 3000 + "a." * 3000 + "@" + "b." * 3000 + "c",
    "1.1.1.1." * 2000 + "+" * 50 + "+1" + " ()" * 2000,
    f"mail me {IP} or call {PHONE}, card {CARD}.",
]


def table(spark, clashing=False):
    rows = odd.odd_rows() + [(100 + i, text, "en", "s", 1) for i, text in enumerate(ODD_TEXTS)]
    return rows, odd.table(spark, rows, clashing)


@pytest.mark.parametrize("clashing", [False, True])
def test_strict_spans_of_odd_texts(spark, clashing):
    rows, docs = table(spark, clashing)
    done = with_private(docs).select("doc_id", "text", *summary()).collect()
    assert len(done) == len(rows)
    for r in done:
        expected = plain(r.text)
        assert set(expected) <= set(r.spans.split(",")) | {""}, r.doc_id
        assert r.base_sha256 == hashlib.sha256(",".join(expected).encode()).hexdigest(), r.doc_id
        assert [r[f"n_{kind}"] for kind in KINDS] == [sum(x.startswith(kind) for x in expected) for kind in KINDS]


@pytest.mark.parametrize("seed", range(2))
def test_strict_spans_of_random_texts(spark, seed):
    draw = random.Random(seed)
    parts = ["a", "Z", "@", ".", "-", "_", "+", " ", "  ", "(", ")", "\n", "é", "1", "0", "255", "256", CARD, PHONE, IP, "a@b.cd", "\x04", "\x05"]
    rows = [(i, "".join(draw.choice(parts) for _ in range(draw.randrange(40)))) for i in range(300)]
    for r in with_private(odd.table(spark, rows)).select("doc_id", "text", *summary()).collect():
        assert r.base_sha256 == hashlib.sha256(",".join(plain(r.text)).encode()).hexdigest(), repr(r.text)


def training_rows():
    """Texts with valid and with broken data, and unsettled ones that look like the valid."""
    draw, rows = random.Random(1), []
    def card():
        digits = "".join(draw.choice("0123456789") for _ in range(15))
        return next(digits + x for x in "0123456789" if luhn(digits + x))
    for i in range(400):
        good = card()
        bad = good[:-1] + str((int(good[-1]) + 1) % 10)
        phone = f"({draw.randrange(200, 999)}) {draw.randrange(200, 999)}-{draw.randrange(1000, 9999)}"
        rows.append((i, f"the {good} and {bad}, or +1 {phone}. {draw.randrange(256)}.{draw.randrange(256)}.{draw.randrange(256)}.{draw.randrange(256)}"))
        rows.append((1000 + i, f"on {draw.randrange(1900, 2099)}-{draw.randrange(10, 13)}-{draw.randrange(10, 28)} at 300.2.3.{i % 256} x"))
    return rows


def test_proposals_are_added_where_the_trees_are_sure(spark):
    rows = training_rows()
    unsettled = [(5000, f"cards {CARD} {CARD} here"), (5001, "nothing but words"), (5002, "on 2020-11-12 and 1999-10-10")]
    found = {r.doc_id: r for r in with_private(odd.table(spark, rows + unsettled)).select("doc_id", *summary()).collect()}
    assert found[5000].spans == "card:6:22,card:23:39" and found[5000].n_card == 0
    assert found[5001].spans == "" and found[5002].spans == ""
    for r in rows:
        assert set(plain(r[1])) <= set(found[r[0]].spans.split(",")) | {""}


def test_redacted_text(spark):
    rows = [(1, f"é mail a@b.c, {IP} and {CARD}!"), (2, None), (3, "plain")]
    done = with_private(odd.table(spark, rows))
    found = {r.doc_id: r.t for r in done.select("doc_id", redact(done).alias("t")).collect()}
    assert found == {1: "é mail [EMAIL], [IP] and [CARD]!", 2: "", 3: "plain"}


def test_empty(spark):
    assert with_private(odd.empty(spark)).collect() == []


def phone_rows():
    """Texts with valid international numbers, and with numbers that are too short, too long or no phones."""
    draw, rows = random.Random(2), []
    def number(n):
        return "".join(draw.choice("123456789") for _ in range(n))
    for i in range(400):
        phone = [f"+1 ({number(3)}) {number(3)}-{number(4)}", f"+44 {number(2)} {number(4)} {number(4)}", f"+49 {number(3)} {number(3)} {number(2)} {number(2)}"][i % 3]
        rows.append((2000 + i, f"please call {phone} today, not {number(2)} {number(3)} {number(2)} or {number(4)} {number(5)} {number(5)} {number(5)}, room"))
    return rows


def test_national_phones_are_added(spark):
    phones = ["(988) 555-2485", "020 7946 0958", "0171 555 26 26", "+(44) 20 7946 0958"]
    unsettled = [(5000 + i, f"please call {phone} today") for i, phone in enumerate(phones)]
    docs = odd.table(spark, training_rows() + phone_rows() + unsettled)
    found = {r.doc_id: r for r in with_private(docs).select("doc_id", *summary()).collect()}
    for i, phone in enumerate(phones):
        assert found[5000 + i].spans == f"phone:12:{12 + len(phone)}" and found[5000 + i].n_phone == 0, phone


def test_rare_kinds_stay_in_the_sample(spark):
    draw = random.Random(3)
    hot = [(10_000 + i, " and ".join(f"{draw.randrange(400)}.2.{draw.randrange(256)}.{draw.randrange(256)}" for _ in range(40))) for i in range(600)]
    docs = odd.table(spark, training_rows()[::4] + hot + [(5000, f"cards {CARD} {CARD} here")])
    for most_rows in (400, 100_000):
        found = with_private(docs, most_rows=most_rows).where("doc_id = 5000").select(*summary()).first()
        assert found.spans == "card:6:22,card:23:39", most_rows


def test_share():
    assert _share([5, 100, 1], 1000) == 100 and _share([5, 100, 1], 46) == 40 and _share([10, 10], 10) == 5


def test_phones_that_end_like_a_year_are_added(spark):
    phones = ["(212) 555-1987", "030 1234 2014"]
    unsettled = [(5000 + i, f"please call {phone} today") for i, phone in enumerate(phones)]
    unsettled += [(6000, "on 10-12-2014 and 2014 12 10")]
    docs = odd.table(spark, training_rows() + phone_rows() + unsettled)
    found = {r.doc_id: r.spans for r in with_private(docs).select("doc_id", *summary()).collect()}
    assert [found[5000 + i] for i in range(2)] == [f"phone:12:{12 + len(phone)}" for phone in phones] and found[6000] == ""


def test_leftmost_of_overlapping_proposals_stay(spark, monkeypatch):
    monkeypatch.setattr(pii, "_scored", lambda trees, rows: rows.withColumn("p", F.lit(1.0)))
    spans = {1: [(0, 0, 10), (1, 5, 15), (2, 12, 20)], 2: [(3, 0, 4), (2, 0, 9), (1, 4, 8), (0, 9, 12)], 3: [(2, 7, 9)]}
    draw = random.Random(4)
    for doc in range(10, 40):
        spans[doc] = [(draw.randrange(4), a, a + draw.randrange(1, 9)) for a in draw.sample(range(30), 12)]
    rows = [(doc, *span) for doc, own in spans.items() for span in own]
    proposals = spark.createDataFrame(rows, "key int, kind int, start bigint, end bigint")
    judge = pii.Judge(object(), dict.fromkeys(range(4), 0.9))
    found, expected = {doc: [] for doc in spans}, {doc: [] for doc in spans}
    for r in judge.accepted(proposals).collect():
        found[r.key].append((r.start, r.end, r.kind))
    for doc, own in spans.items():
        for kind, start, end in sorted(own, key=lambda s: (s[1], -s[2], s[0])):
            if not expected[doc] or start >= expected[doc][-1][1]:
                expected[doc].append((start, end, kind))
    assert expected[1] == [(0, 10, 0), (12, 20, 2)] and {doc: sorted(own) for doc, own in found.items()} == expected


def test_a_long_text_full_of_personal_data(spark):
    draw, pieces = random.Random(4), []
    for _ in range(4_000_000 // 16):
        pieces.append(draw.choice([CARD, PHONE, IP, "user@b.co", f"{draw.randrange(10**8)}"]))
    begun = time.time()
    (row,) = with_private(odd.table(spark, [(1, ", ".join(pieces))])).select(*summary()).collect()
    assert time.time() - begun < 120  # about 35 s on four cores
    expected = [pieces.count(piece) for piece in ("user@b.co", IP, CARD, PHONE)]
    assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == expected


def test_no_python_and_no_frame_that_looks_ahead_in_the_plan(spark):
    found = pii._near_strict(pii.candidates(odd.table(spark), "doc_id", "text"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert "unboundedpreceding$(), -1" in plan and "1, unboundedfollowing$()" not in plan
