"""Small tables with everything that can be odd about documents."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

#: Names that operators use inside, as extra columns of the input.
CLASHING = "row string, key string, id string, kept string, size string, fp string, spans string, hash string, copies string"

WORDS = "the of and river stone light under open house garden winter seven carry small between morning".split()


def prose(seed, words):
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + (draw.choice(["", "", "s", "ing"])) for _ in range(words))


def odd_rows():
    base = prose(1, 60)
    return [
        (1, base, "en", "a", 1),
        (2, base, "en", "a", 1),  # an exact copy
        (2, base, "en", "a", 1),  # a repeated row
        (3, base.replace("river", "rivers", 1), "en", None, 1),
        (4, None, None, None, None),
        (5, "", "en", "b", 0),
        (6, " \n\t\x0b\x0c\r ", "en", "b", 7),
        (7, "one", "en", "b", 3),
        (8, "one two", "en", "b", 7),
        (9, "é 中文 \U0001f600 ñ\n" + prose(2, 40), "es", "é", None),
        (10, "x" * 20_000, "en", "c", 20_000),
        (11, prose(3, 6_000), "en", "c", None),
        (12, "\n".join([prose(4, 12)] * 4 + [base] + [prose(5, 12)]), "en", "c", None),
        (13, "\n".join([prose(4, 12), base, "  " + prose(5, 12).upper() + " "]), "en", "c", None),
        (14, "\n".join([prose(5, 12), prose(4, 12), "last"]), "en", "c", None),
        (None, prose(4, 12), "en", "c", None),
        (None, None, None, None, None),
        (-5, base + " tail", "en", "a", None),
    ]


def table(spark, rows=None, clashing=False):
    rows = odd_rows() if rows is None else rows
    rows = [row if len(row) == 5 else (row[0], row[1], "en", "s", None) for row in rows]
    if not clashing:
        return spark.createDataFrame(rows, SCHEMA)
    extra = tuple(CLASHING.split(", "))
    return spark.createDataFrame([row + ("mine",) * len(extra) for row in rows], f"{SCHEMA}, {CLASHING}")


def empty(spark, clashing=False):
    return table(spark, clashing=clashing).where("false")
