"""Personal data in texts: strict patterns, and looser candidates that boosted trees judge."""

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from casecast.llm.common import DOC_ID, TEXT, row_key, sha256, text_or_empty
from casecast.session import checkpoint_dir, staged

KINDS = ["email", "ip", "card", "phone"]

# Characters that mark matches and joints while a text is searched; a text's own are put out of the way first. They are
# one code point for one, so positions stay.
MATCH, MATCH_END, OTHER, SEPARATOR, DOT = "\x01", "\x02", "\x03", "\x04", "\x05"

_LOCAL = r"A-Za-z0-9._%+\x05-"

#: The strict patterns as they are searched. Repeated groups and nested repeats would recurse or try every start of a
#: very long run, so joints between digits or labels are first marked one for one, and runs are possessive and begin
#: where a run or the last match ends. They match what the contract's patterns match.
STRICT = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++\x05[A-Za-z0-9\x05-]++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9][0-9\x04]++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

#: High-recall patterns; what they propose may overlap strict matches and each other.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?: ?(?:\(at\)|\[at\]|@) ?[A-Za-z0-9-]{1,63}+"
    r"(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{2,24}+){1,4}| at [A-Za-z0-9-]{1,63}+(?: dot [A-Za-z0-9-]{2,24}+){1,4})",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:(?:\.| ?[\[(]\.[\])] ?)[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}[ ./_-]{0,2}[0-9]{4,6}[ ./_-]{0,2}[0-9]{4,5}[ ./_-]{0,2}[0-9]{1,4}(?![0-9])",
    "phone": r"(?:\+|(?<![0-9]))\(?[0-9]{1,4}\)?(?:[ .()/-]{1,2}[0-9]{2,5}){2,4}(?![0-9])",
}

FEATURES = (
    [f"is_{kind}" for kind in KINDS]
    + "chars digits letters groups first_group last_group luhn octets dotted brackets".split()
    + [f"says_{kind}" for kind in KINDS]
    + "space_before space_after".split()
)

# Words near a candidate that speak for its kind, in four languages.
CUES = {
    "email": "mail|correo|contact|kontakt",
    "ip": r"\bip\b|addr|host|server|adres",
    "card": "card|visa|master|amex|karte|carte|tarjeta",
    "phone": r"phone|\btel|call|mobil|fax|anruf|appel|llam",
}


def _marked(text, kind, strict):
    """`text` with every match between two marks; null where there can be none."""
    if kind == "email":
        joined = F.regexp_replace(text, r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", DOT) if strict else text
        possible = text.contains("@") if strict else text.rlike(r"@|[(\[]at[)\]]| at ")
    elif kind == "card":
        joined = F.regexp_replace(text, r"(?<=[0-9])[ -](?=[0-9])", SEPARATOR) if strict else text
        possible = text.rlike(r"[0-9][ ./_-]{0,2}[0-9]")
    else:
        joined, possible = text, text.rlike(r"\+[0-9]" if kind == "phone" and strict else "[0-9][^0-9A-Za-z]{1,5}[0-9]")
    pattern = (STRICT if strict else LOOSE)[kind]
    return F.when(possible, F.regexp_replace(joined, pattern, f"{MATCH}$0{MATCH_END}"))


def _luhn(digits):
    """Whether 13 to 19 digits pass Luhn's check."""
    back = F.reverse(digits)
    places = F.sequence(F.lit(1), F.length(digits))

    def value(i):
        digit = back.substr(i, F.lit(1)).cast("int") * (2 - i % 2)
        return F.floor(digit / 10) + digit % 10

    total = F.aggregate(F.transform(places, value), F.lit(0).cast("bigint"), lambda a, b: a + b)
    return F.length(digits).between(13, 19) & (F.when(F.length(digits).between(13, 19), total) % 10 == 0)


def _small_octets(numbers):
    """Whether all runs of digits are at most 255."""
    plain = F.transform(numbers, lambda x: F.regexp_replace(x, "^0+(?=.)", ""))
    return F.forall(plain, lambda x: (F.length(x) <= 3) & (F.when(F.length(x) <= 3, x.cast("int")) <= 255))


def candidates(docs, id_col=DOC_ID, text_col=TEXT):
    """Strict matches and loose proposals of every text: `key`, `kind`, `strict`, `start`, `end` and features.

    A loose phone with a country code has a second row, marked `home`, with the features of the number without it.

    Each pattern puts marks around its matches; splitting at the marks gives the matches and what lies between, and
    running sums of lengths over one document's pieces give positions. Only pieces around matches, shortened to a few
    characters of context, are shuffled, never texts.
    """
    text = F.translate(text_or_empty(text_col), MATCH + MATCH_END + SEPARATOR + DOT, OTHER * 4)
    found = docs.select(row_key(id_col, text_col).alias("key"), text.alias("text"))
    found = found.where(F.col("text").rlike(r"[0-9@]|at[)\]]| at "))
    searches = [
        F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            F.lit(strict).alias("strict"),
            F.split(_marked(F.col("text"), kind, strict), MATCH).alias("parts"),
        )
        for kind in KINDS
        for strict in (True, False)
    ]
    hits = F.explode(F.filter(F.array(*searches), lambda s: F.size(s["parts"]) > 1)).alias("hit")
    parts, n = F.col("hit.parts"), F.size("hit.parts")
    pairs = F.arrays_zip(F.slice(parts, 1, n - 1).alias("before"), F.slice(parts, 2, n - 1).alias("part"))
    listed = found.select("key", hits).select(
        "key", F.col("hit.kind").alias("kind"), F.col("hit.strict").alias("strict"), F.posexplode(pairs).alias("nth", "pair")
    )
    between = F.substring_index("pair.before", MATCH_END, -1)
    match = F.substring_index("pair.part", MATCH_END, 1)
    matches = listed.select(
        "key",
        "kind",
        "strict",
        "nth",
        F.translate(match, DOT + SEPARATOR, ". ").alias("match"),
        F.char_length(match).alias("chars"),
        F.char_length(between).alias("gap"),
        F.lower(F.right(between, F.lit(24))).alias("left"),
        F.left(F.substring_index("pair.part", MATCH_END, -1), F.lit(12)).alias("right"),
    )
    # Rows that repeat an id and its text give the same pieces; one of each stays.
    one = matches.repartition("key", "kind", "strict").dropDuplicates(["key", "kind", "strict", "nth"])
    running = Window.partitionBy("key", "kind", "strict").orderBy("nth")
    end = F.sum(F.col("gap") + F.col("chars")).over(running)
    placed = one.withColumns({"end": end, "start": end - F.col("chars")})
    numbers = F.regexp_extract_all("match", F.lit("([0-9]+)"), F.lit(1))
    # A phone number with a country code also shows what it looks like without; the trees learn from that, too.
    home = F.regexp_replace("match", r"^\+\(?[0-9]+\)?[ ./-]*", "")
    is_phone = (F.col("kind") == KINDS.index("phone")) & ~F.col("strict") & F.col("match").startswith("+")
    forms = F.array(F.struct("match", "chars", F.lit(False).alias("home")))
    both = F.concat(forms, F.array(F.struct(home.alias("match"), F.char_length(home).alias("chars"), F.lit(True).alias("home"))))
    has_home = is_phone & home.rlike(f"^{LOOSE['phone']}$")
    form = F.explode(F.when(has_home, both).otherwise(forms)).alias("form")
    placed = placed.select("key", "kind", "strict", "start", "end", "left", "right", form).select("*", "form.*")
    digits = F.regexp_replace("match", "[^0-9]", "")
    count = F.length(digits)
    with_numbers = placed.withColumns({"numbers": numbers, "digits": count, "luhn": _luhn(digits)})
    octets = _small_octets(F.col("numbers"))
    valid = (
        F.when(F.col("kind") == 0, True)
        .when(F.col("kind") == 1, octets)
        .when(F.col("kind") == 2, F.col("luhn"))
        .otherwise(F.col("digits").between(9, 15))
    )
    groups = F.size("numbers")
    features = {f"is_{kind}": F.col("kind") == i for i, kind in enumerate(KINDS)} | {
        "letters": F.length(F.regexp_replace("match", "[^A-Za-z]", "")),
        "groups": groups,
        "first_group": F.coalesce(F.length(F.get("numbers", F.lit(0))), F.lit(0)),
        "last_group": F.coalesce(F.length(F.get("numbers", groups - 1)), F.lit(0)),
        "octets": octets & (groups == 4),
        "dotted": F.col("match").contains("."),
        "brackets": F.col("match").rlike(r"[()\[\]]"),
        "space_before": (F.col("left") == "") | F.col("left").rlike(r"\s$"),
        "space_after": (F.col("right") == "") | F.col("right").rlike(r"^[\s.,;:!?)]"),
    }
    features |= {f"says_{kind}": F.concat("left", F.lower("right")).rlike(cue) for kind, cue in CUES.items()}
    numeric = {name: value.cast("double") for name, value in features.items()}
    whole = with_numbers.withColumns({"valid": valid, **numeric})
    spans = whole.withColumns({name: F.col(name).cast("double") for name in ("chars", "digits", "luhn")})
    day, year = "[0-9]{1,2}", "(?:19|20)[0-9]{2}"
    dated = F.col("match").rlike(f"^{year}[ ./-]{day}[ ./-]{day}$|^{day}[ ./-]{day}[ ./-]{year}$")
    return spans.select("key", "kind", "strict", "start", "end", "valid", "home", dated.alias("dated"), *FEATURES)


def _near_strict(found):
    """Adds `taken`, whether a valid strict match overlaps a candidate, `own`, whether one of its kind does, and `same`,
    whether that one has its span.

    What comes before and what comes after a candidate are running values in the two directions of one order, so a text
    with many candidates takes time by their number.
    """
    order = ["start", "end", "kind", "strict"]
    onward = Window.partitionBy("key").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    backward = Window.partitionBy("key").orderBy(*[F.col(c).desc() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    sure = F.col("strict") & F.col("valid")

    def overlapped(kind):
        match = sure & (F.col("kind") == kind)
        until = F.max(F.when(match, F.col("end"))).over(onward)
        after = F.min(F.when(match, F.col("start"))).over(backward)
        return F.coalesce(until > F.col("start"), F.lit(False)) | F.coalesce(after < F.col("end"), F.lit(False))

    by_kind = F.array(*map(overlapped, range(len(KINDS)))).alias("by_kind")
    same = F.max(sure).over(Window.partitionBy("key", "kind", "start", "end")).alias("same")
    met = found.select("*", by_kind, same)
    return met.withColumns({"taken": F.exists("by_kind", lambda x: x), "own": F.get("by_kind", "kind")}).drop("by_kind")


@dataclass
class Judge:
    """Boosted trees over candidates, and per kind the probability from which a candidate is redacted."""

    trees: object
    thresholds: dict

    def accepted(self, proposals):
        """The loose proposals to redact, without overlaps: the leftmost of those that overlap, and of these the longest."""
        if self.trees is None:
            return proposals.where("false").select("key", "kind", "start", "end")
        scored = _scored(self.trees, proposals)
        least = F.lit(2.0)
        for kind, threshold in self.thresholds.items():
            least = F.when(F.col("kind") == kind, threshold).otherwise(least)
        good = scored.where(F.col("p") >= least)
        order = Window.partitionBy("key").orderBy("start", F.col("end").desc(), "kind")
        until = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
        chain = F.count(F.when(F.col("start") >= F.col("until"), 1)).over(order)
        # What overlaps nothing before it begins a chain; proposals of a chain are taken one after the other.
        chains = good.withColumn("until", until).withColumn("chain", chain)
        span = F.struct("start", (-F.col("end")).alias("back"), "kind")
        listed = chains.groupBy("key", "chain").agg(F.sort_array(F.collect_list(span)).alias("spans"))

        def step(kept, span):
            free = span["start"] >= -F.get(kept, F.size(kept) - 1)["back"]
            return F.when(free, F.concat(kept, F.array(span))).otherwise(kept)

        rest = F.slice("spans", 2, F.greatest(F.size("spans"), F.lit(1)))
        taken = F.aggregate(rest, F.slice("spans", 1, 1), step)
        one = listed.select("key", F.explode(taken).alias("span"))
        return one.select("key", "span.kind", "span.start", (-F.col("span.back")).alias("end"))


def _scored(trees, rows):
    features = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
    return trees.transform(features).withColumn("p", vector_to_array("probability")[1])


def _share(sizes, most):
    """The size that larger groups are cut to, so that all have about `most` rows together."""
    sizes = sorted(sizes)
    for i, size in enumerate(sizes):
        if size * (len(sizes) - i) > most:
            return most / (len(sizes) - i)
        most -= size
    return sizes[-1]


def fit_judge(found, most_rows=100_000, rounds=15, depth=3, precision=0.98, least_p=0.9, seed=5):
    """Train on what the strict rules settle: `found` has candidates with `taken`, `own` and `same`.

    Proposals at a valid strict match of their kind are positive, phones also as they would be written without their
    country code, as most of those to be judged are. Negative are those that break a hard rule of their
    kind (a part over 255, a failed check digit, too few or too many digits, a date) or lie on valid matches of other
    kinds only. The rest is unknown and judged later. The proposals of
    three in four texts train, at most about `most_rows` of them: groups of one kind and label that have more than their
    share are cut by a hash, and smaller ones stay whole. All others set the thresholds, without a sample: per kind the
    least probability (not below `least_p`) from which at least `precision` of them are positive, counted in 100 bins. A
    kind without held-out positives adds nothing, nor does anything without both classes.
    """
    checkpoint_dir(found.sparkSession)
    bad = ~F.col("valid") | (F.col("taken") & ~F.col("own")) | F.col("dated")
    label = F.when(F.col("home"), F.when(F.col("same") & F.col("valid"), 1.0)).when(F.col("same"), 1.0).when(bad, 0.0)
    settled = found.where(~F.col("strict")).withColumn("label", label).where("label IS NOT NULL")
    place = F.pmod(F.xxhash64("key", "kind", "start", F.lit(seed)), F.lit(1 << 40))
    settled = settled.withColumn("held_out", F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(4)) == 0)
    training = settled.where("NOT held_out")
    sizes = training.groupBy("kind", "label").count().collect()  # 8 rows at most
    if len({row["label"] for row in sizes}) < 2:
        return Judge(None, {})
    share = _share([row["count"] for row in sizes], most_rows)
    below = F.lit(1 << 40)
    for row in sizes:
        if row["count"] > share:
            of_group = (F.col("kind") == row["kind"]) & (F.col("label") == row["label"])
            below = F.when(of_group, int((1 << 40) * share / row["count"])).otherwise(below)
    training = training.where(place < below)
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(training).select("features", "label")
    trees = GBTClassifier(maxIter=rounds, maxDepth=depth, seed=seed).fit(rows)
    p_bin = F.least(F.floor(F.col("p") * 100), F.lit(99)).cast("int").alias("bin")
    counts = _scored(trees, settled.where("held_out")).groupBy("kind", p_bin)
    counts = counts.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("good")).collect()  # 400 rows at most
    thresholds = {}
    for kind in range(len(KINDS)):
        seen = good = 0
        for row in sorted((r for r in counts if r["kind"] == kind), key=lambda r: -r["bin"]):
            seen, good = seen + row["n"], good + row["good"]
            if good and good >= precision * seen:
                thresholds[kind] = max(least_p, row["bin"] / 100)
    return Judge(trees, thresholds)


def find_private(docs, id_col=DOC_ID, text_col=TEXT, **settings):
    """`key` and `spans` (array of `kind`, `start`, `end`, `strict`; code points, end exclusive) of texts that have any.

    Strict matches that pass their checks are always among the spans; loose proposals are added where the trees are
    sure and no strict match overlaps. Spans are ordered by kind, start and end. Everything is DataFrame functions and
    Spark's boosted trees. `key` is `row_key` of the row. `settings` are those of `fit_judge`.
    """
    found = staged(_near_strict(candidates(docs, id_col, text_col)), "pii-candidates")
    judge = fit_judge(found, **settings)
    sure = found.where("strict AND valid").select("key", "kind", "start", "end", F.lit(True).alias("strict"))
    unknown = found.where("NOT strict AND NOT home AND valid AND NOT taken AND NOT same AND NOT dated")
    added = judge.accepted(unknown).withColumn("strict", F.lit(False))
    spans = F.sort_array(F.collect_list(F.struct("kind", "start", "end", "strict")))
    return sure.unionByName(added).groupBy("key").agg(spans.alias("spans"))


def with_private(docs, id_col=DOC_ID, text_col=TEXT, **settings):
    """The columns of `docs`, then `spans` as `find_private` gives them; an empty array where a text has none.

    Defined cases: a null text is empty and has no spans; a null id is a key like any other; rows that repeat an id
    and its text get the same spans. A very long text takes time by the number of its candidates. Of overlapping proposals the
    leftmost is taken, of these the longest. A column of `docs` called `spans` is replaced. An empty table gives an empty
    result.
    """
    found = find_private(docs, id_col, text_col, **settings)
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")
    rows = docs.select(row, row_key(id_col, text_col).alias("_k"))
    same = F.col("_k.id").eqNullSafe(F.col("key.id")) & (F.col("_k.h") == F.col("key.h")) & (F.col("_k.n") == F.col("key.n"))
    columns = [F.col("row").getField(name).alias(name) for name in docs.columns if name != "spans"]
    none = F.array().cast(found.schema["spans"].dataType)
    return rows.join(found, same, "left").select(*columns, F.coalesce("spans", none).alias("spans"))


def redact(with_spans, text_col=TEXT):
    """The text with each span replaced by its kind in brackets; of spans that overlap, the leftmost counts."""
    kinds = F.array(*[F.lit(f"[{kind.upper()}]") for kind in KINDS])
    text = text_or_empty(text_col)
    by_start = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"], s["end"], s["kind"])))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("done"))

    def step(so_far, span):
        gap = text.substr((so_far["at"] + 1).cast("int"), (span["start"] - so_far["at"]).cast("int"))
        more = F.concat(so_far["done"], gap, F.get(kinds, span["kind"]))
        nexts = F.struct(span["end"].cast("bigint").alias("at"), more.alias("done"))
        return F.when(span["start"] >= so_far["at"], nexts).otherwise(so_far)

    def finish(so_far):
        return F.concat(so_far["done"], text.substr((so_far["at"] + 1).cast("int"), F.char_length(text)))

    return F.aggregate(by_start, start, step, finish)


def spans_text(spans):
    """Spans as `kind:start:end`, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def summary(spans="spans"):
    """Counts of strict spans by kind, the digest of their list, and the list of all spans."""
    strict = F.filter(spans, lambda s: s["strict"])

    def count(i):
        return F.size(F.filter(strict, lambda s: s["kind"] == i)).cast("bigint")

    counts = [count(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)]
    return [*counts, sha256(spans_text(strict)).alias("base_sha256"), spans_text(spans).alias("spans")]
