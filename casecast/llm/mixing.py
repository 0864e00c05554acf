"""Mixing sources to target weights by thresholds on a hash of the document."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from casecast.llm.common import DOC_ID, TEXT, broadcast_if_few, word_count
from casecast.session import staged

# The hash is the first 15 hex digits of an MD5, cut into five levels of 12 bits.
HASH_DIGITS = 15
HASH_BITS = 60
LEVEL_BITS = 12

#: Most sources whose thresholds are broadcast; a row of that table is a name and a few numbers.
BROADCAST_SOURCES = 20_000


def mix_hash(id_col=DOC_ID, seed="mix"):
    """A document's place in [0, 2^60), the same on every run, engine and layout."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("bigint")


def source_targets(sizes, weights=(5, 2, 1), max_repeats=3):
    """Per source (`source`, `source_size`) its `target`: its share of all sizes by weight, up to a bound.

    The bound is `max_repeats` times the source's size.

    Sources are ranked by code point, null last, and take the weights in turn. What goes beyond a source's bound is
    shared out again by weight until none is above. That fixed point is least(bound, weight * level) for one level;
    with the sources ordered by bound / weight, those below some rank are at their bounds, and the level follows from
    two running sums. The windows run over one row per source.
    """
    by_rank = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(w).cast("bigint") for w in weights]),
        ((F.row_number().over(by_rank) - 1) % len(weights) + 1).cast("int"),
    )
    ranked = sizes.select("source", "source_size", weight.alias("weight"), F.row_number().over(by_rank).alias("rank"))
    bound = F.col("source_size") * max_repeats
    fill = Window.orderBy(F.col("source_size").cast("double") / F.col("weight"), "rank")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    from_here = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everywhere = fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everywhere) - F.coalesce(F.sum(bound).over(before), F.lit(0))
    level = left.cast("double") / F.sum("weight").over(from_here)
    levels = ranked.withColumns({"bound": bound, "level": level})
    fits = F.when(F.col("bound") >= F.col("weight") * F.col("level"), F.col("level"))
    first_fit = F.first(fits, ignorenulls=True).over(everywhere)
    target = F.least(F.col("bound").cast("double"), F.col("weight") * first_fit)
    return levels.select("source", "source_size", target.alias("target"))


def _thresholds(sized, targets, max_repeats):
    """Per source: `base` copies of every document, and one more of those whose hash is below `threshold`.

    Sizes are added up per source and hash bucket; the bucket in which the budget runs out is cut again by the next
    bits, until it holds a single hash. Documents of that hash go in if that brings the sum nearer to the budget.
    Each level reads the rows of its boundary buckets only, keeps one sum per bucket, and sorts no documents.
    """
    size, target = F.col("source_size"), F.col("target")
    base = F.when(size > 0, F.least(F.floor(target / size), F.lit(max_repeats))).otherwise(0).cast("bigint")
    state = targets.select(
        "source",
        base.alias("base"),
        (target - base * size).alias("budget"),
        F.lit(0).cast("bigint").alias("low"),
    )
    spark = sized.sparkSession
    open_, done = staged(state, "mix-level"), None
    for bits in range(HASH_BITS, 0, -LEVEL_BITS):
        if open_.isEmpty():
            break
        width = 1 << (bits - LEVEL_BITS)
        names = broadcast_if_few(open_.withColumnRenamed("source", "name"), BROADCAST_SOURCES)
        inside = sized.join(names, F.col("source").eqNullSafe(F.col("name"))).where(
            (F.col("hash") >= F.col("low")) & (F.col("hash") - F.col("low") < F.lit(1 << bits))
        )
        bucket = F.floor((F.col("hash") - F.col("low")) / F.lit(width)).alias("bucket")
        if width == 1:
            bucket = (F.col("hash") - F.col("low")).alias("bucket")
        sums = inside.groupBy("source", "base", "budget", "low", bucket).agg(
            F.sum("size").alias("sum"), F.min("hash").alias("first"), F.max("hash").alias("last")
        )
        running = Window.partitionBy("source").orderBy("bucket")
        filled = sums.withColumn("filled", F.sum("sum").over(running))
        over = filled.where(F.col("filled") > F.col("budget"))
        found = F.struct("bucket", "sum", "filled", "first", "last")
        at = over.groupBy("source").agg(F.min_by(found, "bucket").alias("at"))
        met = open_.join(at.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name")), "left")
        before = F.col("at.filled") - F.col("at.sum")
        single = F.col("at.first") == F.col("at.last")
        nearer = (F.col("at.filled") - F.col("budget")) < (F.col("budget") - before)
        threshold = (
            F.when(F.col("at").isNull(), F.lit(1 << HASH_BITS))
            .when(nearer, F.col("at.last") + 1)
            .otherwise(F.col("at.first"))
        )
        level = met.select(
            "source",
            "base",
            (F.col("at").isNull() | single).alias("closed"),
            threshold.alias("threshold"),
            (F.col("budget") - before).alias("budget"),
            (F.col("low") + F.col("at.bucket") * F.lit(width)).cast("bigint").alias("low"),
        )
        level = staged(level, "mix-level")
        closed = level.where("closed").select("source", "base", "threshold")
        done = closed if done is None else done.unionByName(closed)
        open_ = level.where("NOT closed").select("source", "base", "budget", "low")
    if done is None:
        kind = sized.schema["source"].dataType.simpleString()
        done = spark.createDataFrame([], f"source {kind}, base bigint, threshold bigint")
    return done


def mix(
    docs, weights=(5, 2, 1), max_repeats=3, seed="mix", id_col=DOC_ID, text_col=TEXT, source_col="source"
):
    """The columns of `docs`, then `size`, `source_size`, `target` and `copies`, how often the mix takes the row.

    A document's size is its number of words. Sources share the sum of all sizes as `source_targets` says. Every
    document of a source is taken floor(target / source_size) times, and those whose hash lies below the source's
    threshold once more, so a source's taken words miss its target by at most half of what one hash holds. All is
    DataFrame functions; documents are read twice, once for narrow rows of source, size and hash, which are staged,
    and once to attach the copies. A source that holds a third of the rows is added up before the shuffle and needs
    no shuffle to be filtered.

    Defined cases: a null text has size 0, a null source is a source (the last), null ids share one hash, and so do
    rows that repeat an id, which go in or stay out together. Documents of size 0 follow their hash like any other. A
    very long text is counted whole and shuffled nowhere.
    An empty table gives an empty result. Columns of `docs` called like one of the four results are replaced.
    """
    size, hashed, source = word_count(text_col), mix_hash(id_col, seed), F.col(source_col)
    sized = staged(docs.select(source.alias("source"), size.alias("size"), hashed.alias("hash")), "mix-sizes")
    totals = sized.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    targets = staged(source_targets(totals, weights, max_repeats), "mix-targets")
    named = _thresholds(sized, targets, max_repeats).withColumnRenamed("source", "name")
    decisions = targets.join(named, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    decisions = staged(decisions, "mix-decisions").withColumnRenamed("source", "_source")
    decisions = broadcast_if_few(decisions, BROADCAST_SOURCES)
    rows = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"),
        source.alias("_name"),
        size.alias("_size"),
        hashed.alias("_hash"),
    )
    met = rows.join(decisions, F.col("_name").eqNullSafe(F.col("_source")))
    copies = F.least(F.col("base") + (F.col("_hash") < F.col("threshold")).cast("int"), F.lit(max_repeats))
    results = {"size": F.col("_size"), "source_size": F.col("source_size"), "target": F.col("target"), "copies": copies}
    columns = [F.col("row").getField(name).alias(name) for name in docs.columns if name not in results]
    return met.select(*columns, *[value.alias(name) for name, value in results.items()])
