"""Line dedup: lines that several documents hold stay in one of them only."""

from pyspark.sql import functions as F

from casecast.llm.common import DOC_ID, SPACES, TEXT, ascii_lower, row_key, text_or_empty
from casecast.session import staged


def _lines(text_col):
    return F.split(text_or_empty(text_col), "\n", -1)


def _hashes(lines, min_chars):
    """Per line the 64-bit hash of its normal form, null for lines too short to count."""
    normal = F.transform(lines, lambda line: ascii_lower(F.btrim(line, F.lit(SPACES))))
    return F.transform(normal, lambda key: F.when(F.char_length(key) >= min_chars, F.xxhash64(key)))


def dedup_lines(docs, min_chars=20, min_docs=3, id_col=DOC_ID, text_col=TEXT):
    """The columns of `docs`, then `kept` (text without the dropped lines), `n_lines` and `n_dropped`.

    A line's normal form has white space stripped at both ends and A-Z lower-cased. Normal forms of at least
    `min_chars` code points which at least `min_docs` documents hold lose all their lines, but for those in the
    largest id that holds them. Everything is DataFrame functions: lines are exploded and hashed (64 bits), each
    id counts once per hash, counts are added up before the shuffle, so a line that a third of all documents
    share arrives as one partial count per task. Only positions of dropped lines travel back, and the text is put
    together again by position in the row it came in.

    Defined cases: null and empty texts are one empty line, and `kept` is empty. A very long text is as many lines as it has,
    which are put together in one task. Rows that share an id count as one document and each get a result; those of the
    largest id all keep their lines, and equal rows get equal results. A null id is an id, smaller than any other. The columns
    of `docs` come back as they are, whatever their names, unless they are called like one of the three results, which
    replace them. An empty table gives an empty result.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"),
        row_key(id_col, text_col).alias("key"),
        _lines(text_col).alias("lines"),
    )
    hashed = rows.select("key", F.col("key.id").alias("id"), _hashes(F.col("lines"), min_chars).alias("hashes"))
    once = hashed.select("id", F.explode(F.array_distinct("hashes")).alias("hash")).where("hash IS NOT NULL").distinct()
    counted = once.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("keeper"))
    # Staged, so that the join knows its size, and splits the lines of a hot hash if it is too large to broadcast.
    shared = staged(counted.where(F.col("n") >= min_docs).select("hash", "keeper"), "shared-lines")
    placed = hashed.select("key", "id", F.posexplode("hashes").alias("position", "hash")).where("hash IS NOT NULL")
    dropped = placed.join(shared, "hash").where(~F.col("id").eqNullSafe(F.col("keeper")))
    positions = dropped.groupBy("key").agg(F.collect_set("position").alias("dropped"))
    positions = positions.select(*[F.col(f"key.{part}").alias(f"_{part}") for part in ("id", "h", "n")], "dropped")
    matches = (
        F.col("key.id").eqNullSafe(F.col("_id"))
        & (F.col("key.h") == F.col("_h"))
        & (F.col("key.n") == F.col("_n"))
    )
    met = rows.join(positions, matches, "left")
    every = F.sequence(F.lit(0), F.size("lines") - 1)
    kept = F.transform(F.array_except(every, F.col("dropped")), lambda i: F.get(F.col("lines"), i))
    # With every line dropped nothing is left to join.
    kept = F.when(F.col("dropped").isNull(), F.array_join("lines", "\n")).otherwise(F.array_join(kept, "\n"))
    results = {
        "kept": kept,
        "n_lines": F.size("lines").cast("bigint"),
        "n_dropped": F.coalesce(F.size("dropped"), F.lit(0)).cast("bigint"),
    }
    columns = [F.col("row").getField(name).alias(name) for name in docs.columns if name not in results]
    return met.select(*columns, *[value.alias(name) for name, value in results.items()])
