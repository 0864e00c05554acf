"""Document fingerprints: the k smallest hashes of a text's shingles."""

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casecast.llm.common import in_small_batches

SEED = 7
#: Characters of a text that ranges are cut by where rows share an id.
CUT_CHARS = 32
#: Most ranges of a table, each of them a task.
MOST_PARTS = 200_000
#: Hashes lie in [0, 2^60), so that they order alike as signed and unsigned numbers.
HASH_BITS = 60
#: Shingles hashed at a time, which bounds the memory of a very long text.
CHUNK = 1 << 16


def _mixed(x):
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bottom_k(text, k=128, shingle=5):
    """The `k` smallest distinct hashes of a text's word shingles, ascending; all of them, if there are fewer.

    Words are what ASCII white space separates, with A-Z lower-cased. A text of fewer than `shingle` words is one
    shingle, and one without words has none.
    """
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.int64)
    digest = xxhash.xxh64_intdigest
    codes = {word: digest(word, SEED) for word in set(words)}
    hashes = np.array([codes[word] for word in words], np.uint64)
    size = min(shingle, len(words))
    best = np.empty(0, np.uint64)
    for at in range(0, len(words) - size + 1, CHUNK):
        part = hashes[at : at + CHUNK + size - 1]
        value = np.full(len(part) - size + 1, size, np.uint64)
        for i in range(size):
            value = _mixed(value + part[i : len(part) - size + 1 + i])
        best = np.unique(np.concatenate([best, value >> np.uint64(64 - HASH_BITS)]))[:k]
    return best.astype(np.int64)


def sketched(k=128, shingle=5):
    """A function from a text column to its sketch, an ascending array of bigint. A null text is an empty one."""

    @F.pandas_udf("array<bigint>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([bottom_k(text or "", k, shingle) for text in texts])

    return run


def merged(a, b, k=128):
    """The sketch of two parts together, from their sketches."""
    return F.slice(F.array_sort(F.array_union(a, b)), 1, k)


def resemblance(a, b, k=128):
    """Estimated Jaccard similarity of the shingle sets: the share of the k smallest of both that lie in both.

    Exact while both sets together have at most k shingles. Two empty texts resemble each other fully.
    """
    both = merged(a, b, k)
    common = F.size(F.array_intersect(both, F.array_intersect(a, b)))
    return F.when(F.size(both) == 0, 1.0).otherwise(common / F.size(both))


def distinct_shingles(a, k=128):
    """Estimated number of distinct shingles: their number if below k, else from the kth smallest hash."""
    full = (k - 1) * float(1 << HASH_BITS) / (F.element_at(a, k) + 1)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(full)


def containment(a, b, k=128):
    """Estimated share of a's shingles that b has too, from resemblance and the two counts; 1 if a is empty."""
    shared = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a, k)))


def as_text(sketch):
    """A sketch as text: 15 hex digits for each hash."""
    return F.array_join(F.transform(sketch, lambda x: F.lower(F.lpad(F.hex(x), HASH_BITS // 4, "0"))), "")


def merged_by(sketches, key, sketch_col="sketch", k=128):
    """`key` and `sketch`: for each key the sketch of all its rows' texts together.

    Equal hashes are put together and each task keeps its k smallest per key before the shuffle, so a key that holds
    a third of all rows sends k hashes per task.
    """
    hashes = sketches.select(key, F.explode(sketch_col).alias("hash")).distinct()
    place = F.row_number().over(Window.partitionBy(key).orderBy("hash"))
    least = hashes.withColumn("place", place).where(F.col("place") <= k)
    found = least.groupBy(key).agg(F.array_sort(F.collect_list("hash")).alias("sketch"))
    found = found.select(F.col(key).alias("_key"), "sketch")
    every = sketches.select(key).distinct().join(found, F.col(key).eqNullSafe(F.col("_key")), "left")
    return every.select(key, F.coalesce("sketch", F.array().cast("array<bigint>")).alias("sketch"))


def with_sketches(docs, columns, k=128, shingle=5):
    """`docs` with a sketch for each text column: `columns` is {text column: sketch column}.

    Each row is sketched where it lies: nothing is shuffled, and a text is hashed in pieces, so memory is bounded by
    the longest text. Equal texts have equal sketches. Null and empty texts have empty ones. Sketch columns replace
    columns of `docs` of the same name; the others stay as they are, and an empty table gives an empty result.
    """
    run = sketched(k, shingle)
    return in_small_batches(docs).withColumns({new: run(F.col(f"`{text}`").cast("string")) for text, new in columns.items()})


def _next_columns(columns, count):
    """Sorted rows with the values that `columns` have in the row after, but for the last row of a task; arrays only."""

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                yield joined(held, batch)
            held = batch
        if held is not None and held.num_rows > 1:
            yield joined(held.slice(0, held.num_rows - 1), held.slice(held.num_rows - 1))

    def joined(batch, after):
        nexts = [pa.concat_arrays([batch.column(i).slice(1), after.column(i).slice(0, 1)]) for i in columns]
        names = [f"c{i}" for i in range(count + len(columns))]
        return pa.RecordBatch.from_arrays([*batch.columns, *nexts], names)

    return run


def with_next(docs, id_col, columns, rows_per_part=2000):
    """`docs` with `next_<column>` for each of `columns`: its value in the row of the next id (after the last: the first).

    The table is sorted by ranges of about `rows_per_part` rows (more beyond `MOST_PARTS` ranges, which are then sorted on
    disk and read as a stream), which Spark cuts by the id and the beginning of the first
    of `columns`, so that rows of one id can be cut as well. Within a range each row meets the one after it in the sorted
    rows; the last row of a range meets the first one of the next. For these two each range gives one row, found in the
    same shuffled rows, and one number. Rows that share an id follow each other by the columns; a null id comes first.
    Repeated rows stay, each next to the other. An empty table gives an empty result.
    """
    parts = max(1, min(MOST_PARTS, -(-docs.count() // rows_per_part)))
    count, places = len(docs.columns), [docs.columns.index(c) for c in columns]
    plain = docs.toDF(*[f"c{i}" for i in range(count)])
    at = f"c{docs.columns.index(id_col)}"
    order = [F.col(at).asc_nulls_first(), *[F.col(f"c{i}").asc_nulls_first() for i in places]]
    begin = [F.substring(F.col(f"c{i}").cast("string"), 1, CUT_CHARS).asc_nulls_first() for i in places[:1]]
    ranged = in_small_batches(plain).repartitionByRange(parts, order[0], *begin)
    kinds = [field.dataType for field in docs.schema.fields]
    schema = T.StructType([T.StructField(f"c{i}", kind) for i, kind in enumerate([*kinds, *[kinds[i] for i in places]])])
    inner = ranged.sortWithinPartitions(*order).mapInArrow(_next_columns(places, count), schema)
    # The order as one value: a null sorts before all others in a struct, too.
    key = F.struct(at, *[f"c{i}" for i in places])
    row = F.struct(*[f"c{i}" for i in range(count)])
    ends = ranged.groupBy(F.spark_partition_id().alias("part")).agg(
        F.min_by(F.struct(*[f"c{i}" for i in places]), key).alias("first"), F.max_by(row, key).alias("last")
    )
    before = F.lag("part").over(Window.orderBy("part"))  # a number for each range
    wraps = F.max("part").over(Window.partitionBy())
    follows = ends.select("part").withColumn("to", F.coalesce(before, wraps))
    firsts = ends.select("part", "first").join(follows, "part").select(F.col("to").alias("part"), "first")
    outer = ends.select("part", "last").join(firsts, "part").select(
        "last.*", *[F.col("first").getField(f"c{i}").alias(f"c{count + k}") for k, i in enumerate(places)]
    )
    return inner.unionByName(outer).toDF(*docs.columns, *[f"next_{c}" for c in columns])
