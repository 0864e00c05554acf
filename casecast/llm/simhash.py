"""Near-duplicate documents by SimHash fingerprints that differ in a few bits."""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from casecast.llm.common import DOC_ID, TEXT, in_small_batches, text_or_empty
from casecast.llm.components import components
from casecast.session import staged

SEED = 42
BITS = 64
#: Shingles whose bits are added up at a time, which bounds the memory of a very long text.
CHUNK = 1 << 15


def simhash(text, shingle=3):
    """The fingerprint of one text as an unsigned integer: bit i is set if it is in over half of the shingles' hashes.

    Words are what ASCII white space separates, with A-Z lower-cased; fewer than `shingle` words are one shingle, and
    no word at all gives 0.
    """
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(shingle, len(words))
    starts, ends = starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(starts), CHUNK):
        pairs = zip(starts[at : at + CHUNK], ends[at : at + CHUNK])
        hashes = np.array([digest(joined[a:b], SEED) for a, b in pairs], np.dtype("<u8"))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(starts), bitorder="little").view("<u8")[0])


def _fingerprints(shingle):
    def run(batches):
        for batch in batches:
            prints = [simhash(text or "", shingle) for text in batch.column(1).to_pylist()]
            signed = np.array(prints, np.uint64).view(np.int64)
            others = batch.columns[2:]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed), *others], ["doc_id", "fp", "h", "n"][: 2 + len(others)])

    return run


def _text_key(text_col):
    """`h` and `n`, which name a text as in `row_key`."""
    return [F.xxhash64(text_or_empty(text_col)).alias("h"), F.char_length(text_or_empty(text_col)).alias("n")]


def fingerprints(docs, shingle=3, id_col=DOC_ID, text_col=TEXT, text_key=False):
    """`doc_id` and `fp`, the fingerprint as a signed bigint, of every row, and with `text_key` the text's `h` and `n`.

    A null text is an empty one.
    """
    columns = [F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")]
    inputs = docs.select(*columns, *(_text_key(text_col) if text_key else []))
    result = "doc_id bigint, fp bigint" + (", h bigint, n int" if text_key else "")
    return in_small_batches(inputs).mapInArrow(_fingerprints(shingle), result)


def hex_digits(fp="fp"):
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _segments(max_bits):
    """(first bit, number of bits) of as many segments that one of them differs by at most one bit."""
    pieces = max_bits // 2 + 1
    cuts = [BITS * i // pieces for i in range(pieces + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def variants(prints, max_bits):
    """`key` and `fp`: each segment as it is, and once for each of its bits with that bit as a wildcard.

    Two fingerprints within `max_bits` have a segment in common that differs by at most one bit, and so a variant. The
    key is a hash of the variant, which may bring more fingerprints together; links are verified in any case.
    """
    masks = []
    for first, length in _segments(max_bits):
        whole = ((1 << length) - 1) << first
        masks += [whole] + [whole & ~(1 << bit) for bit in range(first, first + length)]
    signed = [int(np.uint64(mask).astype(np.int64)) for mask in masks]
    mask = F.posexplode(F.array(*[F.lit(m).cast("bigint") for m in signed])).alias("variant", "mask")
    key = F.xxhash64("variant", F.col("fp").bitwiseAND(F.col("mask"))).alias("key")
    return prints.select("fp", mask).select(key, "fp")


def near_pairs(prints, max_bits=2, largest_bucket=32):
    """`a`, `b`: links between distinct fingerprints (`fp`) that connect all that differ by at most `max_bits` bits.

    Variants are shuffled once, and those without a match are dropped on the spot. Buckets of up to `largest_bucket`
    are joined on the variant and verified. Larger ones would give pairs by the square of their size, so what they
    hold is linked in another exact way: two fingerprints are within two bits exactly if some value is within one bit
    of both. Each is listed under the 65 values around it (under itself alone, if `max_bits` is 0), and all under one
    value are tied to the smallest of them: no link is lost, and rows are 65 for each fingerprint at most.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits is 0, 1 or 2")
    matches = F.count(F.lit(1)).over(Window.partitionBy("key"))
    members = staged(variants(prints, max_bits).withColumn("n", matches).where("n > 1"), "simhash-members")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    few = members.where(f"n <= {int(largest_bucket)}")
    firsts, seconds = few.select("key", F.col("fp").alias("a")), few.select("key", F.col("fp").alias("b"))
    some = firsts.join(seconds, "key").where("a < b").where(close).select("a", "b")
    crowd = members.where(f"n > {int(largest_bucket)}").select("fp").distinct()
    ones = [0] + ([int(np.uint64(1 << bit).astype(np.int64)) for bit in range(BITS)] if max_bits else [])
    around = F.explode(F.array(*[F.lit(m).cast("bigint") for m in ones])).alias("flip")
    balls = crowd.select("fp", around).select(F.col("fp").bitwiseXOR(F.col("flip")).alias("value"), "fp")
    balls = staged(balls, "simhash-balls")
    if max_bits == 2:
        centres = balls.groupBy("value").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
    else:  # those around a fingerprint link to it, but not always to each other
        centres = balls.where("value = fp").withColumnRenamed("fp", "b")
    tied = balls.join(centres.select("value", "b"), "value").where("fp <> b").select(F.col("fp").alias("a"), "b")
    return some.unionByName(tied).distinct()


def _components(prints, max_bits):
    """For each distinct fingerprint `_fp` of rows with an id: `root`, the fingerprint that stands for its component, and
    `component`, the smallest id there."""
    named = prints.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("least"))
    named = staged(named, "simhash-distinct")
    linked = components(near_pairs(named.select("fp"), max_bits))
    linked = staged(linked, "simhash-components")
    met = named.join(linked.withColumnRenamed("node", "fp"), "fp")
    roots = met.groupBy("root").agg(F.min("least").alias("least"))
    found = met.select("fp", "root").join(roots, "root").select(F.col("fp").alias("_fp"), "root", F.col("least").alias("_root"))
    by_print = named.join(found, F.col("fp") == F.col("_fp"), "left")
    columns = [F.col("fp").alias("_fp"), F.coalesce("root", "fp").alias("root"), F.coalesce("_root", "least").alias("component")]
    return staged(by_print.select(*columns), "simhash-named")  # a join of two tables can split the copies of a hot fingerprint


def near_duplicates(docs, shingle=3, max_bits=2, id_col=DOC_ID, text_col=TEXT):
    """`doc_id`, `fp` and `component_id`, the smallest id that links reach, for every row.

    Fingerprints are computed once and staged; equal ones are added up before the shuffle and take part as one. A
    fingerprint's component is that of its links (`near_pairs`); nothing but narrow rows is shuffled.

    Defined cases: a null or empty text has fingerprint 0 and is linked like any other. Rows that repeat an id are
    all returned. A row without an id takes no part: its component is null. Only the two named columns are read, so
    extra ones cannot clash; an empty table gives an empty result.
    """
    prints = staged(fingerprints(docs, shingle, id_col, text_col), "simhash")
    by_print = _components(prints, max_bits)
    component = F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id")
    return prints.join(by_print, F.col("fp") == F.col("_fp"), "left").select("doc_id", "fp", component)


def keep_one(docs, shingle=3, max_bits=2, id_col=DOC_ID, text_col=TEXT):
    """The rows of `docs` with one document of each group of near duplicates, that of the smallest id.

    Of rows that share this id the least by text stays. Rows that share an id but belong to different groups stand for
    their own group each. Rows without an id stay.

    The rows that stay are chosen on narrow keys (id, hash and length of the text), and whole rows are joined to them
    once. Only where several rows of a group have its smallest id are texts compared.

    Defined cases: a null or empty text has fingerprint 0 and is grouped like any other, and a null text is greater than any.
    A very long text is read in chunks. Extra columns are kept as they are, whatever their names; an empty table stays empty.
    """
    prints = staged(fingerprints(docs, shingle, id_col, text_col, text_key=True), "simhash")
    least = prints.join(_components(prints, max_bits), F.col("fp") == F.col("_fp")).where("doc_id = component")
    by_root = least.groupBy("root").agg(F.min(F.struct("doc_id", "h", "n")).alias("least"), F.count(F.lit(1)).alias("rows"))
    by_root = staged(by_root, "simhash-stay")
    named = [F.col("least.doc_id").alias("_stays"), F.col("least.h").alias("_h"), F.col("least.n").alias("_n")]
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")
    rows = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).alias("_text"), *_text_key(text_col), row)
    is_named = (F.col("_id") == F.col("_stays")) & (F.col("h") == F.col("_h")) & (F.col("n") == F.col("_n"))
    one = rows.join(by_root.where("rows = 1").select(*named), is_named).select("row")
    if not by_root.where("rows > 1").isEmpty():
        several = least.join(by_root.where("rows > 1").select("root"), "root")
        keys = [F.col("doc_id").alias("_stays"), F.col("h").alias("_h"), F.col("n").alias("_n")]
        met = rows.join(several.select(*keys, "root").distinct(), is_named)
        chosen = met.groupBy("root").agg(F.min_by("row", "_text").alias("row"), F.first("row").alias("any"))
        one = one.unionByName(chosen.select(F.coalesce("row", "any").alias("row")))
    return one.unionByName(rows.where("_id IS NULL").select("row")).select("row.*")
