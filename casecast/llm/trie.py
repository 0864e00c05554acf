"""The trie of conversations that share first turns, from composable fingerprints."""

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casecast.llm.common import broadcast_if_few, in_small_batches, sha256
from casecast.session import staged

#: Fingerprints are maps x -> (a*x + b) mod this prime, which can be put after one another and taken back.
PRIME = (1 << 61) - 1
#: Characters of ids that are put together before they are hashed.
SEGMENT = 1 << 16
#: Attempts, each with other hashes, before colliding fingerprints are an error.
ATTEMPTS = 4

REFERENCE = ["s1", "s2", "s3", "s4"]
SCANNED = "part int, conv_id bigint, place bigint, a bigint, b bigint, pa bigint, pb bigint, chars bigint, " + ", ".join(
    f"{name} bigint" for name in REFERENCE
)
PAIR = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
CARRIES = "part int, conv_id bigint, before bigint, ca bigint, cb bigint"


def after(first, then):
    """The product of two fingerprints, that of the turns of `first` and then those of `then`."""
    (a, b), (c, d) = first, then
    return a * c % PRIME, (b + a * d) % PRIME


def inverse(fingerprint):
    a, b = fingerprint
    back = pow(a, -1, PRIME)
    return back, -back * b % PRIME


def of_turn(h1, h2):
    """The fingerprint of a turn from two hashes of it; `a` is never 0, so there is a way back."""
    return 1 + h1 % (PRIME - 1), h2 % PRIME


def _scan(batches):
    """Rows (conv_id, h1, h2, chars, reference) in order, with their place in their conversation and the product of its
    turns so far, as far as this task has seen it."""
    part, conv, place, now = TaskContext.get().partitionId(), object(), 0, (1, 0)
    for batch in batches:
        convs, h1s, h2s = (batch.column(i).to_pylist() for i in range(3))
        rows = []
        for own, h1, h2 in zip(convs, h1s, h2s):
            if own != conv:
                conv, place, now = own, 0, (1, 0)
            before, place, now = now, place + 1, after(now, of_turn(h1, h2))
            rows.append((place, *now, *before))
        columns = [pa.array(column, pa.int64()) for column in zip(*rows)] if rows else [pa.array([], pa.int64())] * 5
        parts = pa.array(np.full(batch.num_rows, part), pa.int32())
        names = SCANNED.replace(" bigint", "").replace(" int", "").split(", ")
        yield pa.RecordBatch.from_arrays([parts, batch.column(0), *columns, *batch.columns[3:]], names)


def _carried(pieces: pd.DataFrame) -> pd.DataFrame:
    """For each piece of a conversation that several tasks hold what comes before it; one row for each task."""
    rows, before, now = [], 0, (1, 0)
    for piece in pieces.sort_values("part").itertuples():
        rows.append((piece.part, piece.conv_id, before, *now))
        before, now = before + piece.n, after(now, (int(piece.a), int(piece.b)))
    return pd.DataFrame(rows, columns=["part", "conv_id", "before", "ca", "cb"])


@F.pandas_udf(PAIR)
def _product(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.DataFrame:
    found = [after(x, y) for x, y in zip(zip(a.tolist(), b.tolist()), zip(c.tolist(), d.tolist()))]
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


@F.pandas_udf(PAIR)
def _moved(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.DataFrame:
    """What leads from the turns of the second fingerprint to the same turns after those of the first."""
    found = [after(x, inverse(y)) for x, y in zip(zip(a.tolist(), b.tolist()), zip(c.tolist(), d.tolist()))]
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _turns(conversations, attempt):
    """The turns of all conversations in order, by ranges: place, product so far, code points and reference."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    name = F.sha2(F.concat_ws(":", F.char_length(role).cast("string"), role, text), 256)
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.xxhash64(F.lit(2 * attempt), role, text).alias("h1"),
        F.xxhash64(F.lit(2 * attempt + 1), role, text).alias("h2"),
        F.char_length(text).cast("bigint").alias("chars"),
        name.alias("name"),
    )
    parts = [F.conv(F.substring("name", 1 + 16 * i, 15), 16, 10).cast("bigint").alias(s) for i, s in enumerate(REFERENCE)]
    order = [F.col("conv_id").asc(), F.col("turn").asc_nulls_first(), F.col("h1").asc(), F.col("h2").asc()]
    rows = staged(rows.select("conv_id", "turn", "h1", "h2", "chars", *parts), "trie-rows")
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "h1", "h2", "chars", *REFERENCE)
    return staged(ranges.mapInArrow(_scan, SCANNED), "trie-turns")


def _whole(turns):
    """Turns with their place in the whole conversation (`place`) and the product of what other tasks hold before them
    (`ca`, `cb`), and a row for each conversation with the number of its turns."""
    last = F.max_by(F.struct("a", "b"), "place")
    pieces = turns.groupBy("part", "conv_id").agg(F.max("place").alias("n"), last.alias("last"))
    pieces = staged(pieces.select("part", "conv_id", "n", "last.a", "last.b"), "trie-pieces")
    convs = pieces.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.count(F.lit(1)).alias("pieces"))
    apart = pieces.join(convs.where("pieces > 1").select("conv_id"), "conv_id")
    carries = staged(apart.groupBy("conv_id").applyInPandas(_carried, CARRIES), "trie-carries")  # two a task at most
    met = turns.join(broadcast_if_few(carries, 1 << 16), ["part", "conv_id"], "left")
    met = met.withColumn("place", F.col("place") + F.coalesce("before", F.lit(0)))
    identity = {"ca": F.coalesce("ca", F.lit(1).cast("bigint")), "cb": F.coalesce("cb", F.lit(0).cast("bigint"))}
    return met.withColumns(identity).drop("before", "part"), convs.select("conv_id", "n_turns")


def _rebuilt(turns, convs, head_turns, group):
    """A row for each rebuilt conversation and depth: the fingerprints of that many turns and of one less, the last
    turn's code points and reference, and whether the conversation ends there."""
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % head_turns).cast("bigint")
    convs = convs.withColumn("h", taken).withColumn("base", F.col("conv_id") - F.col("conv_id") % group)
    product = _product("ca", "cb", "a", "b").alias("p")
    heads = turns.where(F.col("place") < head_turns).select("conv_id", "place", product, "chars", *REFERENCE)
    heads = staged(heads.select("conv_id", "place", "p.a", "p.b", "chars", *REFERENCE), "trie-heads")
    of_base = heads.where(F.col("conv_id") % group == 0).groupBy(F.col("conv_id").alias("base"))
    of_base = of_base.agg(F.sort_array(F.collect_list(F.struct("place", "a", "b", "chars", *REFERENCE))).alias("head"))
    own = heads.select("conv_id", F.col("place").alias("h"), F.col("a").alias("ha"), F.col("b").alias("hb"))
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    plan = convs.join(of_base, "base", "left").join(own, ["conv_id", "h"], "left")
    head = F.when(F.col("head").isNull() | (F.col("h") == 0), F.array()).otherwise(F.slice("head", 1, F.col("h").cast("int")))
    plan = plan.withColumn("head", head).withColumn("kept", F.size("head").cast("bigint"))
    length = F.col("kept") + F.greatest(F.col("n_turns") - F.col("h"), none)
    end = F.element_at("head", -1)
    plan = plan.withColumns(
        {
            "length": length,
            "ba": F.when(F.col("kept") > 0, end["a"]).otherwise(one),
            "bb": F.when(F.col("kept") > 0, end["b"]).otherwise(none),
            "ha": F.coalesce("ha", one),
            "hb": F.coalesce("hb", none),
        }
    )
    plan = plan.withColumn("move", _moved("ba", "bb", "ha", "hb"))
    plan = staged(plan.select("conv_id", "h", "kept", "length", "head", "move"), "trie-plan")
    turnless = [F.lit(0).cast("bigint").alias(s) for s in REFERENCE]
    roots = plan.select(
        "conv_id", none.alias("depth"), one.alias("a"), none.alias("b"), none.alias("pa"), none.alias("pb"), none.alias("chars"),
        *turnless, (F.col("length") == 0).alias("is_end"),
    )
    listed = plan.select("conv_id", "length", "head", F.explode("head").alias("t"))
    before = F.get("head", (F.col("t.place") - 2).cast("int"))
    before = F.struct(F.coalesce(before["a"], one).alias("a"), F.coalesce(before["b"], none).alias("b"))
    listed = listed.withColumn("before", before).select(
        "conv_id", F.col("t.place").alias("depth"), "t.a", "t.b", F.col("before.a").alias("pa"), F.col("before.b").alias("pb"), "t.chars",
        *[f"t.{s}" for s in REFERENCE], (F.col("length") == F.col("t.place")).alias("is_end"),
    )
    rest = turns.join(plan.select("conv_id", "h", "kept", "length", "move"), "conv_id").where("place > h")
    moved = _product("move.a", "move.b", "ca", "cb")
    rest = rest.withColumn("move", moved).select(
        "conv_id", (F.col("kept") + F.col("place") - F.col("h")).alias("depth"), "length", "chars", *REFERENCE,
        _product("move.a", "move.b", "a", "b").alias("p"), _product("move.a", "move.b", "pa", "pb").alias("q"),
    )
    rest = rest.select(
        "conv_id", "depth", "p.a", "p.b", F.col("q.a").alias("pa"), F.col("q.b").alias("pb"), "chars", *REFERENCE,
        (F.col("length") == F.col("depth")).alias("is_end"),
    )
    return staged(roots.unionByName(listed).unionByName(rest), "trie-rebuilt")


def _nodes(rebuilt):
    """A row for each group of equal depth and fingerprint, or None if a group holds different turns.

    All in a group must have the same last turn, by its stored reference, and the same group one turn before; as all
    groups are looked at, so are all turns.
    """
    checked = ["pa", "pb", "chars", *REFERENCE]
    sums = [F.min(c).alias(f"least_{c}") for c in checked] + [F.max(c).alias(c) for c in checked]
    nodes = rebuilt.groupBy("depth", "a", "b").agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.count_if("is_end").alias("n_ends"),
        F.min(F.when(F.col("is_end"), F.col("conv_id"))).alias("first_end"),
        *sums,
    )
    nodes = staged(nodes, "trie-nodes")
    differ = F.lit(False)
    for c in checked:
        differ |= F.col(f"least_{c}") != F.col(c)
    if not nodes.where(differ).isEmpty():
        return None
    return nodes.select("depth", "a", "b", "conv_id", "n_convs", "n_ends", "first_end", "pa", "pb", "chars")


def _subtree_sums(nodes, values):
    """`conv_id`, `depth` and each of `values` added up over a node and all below it.

    `nodes` has `parent_conv_id` (null at the root). Sums reach twice as far up each round: a node adds its sum of the
    last 1, 2, 4, ... levels to the ancestor just above these, so rounds are the logarithm of the depth.
    """
    sums = staged(nodes.select("conv_id", "depth", *values), "trie-sums")
    up = nodes.where("depth > 0").select("conv_id", "depth", F.col("parent_conv_id").alias("up"))
    step = 1
    while not (up := staged(up, "trie-up")).isEmpty():
        sent = sums.join(up, ["conv_id", "depth"]).groupBy(F.col("up").alias("conv_id"), (F.col("depth") - step).alias("depth"))
        sent = sent.agg(*[F.sum(v).alias(f"more_{v}") for v in values])
        added = [(F.col(v) + F.coalesce(f"more_{v}", F.lit(0))).alias(v) for v in values]
        sums = staged(sums.join(sent, ["conv_id", "depth"], "left").select("conv_id", "depth", *added), "trie-sums")
        above = up.select(F.col("conv_id").alias("up"), (F.col("depth") + step).alias("depth"), F.col("up").alias("next"))
        up = up.join(above, ["up", "depth"]).select("conv_id", "depth", F.col("next").alias("up"))
        step *= 2
    return sums


def _segments(batches):
    """Sorted (node, depth, member) rows to texts of comma-joined members, each of one node."""
    part, number, node, held, size = TaskContext.get().partitionId(), 0, None, [], 0
    names = ["node", "depth", "part", "number", "members"]

    def segment():
        row = (*node, part, number, ",".join(held))
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

    for batch in batches:
        for own, depth, member in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if held and ((own, depth) != node or size > SEGMENT):
                yield segment()
                number, held, size = number + 1, [], 0
            node = own, depth
            held.append(str(member))
            size += len(held[-1]) + 1
    if held:
        yield segment()


def _hashed(batches):
    """Sorted segments to the digest of each node's members, one segment at a time."""
    node, digest, done = None, None, []
    for batch in batches:
        for own, depth, members in zip(*(batch.column(i).to_pylist() for i in (0, 1, 4))):
            if (own, depth) != node:
                if node is not None:
                    done.append((*node, digest.hexdigest()))
                node, digest = (own, depth), hashlib.sha256(members.encode())
            else:
                digest.update(b"," + members.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["conv_id", "depth", "digest"])
            done = []
    if node is not None:
        done = [(*node, digest.hexdigest())]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["conv_id", "depth", "digest"])


def _end_digests(rebuilt, nodes):
    """The digest of the members that end at a node, for nodes where several do."""
    several = nodes.where("n_ends > 1").select("depth", "a", "b", F.col("conv_id").alias("node"))
    ends = rebuilt.where("is_end").select("depth", "a", "b", F.col("conv_id").alias("member"))
    rows = staged(ends.join(several, ["depth", "a", "b"]).select("node", "depth", "member"), "trie-ends")
    sorted_rows = rows.repartitionByRange("node", "depth", "member").sortWithinPartitions("node", "depth", "member")
    pieces = sorted_rows.mapInArrow(_segments, "node bigint, depth bigint, part int, number bigint, members string")
    pieces = in_small_batches(pieces).repartition("node", "depth").sortWithinPartitions("node", "depth", "part", "number")
    return pieces.mapInArrow(_hashed, "conv_id bigint, depth bigint, digest string")


def prefix_trie(conversations, head_turns=6, group=100):
    """The nodes of the trie of rebuilt conversations, one row for each distinct sequence of first turns.

    `conversations` has `conv_id`, `turn`, `role` and `text`. Conversation c is rebuilt from the first h turns of its
    base, conversation c - c % `group` (all if it has fewer, none if there is no such), and its own turns after its first
    h; h is the CRC-32 of c in decimals modulo `head_turns`. A node has the smallest id of its members (`conv_id`), the
    conversations that start with its `depth` turns; `parent_conv_id`; `n_convs` members; `n_children`; `n_leaves`, nodes
    without children at or below it; `saved_tokens`, the code points that the nodes at or below it spare by standing for
    several members; and `ends_sha256`, the SHA-256 of the ids, ascending and comma-joined, of those that end there.

    Rebuilt texts are never made. A turn's fingerprint is an affine map modulo a prime, that of a sequence their
    product; products can be divided, so a rebuilt prefix is the base's product, less the own head's, times the own
    one. Turns are sorted by ranges of conversation and turn, so a conversation of any size is spread; a task's products
    start anew and are completed by what the tasks before hold of the same conversation, a row each. Groups of equal
    fingerprints are checked (`_nodes`); should any collide, all is done again with other hashes.

    A node with one member is a chain of its own: one leaf, nothing saved. Only nodes with more are joined and added up
    along the tree.

    Defined cases: null roles and texts are empty; null turns come first, and turns of one number follow by a hash of
    role and text, so repeated rows stay as they are. Rows without a conversation take no part, as a null has no base
    and no h. Very long texts are only hashed. Other columns are ignored; an empty table has no node, not even a root.
    """
    for attempt in range(ATTEMPTS):
        turns, convs = _whole(_turns(conversations, attempt))
        rebuilt = _rebuilt(turns, convs, head_turns, group)
        nodes = _nodes(rebuilt)
        if nodes is not None:
            break
    else:
        raise RuntimeError("fingerprints of different turns are equal under all hashes")
    shared = nodes.where("n_convs > 1")
    names = shared.select(
        (F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("_parent")
    )
    linked = nodes.join(names, ["depth", "pa", "pb"], "left")
    parent = F.when(F.col("depth") > 0, F.coalesce("_parent", "conv_id")).alias("parent_conv_id")
    linked = staged(linked.select("depth", "a", "b", "conv_id", parent, "n_convs", "n_ends", "first_end", "chars"), "trie-linked")
    below = linked.where("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
    below = below.agg(F.count(F.lit(1)).alias("children"), F.count_if(F.col("n_convs") == 1).alias("single"))
    children = F.coalesce("children", F.lit(0)).alias("n_children")
    branching = linked.where("n_convs > 1").join(below, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", "parent_conv_id", children,
        F.when(F.col("children").isNull(), F.lit(1).cast("bigint")).otherwise(F.col("single")).alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
    )
    branching = staged(branching, "trie-branching")
    sums = _subtree_sums(branching, ["n_leaves", "saved_tokens"])
    known = sums.join(branching.select("conv_id", "depth", "n_children"), ["conv_id", "depth"])
    known = known.join(_end_digests(rebuilt, nodes), ["conv_id", "depth"], "left")
    known = known.select("conv_id", "depth", F.struct("n_children", "n_leaves", "saved_tokens", "digest").alias("sum"))
    ended = F.coalesce(F.col("first_end").cast("string"), F.lit("")).cast("binary")
    return linked.join(known, ["conv_id", "depth"], "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("sum.n_children", (F.col("n_ends") == 0).cast("bigint")).alias("n_children"),
        F.coalesce("sum.n_leaves", F.lit(1).cast("bigint")).alias("n_leaves"),
        F.coalesce("sum.saved_tokens", F.lit(0).cast("bigint")).alias("saved_tokens"),
        F.coalesce("sum.digest", sha256(ended)).alias("ends_sha256"),
    )
