"""Reply trees to chat-formatted training texts with a loss mask."""

import re

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casecast.llm.common import in_small_batches
from casecast.session import staged

# The template's control strings.
BOS, EOS, OPEN, CLOSE = "<s>", "</s>", "[INST]", "[/INST]"

MASK = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
FORMATTED = T.StructType([T.StructField("formatted", T.StringType()), T.StructField("mask", MASK)])


def escape(text):
    """Break up control strings by a backslash; a backslash is doubled. `unescape` gives the text back."""
    text = text.replace("\\", "\\\\")
    return re.sub(r"([<\[])(/?(?:s>|INST\]))", r"\1\\\2", text)


def unescape(text):
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def format_turns(turns, trained=("assistant",)):
    """`(role, text)` turns as one text, and the code point spans of those whose role is trained on."""
    pieces, spans, at = [], [], 0
    for role, text in turns:
        head = f"{BOS}{OPEN}{escape(role)}{CLOSE}"
        body = escape(text)
        if role in trained:
            spans.append((at + len(head), at + len(head) + len(body)))
        pieces += head, body, EOS
        at += len(head) + len(body) + len(EOS)
    return "".join(pieces), spans


def parse_turns(formatted):
    """The turns that `format_turns` wrote."""
    turns = []
    for piece in formatted.split(EOS)[:-1]:
        role, _, text = piece.removeprefix(BOS + OPEN).partition(CLOSE)
        turns.append((unescape(role), unescape(text)))
    return turns


def masked_text(formatted, mask):
    """What the mask covers, unescaped."""
    return [unescape(formatted[start:end]) for start, end in mask]


@F.pandas_udf(FORMATTED)
def _formatted(paths: pd.Series) -> pd.DataFrame:
    done = [format_turns([(turn["role"], turn["text"]) for turn in path]) for path in paths]
    return pd.DataFrame(
        {
            "formatted": [text for text, _ in done],
            "mask": [[{"start": a, "end": b} for a, b in spans] for _, spans in done],
        }
    )


def linear_replies(messages, conv="conv_id", turn="turn", role="role", text="text"):
    """Messages that are numbered by turn as reply trees: every message answers the one before it.

    Turns that share a number follow each other by role and text. Scores are 0, as a chain has no branches to rank.
    """
    order = Window.partitionBy(conv).orderBy(
        F.col(turn).asc_nulls_first(), F.col(role).asc_nulls_first(), F.col(text).asc_nulls_first()
    )
    node = F.row_number().over(order).cast("bigint")
    numbered = messages.select(
        F.col(conv).alias("conv_id"), node.alias("node"), F.col(role).alias("role"), F.col(text).alias("text")
    )
    parent = F.when(F.col("node") > 1, F.col("node") - 1)
    return numbered.select("conv_id", "node", parent.alias("parent"), F.lit(0.0).alias("score"), "role", "text")


def _jumps(nodes):
    """Tables of 1, 2, 4, ... steps up (`up` is the ancestor of those nodes that have one so far up), and the sum of
    scores from every node to its root.

    Each round joins what still has an ancestor with the sums so far, so a chain of n messages takes log2(n) joins,
    and a node takes part in as many as its depth needs.
    """
    parents = nodes.select("conv_id", F.col("node").alias("parent"), F.col("node").alias("up"))
    links = nodes.select("conv_id", "node", "parent", "score").join(parents, ["conv_id", "parent"], "left")
    sums = staged(links.select("conv_id", "node", "up", F.col("score").alias("total")), "reply-links")
    most, span, steps = sums.count(), 1, []
    while True:
        open_ = sums.where("up IS NOT NULL")
        if open_.isEmpty() or span > most:  # farther up than there are messages: the rest runs in circles
            return steps, sums.where("up IS NULL").select("conv_id", "node", "total")
        steps.append(open_.select("conv_id", "node", "up"))
        above = sums.select("conv_id", F.col("node").alias("up"), F.col("up").alias("_up"), F.col("total").alias("_total"))
        doubled = open_.join(above, ["conv_id", "up"]).select(
            "conv_id", "node", F.col("_up").alias("up"), (F.col("total") + F.col("_total")).alias("total")
        )
        sums = staged(sums.where("up IS NULL").unionByName(doubled), "reply-links")
        span *= 2


def format_reply_trees(messages, best=1, null_conversation=False):
    """One formatted conversation for each of a tree's `best` branches, of messages in reply trees.

    `messages` has `conv_id`, `node`, `parent` (null at a root), `score`, `role` and `text`. The result has `conv_id`,
    `rank` (from 1), `leaf`, `score` (sum over the path), `n_turns`, `formatted` and `mask`, the spans of assistant
    texts in code points. Self-joins that double the steps they go up sum the scores from every message to its root;
    leaves are ranked by that sum (ties: the smaller node), and the ancestors of the chosen ones are listed by the
    same tables, half as many steps at a time, so that rows made are the turns of the chosen paths and no more. A
    conversation that holds a third of all messages is joined by node and spread like any other; only its formatted
    text comes together, in the one row it has to be.

    Defined cases: null roles and texts are empty. A message whose parent is unknown is a root. Messages that answer
    each other in a circle have no root and belong to no path. Rows that repeat a node count once (the least by
    parent, score, role and text). Null nodes are left out, as nothing can name them, and so are messages of a null
    conversation, unless `null_conversation` makes them one. An empty table gives an empty result; columns besides the
    six are ignored.
    """
    fields = F.struct(
        F.col("parent").cast("bigint").alias("parent"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    # Joins match a struct that holds a null, but no null.
    conv = F.struct(F.col("conv_id").isNull().alias("none"), F.col("conv_id").alias("id")).alias("conv_id")
    named = messages.where("node IS NOT NULL") if null_conversation else messages.where("conv_id IS NOT NULL AND node IS NOT NULL")
    nodes = named.select(conv if null_conversation else "conv_id", "node", fields.alias("message"))
    nodes = staged(nodes.groupBy("conv_id", "node").agg(F.min("message").alias("message")), "replies")
    nodes = nodes.select("conv_id", "node", "message.*")
    jumps, rooted = _jumps(nodes)
    answered = nodes.where("parent IS NOT NULL").select("conv_id", F.col("parent").alias("node"))
    leaves = rooted.join(answered, ["conv_id", "node"], "left_anti")
    ranking = Window.partitionBy("conv_id").orderBy(F.col("total").desc(), "node")
    chosen = leaves.withColumn("rank", F.row_number().over(ranking)).where(F.col("rank") <= best)
    chosen = staged(chosen.select("conv_id", "rank", F.col("node").alias("leaf"), F.col("total").alias("score")), "reply-leaves")
    paths = chosen.select("conv_id", "rank", F.col("leaf").alias("node"), F.lit(0).cast("bigint").alias("height"))
    for k in reversed(range(len(jumps))):
        above = paths.join(jumps[k], ["conv_id", "node"]).select(
            "conv_id", "rank", F.col("up").alias("node"), (F.col("height") + (1 << k)).alias("height")
        )
        paths = staged(paths.unionByName(above), "reply-paths")
    turns = in_small_batches(paths).join(nodes, ["conv_id", "node"]).groupBy("conv_id", "rank").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("height")).alias("at"), "role", "text"))).alias("turns")
    )
    done = turns.select("conv_id", "rank", F.size("turns").cast("bigint").alias("n_turns"), _formatted("turns").alias("done"))
    given = F.col("conv_id.id").alias("conv_id") if null_conversation else "conv_id"
    return done.join(chosen, ["conv_id", "rank"]).select(given, "rank", "leaf", "score", "n_turns", "done.*")
