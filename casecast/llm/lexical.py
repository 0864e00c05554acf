"""Ranked lexical search: exact integer scores of a query set against all documents, by dense blocked multiplication."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from casecast.llm.common import DOC_ID, TEXT, ascii_lower, in_small_batches
from casecast.session import staged

# Fixed value: what a term is, over code points (letters, digits and all that is not ASCII).
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Distinct (item, term) pairs that one pass over the documents answers. What a pass broadcasts is made of these.
WAVE_PAIRS = 1 << 18
#: Documents and items of a tile, and cells of any dense block.
TILE_DOCS, TILE_ITEMS, CELLS = 512, 32, 1 << 22
#: Bytes of a text that are split into terms at a time.
SPLIT_BYTES = 1 << 20
#: Whole numbers below this are exact in float64, and so are their sums.
EXACT = 1 << 53

POSTINGS = "doc_id bigint, n bigint, terms array<int>, counts array<bigint>"
HITS = "item_id bigint, doc_id bigint, score bigint"


def _byte_table():
    """Bytes of terms as they are, A-Z lower-cased; all others become spaces."""
    return bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def _pieces(data):
    """Translated bytes in parts that end between terms."""
    at = 0
    while at < len(data):
        end = data.find(b" ", at + SPLIT_BYTES)
        end = len(data) if end < 0 else end
        yield data[at:end]
        at = end


def _postings(vocabulary):
    """From documents to how often each holds the terms of `vocabulary`, and how many terms it has in all."""
    def run(batches):
        table = _byte_table()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                found, n = Counter(), 0
                for piece in _pieces((text.as_py() or b"").translate(table)):
                    words = piece.split()
                    n += len(words)
                    found.update(words)
                if n:
                    met = sorted((vocabulary[word], count) for word, count in found.items() if word in vocabulary)
                    rows.append((doc_id, n, [term for term, _ in met], [count for _, count in met]))
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]
                columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "counts"])

    return run


def _item_tiles(pairs):
    """Items in tiles: their ids, the terms that they hold (ascending) and a matrix of how often each holds each."""
    by_item = {}
    for item_id, term, count in pairs:
        by_item.setdefault(item_id, []).append((term, count))
    tiles, held, terms = [], [], set()
    for item_id in sorted(by_item):
        more = terms | {term for term, _ in by_item[item_id]}
        if held and (len(held) == TILE_ITEMS or (len(held) + 1) * len(more) > CELLS):
            tiles.append((held, terms))
            held, more = [], {term for term, _ in by_item[item_id]}
        held, terms = [*held, item_id], more
    if held:
        tiles.append((held, terms))
    done = []
    for held, terms in tiles:
        columns = np.array(sorted(terms), np.int64)
        asked = np.zeros((len(held), len(columns)))
        for row, item_id in enumerate(held):
            for term, count in by_item[item_id]:
                asked[row, np.searchsorted(columns, term)] = count
        done.append((np.array(held, np.int64), columns, asked))
    return done


def exact_products(impacts, asked):
    """`impacts @ asked.T` as 64-bit integers, for whole numbers of at least 0.

    A product in float64 is exact while no partial sum reaches 2**53. Where the bound allows more, the columns are cut
    in two and the parts are added up as integers; a column alone is multiplied as integers.
    """
    most = asked.sum(axis=1).max(initial=0) * impacts.max(initial=0)
    if most < EXACT:
        return (impacts @ asked.T).astype(np.int64)
    if asked.shape[1] == 1:
        return impacts.astype(np.int64) @ asked.T.astype(np.int64)
    half = asked.shape[1] // 2
    return exact_products(impacts[:, :half], asked[:, :half]) + exact_products(impacts[:, half:], asked[:, half:])


def best(items, docs, scores, k):
    """The rows that are among the k best of their item: highest score first, ties to the smaller document."""
    order = np.lexsort((docs, -scores, items))
    items, docs, scores = items[order], docs[order], scores[order]
    first = np.concatenate([[True], items[1:] != items[:-1]]) if len(items) else np.zeros(0, bool)
    place = np.arange(len(items))
    keep = place - np.maximum.accumulate(np.where(first, place, 0)) < k if len(items) else first
    return items[keep], docs[keep], scores[keep]


class _Search:
    """The best documents so far of every item of a wave."""

    def __init__(self, tiles, weights, documents, terms, k):
        self.tiles, self.weights, self.documents, self.terms, self.k = tiles, weights, documents, terms, k
        self.place = np.full(len(weights), -1, np.int64)
        self.held = [(np.zeros(0, np.int64),) * 3 for _ in tiles]
        self.bar = [np.ones(len(ids), np.int64) for ids, _, _ in tiles]  # the least score that can still rank

    def add(self, ids, lengths, rows, terms, counts):
        """Documents `ids` with their lengths, and which (`rows`) of them hold which terms how often."""
        norms = np.array([25 + 75 * n * self.documents // self.terms for n in lengths.tolist()], np.int64)
        impacts = self.weights[terms] * (1_000_000_000 * counts // (1000 * counts + 8 * norms[rows]))
        for number, (items, columns, asked) in enumerate(self.tiles):
            self.place[columns] = np.arange(len(columns))
            own = self.place[terms]
            self.place[columns] = -1
            met = own >= 0
            scores = self._scores(len(ids), rows[met], own[met], impacts[met], asked)
            self._rank(number, items, ids, scores)

    def _scores(self, n_docs, rows, own, impacts, asked):
        columns, own = np.unique(own, return_inverse=True)  # only terms that these documents hold
        scores = np.zeros((n_docs, len(asked)), np.int64)
        width = max(1, CELLS // n_docs)
        for at in range(0, len(columns), width):
            inside = (own >= at) & (own < at + width)
            block = np.zeros((n_docs, min(width, len(columns) - at)))
            block[rows[inside], own[inside] - at] = impacts[inside]
            scores += exact_products(block, asked[:, columns[at : at + width]])
        return scores

    def _rank(self, number, items, ids, scores):
        bar = self.bar[number]
        if len(ids) > self.k:  # of a tile only what reaches its kth score, ties included
            bar = np.maximum(bar, np.partition(scores, len(ids) - self.k, axis=0)[len(ids) - self.k])
        row, item = np.nonzero(scores >= bar)
        if not len(row):
            return
        new = (item, ids[row], scores[row, item])
        held = best(*(np.concatenate(pair) for pair in zip(self.held[number], new)), self.k)
        self.held[number] = held
        last = np.flatnonzero(np.bincount(held[0], minlength=len(items)) == self.k)
        lows = np.full(len(items), np.iinfo(np.int64).max)
        np.minimum.at(lows, held[0], held[2])
        self.bar[number][last] = np.maximum(1, lows[last])

    def found(self):
        for (items, _, _), (item, docs, scores) in zip(self.tiles, self.held):
            if len(item):
                columns = [pa.array(items[item]), pa.array(docs), pa.array(scores)]
                yield pa.RecordBatch.from_arrays(columns, ["item_id", "doc_id", "score"])


def _scored(tiles, weights, documents, terms, k):
    def run(batches):
        search = _Search(tiles, weights, documents, terms, k)
        for batch in batches:
            for at in range(0, batch.num_rows, TILE_DOCS):
                part = batch.slice(at, TILE_DOCS)
                lists, counts = part.column(2), part.column(3)
                sizes = np.diff(lists.offsets.to_numpy())
                rows = np.repeat(np.arange(part.num_rows), sizes)
                search.add(
                    part.column(0).to_numpy(),
                    part.column(1).to_numpy(),
                    rows,
                    lists.flatten().to_numpy().astype(np.int64),
                    counts.flatten().to_numpy(),
                )
        yield from search.found()

    return run


def item_terms(items, item_col="item_id", text_col=TEXT):
    """`item_id`, `term` and `asked`, how often the item holds the term."""
    distinct = items.select(F.col(item_col).cast("bigint").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    distinct = distinct.where("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    term = F.explode(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(TERM), F.lit(0))).alias("term")
    return distinct.select("item_id", term).groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("asked"))


def _waves(asked):
    """How many waves the items are dealt to by a hash of their id, so that each holds at most `WAVE_PAIRS` pairs, or
    one item alone."""
    sizes = asked.groupBy("item_id").agg(F.count(F.lit(1)).alias("pairs"))
    total, items = sizes.agg(F.coalesce(F.sum("pairs"), F.lit(0)), F.count(F.lit(1))).first()
    waves = max(1, -(-total // WAVE_PAIRS))
    while waves > 1 or total > WAVE_PAIRS:
        dealt = sizes.groupBy(_wave(waves)).agg(F.sum("pairs").alias("pairs"), F.count(F.lit(1)).alias("items"))
        if dealt.where(f"pairs > {WAVE_PAIRS} AND items > 1").isEmpty() or waves > 64 * max(1, items):
            break
        waves *= 2
    return waves


def _wave(waves):
    return F.pmod(F.xxhash64("item_id"), F.lit(waves)).alias("wave")


def weight(documents, holding):
    """What a term counts that `holding` of so many documents hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def search(docs, items, k=10, doc_col=DOC_ID, text_col=TEXT, item_col="item_id", item_text_col=TEXT):
    """`item_id`, `rank`, `doc_id` and `score`: each item's `k` highest-scoring documents with a score above 0.

    Terms are the matches of `TERM` in the whole text, A-Z lower-cased. Scores are whole numbers: for every term of the
    item, repeats included, its weight (`weight`) times a share that saturates with its occurrences in the document
    and falls with the document's length.

    Items are answered in waves of a bounded number of (item, term) pairs, mostly one; a wave's vocabulary is all that
    is sent to the tasks. A first pass counts the vocabulary's terms in every document and is staged (one narrow row per
    document, no shuffle), from which the number of documents holding each term is added up. A second pass goes over
    these rows: tiles of documents, as dense float64 matrices of impacts over the terms that documents and items
    share, are multiplied with tiles of items. Partial sums stay below 2**53, so the products are exact. A task keeps the
    k best of each item, by score and then the smaller id, so only k rows per item and task are shuffled for the last ranking.

    Defined cases: a null text has no terms, nor has an empty one; such documents count nowhere and are not returned.
    A very long text is split in parts between terms. Every row is a document by itself, repeated rows too. Rows
    without an id count in the statistics but are not returned. Equal scores go to the smaller id. Rows of items that share
    an id are one item of all their distinct texts; items without an id, text, or any term in the documents return
    nothing. An empty table of either kind gives no rows. Only the named columns are read, so others cannot clash.
    """
    asked = staged(item_terms(items, item_col, item_text_col), "search-items")
    waves = _waves(asked)
    texts = docs.select(F.col(doc_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = None
    for wave in range(waves):
        pairs = [tuple(r) for r in asked.where(_wave(waves) == wave).orderBy("item_id", "term").collect()]
        words = sorted({term for _, term, _ in pairs})
        numbers = {word: i for i, word in enumerate(words)}
        vocabulary = {word.encode(): i for word, i in numbers.items()}
        postings = staged(in_small_batches(texts).mapInArrow(_postings(vocabulary), POSTINGS), "search-postings")
        documents, terms = postings.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        held = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        weights = np.zeros(max(1, len(words)), np.int64)
        for term, holding in held.collect():  # at most the wave's vocabulary
            weights[term] = weight(documents, holding)
        tiles = _item_tiles([(item_id, numbers[term], count) for item_id, term, count in pairs])
        scoring = in_small_batches(postings.where("doc_id IS NOT NULL")).mapInArrow(_scored(tiles, weights, documents, terms, k), HITS)
        found = scoring if found is None else found.unionByName(scoring)
    ranking = Window.partitionBy("item_id").orderBy(F.col("score").desc(), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(ranking)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
