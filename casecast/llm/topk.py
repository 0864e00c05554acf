"""Exact top-k search by inner product with Fagin's threshold algorithm."""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from casecast.llm.common import in_small_batches
from casecast.session import staged

#: Rows and components of one sorted block of candidates, about; a task holds one block at a time.
BLOCK_ROWS, BLOCK_CELLS = 8192, 1 << 20
#: Queries and their components that are sent to the tasks at once, about.
BLOCK_QUERIES, WAVE_CELLS = 1 << 16, 1 << 22
#: Tasks that search the blocks at most. Each returns k rows for a query, however many blocks it has.
MOST_TASKS = 4096
#: Blocks in one file, about, once there are more files than tasks. A file's blocks are written and read together.
FILE_BLOCKS = 8
#: Depth of the first round of sorted access; each round goes twice as deep.
FIRST_DEPTH = 8

BLOCKS = "dims int, ids binary, vectors binary, ascending binary"
HITS = "query_id bigint, vec_id bigint, score bigint"
NOTHING = np.empty(0, np.int64), np.empty(0, np.int64)


class SortedLists:
    """Candidates with their rows in the order of each dimension."""

    def __init__(self, ids, vectors, ascending=None):
        self.ids, self.vectors = ids, vectors
        self.order = np.argsort(vectors, axis=0, kind="stable") if ascending is None else ascending
        self.values = np.take_along_axis(vectors, self.order, axis=0)
        self.floats, self.largest = vectors.astype(np.float64), float(np.abs(vectors).max(initial=0))

    def top(self, query, k, skip_id, held=NOTHING):
        """The k best of these rows and those `held` for one query, best first, ties to the smaller id, without rows
        called `skip_id`.

        Every list is read from the end where it adds most. After each round the bound is what a row not met yet can
        reach at best, the sum over the lists of the last value read; the search ends once the kth score is above it
        (a row at the bound could still win a tie), or when all rows are met. What is held from other blocks counts
        from the start, so that a block without better rows ends early.
        """
        rows, dims = self.vectors.shape
        exact = self.largest * float(np.abs(query).max(initial=0)) * dims < 2**53
        table = self.floats if exact else self.vectors
        seen = self.ids == skip_id
        best_ids, best_scores = held
        used = np.flatnonzero(query)
        falling = query[used] > 0
        depth, step = 0, FIRST_DEPTH
        while depth < rows:
            reach = min(rows, depth + step)
            down = self.order[rows - reach : rows - depth, used[falling]]
            up = self.order[depth:reach, used[~falling]]
            met = np.zeros(rows, bool)
            met[down.ravel()] = True
            met[up.ravel()] = True
            if not len(used):
                met[:] = True
            new = np.flatnonzero(met & ~seen)
            seen |= met
            if len(new):
                scores = _products(table[new], query)
                if len(best_ids) == k:
                    reaching = scores >= best_scores[-1]
                    new, scores = new[reaching], scores[reaching]
                all_ids, all_scores = np.concatenate([best_ids, self.ids[new]]), np.concatenate([best_scores, scores])
                keep = np.lexsort((all_ids, -all_scores))[:k]
                best_ids, best_scores = all_ids[keep], all_scores[keep]
            depth, step = reach, step * 2
            if seen.all():
                break
            last = np.where(falling, self.values[rows - depth, used], self.values[depth - 1, used])
            if len(best_ids) == k and best_scores[-1] > int((last.astype(object) * query[used].astype(object)).sum()):
                break
        return best_ids, best_scores


def _products(vectors, query):
    """Integer inner products: of vectors in floating point where that is exact, else by Python's integers."""
    kind = vectors.dtype if vectors.dtype == np.float64 else object
    return (vectors.astype(kind, copy=False) @ query.astype(kind)).astype(np.int64)


def _sorted_block(rows: pd.DataFrame) -> pd.DataFrame:
    vectors = np.stack(rows["vector"].to_numpy()).astype(np.int64)
    ascending = np.argsort(vectors, axis=0, kind="stable").astype(np.int32)
    block = {"dims": vectors.shape[1], "ids": rows["id"].to_numpy(np.int64).tobytes(), "vectors": vectors.tobytes()}
    return pd.DataFrame([block | {"ascending": ascending.tobytes()}])


def _search(queries, k):
    """Tasks that take their blocks one after the other and hold each query's k best rows so far."""

    def run(batches):
        held = {dims: [NOTHING] * len(ids) for dims, (ids, _) in queries.items()}
        for batch in batches:
            for dims, *block in zip(*(column.to_pylist() for column in batch.columns)):
                if dims not in queries:
                    continue
                ids, vectors, ascending = (np.frombuffer(x, kind) for x, kind in zip(block, (np.int64, np.int64, np.int32)))
                lists = SortedLists(ids, vectors.reshape(-1, dims), ascending.reshape(-1, dims))
                own = held[dims]
                for i, (query_id, query) in enumerate(zip(*queries[dims])):
                    own[i] = lists.top(query, k, query_id, own[i])
        for dims, own in held.items():
            counts = [len(ids) for ids, _ in own]
            found = np.repeat(queries[dims][0], counts), *(np.concatenate(column) for column in zip(*own))
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in found], ["query_id", "vec_id", "score"])

    return run


def _usable(table, id_col, vector_col):
    vector = F.col(vector_col).cast("array<bigint>").alias("vector")
    chosen = table.select(F.col(id_col).cast("bigint").alias("id"), vector)
    whole = (F.size("vector") > 0) & ~F.exists("vector", lambda x: x.isNull())
    return chosen.where(F.col("id").isNotNull() & whole)


def _parts(vectors, rows, cells):
    """How many parts of about so many rows and components there are."""
    n, size = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("vector")), F.lit(0))).first()
    return max(1, -(-n // rows), -(-size // cells))


def _part(parts):
    return F.pmod(F.xxhash64("id", "vector"), F.lit(parts)).cast("int")


def sorted_blocks(candidates):
    """One row per block of different candidates of one length: their ids, their vectors, and their order by every dimension."""
    parts = _parts(candidates, BLOCK_ROWS, BLOCK_CELLS)
    dealt = candidates.distinct().select("id", "vector", _part(parts).alias("block"), F.size("vector").alias("dims"))
    dealt = in_small_batches(dealt.repartition(min(parts, max(MOST_TASKS, parts // FILE_BLOCKS)), "block"))
    return dealt.groupBy("block", "dims").applyInPandas(_sorted_block, BLOCKS)


def _by_length(wave):
    """A wave's queries as arrays, by the length of their vectors."""
    rows = wave.select("id", "vector").toArrow()
    ids, lists = rows.column("id").to_numpy(), rows.column("vector").combine_chunks()
    sizes = lists.value_lengths().to_numpy()
    cells, ends = lists.flatten().to_numpy(), np.cumsum(sizes)
    found = {}
    for dims in np.unique(sizes).tolist():
        own = np.flatnonzero(sizes == dims)
        found[dims] = ids[own], cells[(ends[own] - dims)[:, None] + np.arange(dims)]
    return found


def top_k(queries, candidates, k=5, id_col="id", vector_col="vector"):
    """`query_id`, `rank`, `vec_id` and `score`: each query's `k` best candidates by integer inner product.

    Both tables have an id (bigint) and a vector (array of bigint). Candidates lie in blocks by a hash of their row, are
    sorted by every dimension and staged once. Queries go to the tasks in waves of a bounded number of components,
    mostly one; a wave reads the blocks again and shuffles none of them. A task takes its blocks one after the other and
    runs the threshold algorithm for each query from the k best rows found so far. So neither a task's memory nor the
    rows shuffled for one row of the tables grow with the tables: candidates are shuffled twice, of each query and task
    k rows are, and there are at most `MOST_TASKS` tasks.

    Defined cases: a row is no candidate for queries of its own id. Vectors that are null, empty or hold a null take
    no part, nor do rows without an id; equal rows count once. Vectors of another length than the query's are no
    candidates for it. Rows that share an id but not the vector are candidates each, and as queries compete for the
    same ranks. Ties go to the smaller id. Fewer than k candidates: all of them. An empty table gives no rows. Only the two
    named columns are read, so others cannot clash.
    """
    queries, candidates = (_usable(table, id_col, vector_col) for table in (queries, candidates))
    blocks = staged(sorted_blocks(candidates), "search-blocks")
    waves = _parts(queries, BLOCK_QUERIES, WAVE_CELLS)
    asked = queries.distinct().withColumn("wave", _part(waves))
    if waves > 1:  # every wave reads the files of its own rows
        asked = staged(asked.repartition("wave").sortWithinPartitions("wave"), "search-queries")

    def ranked(hits):
        ranking = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
        return hits.withColumn("rank", F.row_number().over(ranking)).where(F.col("rank") <= k)

    def answered(wave):
        sent = _by_length(asked.where(F.col("wave") == wave))
        return ranked(in_small_batches(blocks).coalesce(MOST_TASKS).mapInArrow(_search(sent, k), HITS))

    found = answered(0)
    if waves > 1:  # a wave's queries leave the driver with its answers
        found = staged(found.drop("rank"), "search-hits")
        for wave in range(1, waves):
            found = found.unionByName(staged(answered(wave).drop("rank"), "search-hits"))
        found = ranked(found)
    return found.select("query_id", "rank", "vec_id", "score")


def quantised(vectors, scale=256, id_col="vec_id", vector_col="embedding"):
    """`id` and `vector`, each component x as floor(scale * x); null if any component is null or not finite."""
    values = F.transform(F.col(vector_col).cast("array<double>"), lambda x: x * scale)
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(values, lambda x: F.floor(x))
    return vectors.select(F.col(id_col).cast("bigint").alias("id"), F.when(~bad, whole).alias("vector"))
