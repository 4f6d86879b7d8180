"""Exact top-k search by inner product on multi-resolution segment statistics.

**Integers.** A component x becomes floor(256 x). Between whole vectors q and x, score and distance are tied: 2 q.x =
|q|^2 + |x|^2 - d^2(q, x), so a lower bound of the distance is an upper bound of the score, and equal bounds decide.

**Resolutions.** A vector is cut into 1, 4, 16, .. segments. Of a segment of length l with mean m and deviation s, d^2 is at
least l ((m_q - m_x)^2 + (s_q - s_x)^2); the sum over segments bounds the whole, more closely the finer the cut. A task
takes its candidates in chunks, and a lot of queries: at each resolution, coarse to fine, it computes the bound of every
query and candidate that is left (one product of their statistics) and keeps the candidates that some query can still use;
of these only the pairs whose bound isn't behind the query's k-th best score so far get their exact score. Bounds are
floating-point numbers with a margin above their rounding; scores are whole numbers.

**Distribution.** The queries, a stated part of the rows, are numbered and dealt into lots of at most ``LOT`` rows and
``LOT_BYTES``; the driver holds one lot at a time and hands it to the tasks, which read the candidates from a written
table, without a shuffle, and return for each query their own k best that reach its threshold. The first threshold of a
query is its k-th best score over the ``SEEDS`` rows with the smallest hash: scores of true candidates, so it can only rule
out what isn't among the best. The tasks' answers of a lot are joined by rank and written before the next lot starts, so a
lost executor costs a task, not a lot. The work is as large as queries times rows, less what the bounds rule out; no row
leaves its task but as an answer.

Defined results: a null vector, or one that holds a null or non-finite component, is neither query nor candidate; a row with
a null id is a candidate (after all others of its score) and no query; rows that share an id are rows of their own, and only
the query's own row is left out for it; a shorter vector counts as zeros in the places that it lacks, an empty one scores 0;
components beyond 2^53 / 256 are as exact as their doubles, floor(256 x) and scores beyond 64 bits are held at the bounds of
64 bits; an empty table, or one without queries, gives an empty result; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import table
from riskframe.llm.registry import register
from riskframe.operators.ordering import row_index
from riskframe.session import materialize, scratch_path

K, EVERY, SCALE = 5, 50, 256
#: Queries of a lot (rows and bytes of components), rows that give the first thresholds, candidates of a chunk.
LOT, LOT_BYTES, SEEDS, CHUNK = 2048, 32 << 20, 2048, 2048
#: Cells of a matrix of bounds that are held at once, least length of a segment, segments of the next resolution.
CELLS, FINEST, FINER = 4_000_000, 4, 4
_I64 = np.iinfo(np.int64)


class Segments:
    """Statistics of the rows of a matrix of whole numbers: for each resolution a matrix whose row products are the largest
    scores that the segments' means and deviations allow (|q|^2 + |x|^2 less the least distance, halved)."""

    def __init__(self, vectors: np.ndarray, dims: int):
        self.levels = []
        parts = 1
        while dims and (parts == 1 or dims // parts >= FINEST):
            cuts = np.linspace(0, dims, parts + 1).astype(int)
            cols = []
            for a, b in zip(cuts[:-1], cuts[1:]):
                part = vectors[:, a:b].astype(np.float64)
                cols += [part.mean(1) * np.sqrt(b - a), part.std(1) * np.sqrt(b - a)]
            self.levels.append(np.stack(cols, 1))
            parts *= FINER
        self.length = np.sqrt((vectors.astype(np.float64) ** 2).sum(1))


def scores_of(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products (every query, every row)."""
    if not queries.size or not rows.size:
        return np.zeros((len(queries), len(rows)), np.int64)
    most = float(np.abs(queries.astype(np.float64)).max()) * float(np.abs(rows.astype(np.float64)).max()) * queries.shape[1]
    if most < 2**53:  # every partial sum is a whole number that a double holds
        return (queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    if most < 2**62:
        return queries @ rows.T
    exact = queries.astype(object) @ rows.astype(object).T
    return np.clip(exact, int(_I64.min), int(_I64.max)).astype(np.int64)


class Best:
    """The k best answers of every query of a lot: scores, ids (null last) and the threshold that an answer must reach."""

    def __init__(self, thresholds: np.ndarray, k: int):
        self.k, self.least = k, thresholds.copy()
        self.query = np.zeros(0, np.int64)
        self.score, self.vec, self.no_id = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, query: np.ndarray, score: np.ndarray, vec: np.ndarray, no_id: np.ndarray) -> None:
        q, s = np.concatenate([self.query, query]), np.concatenate([self.score, score])
        v, n = np.concatenate([self.vec, vec]), np.concatenate([self.no_id, no_id])
        by = np.lexsort((v, n, ~s, q))  # ~s: descending, without the overflow of -s
        q, s, v, n = q[by], s[by], v[by], n[by]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        keep, last = place < self.k, place == self.k - 1
        self.query, self.score, self.vec, self.no_id = q[keep], s[keep], v[keep], n[keep]
        self.least[q[last]] = np.maximum(self.least[q[last]], s[last])


def search(lot: np.ndarray, own: np.ndarray, stats: Segments, best: Best, rows: np.ndarray, row_no: np.ndarray, vec: np.ndarray, no_id: np.ndarray) -> int:
    """Puts what ``rows`` hold into ``best``; the number of exact scores that were needed."""
    here, exact = Segments(rows, rows.shape[1]), 0
    step = max(1, CELLS // max(1, len(rows)))
    for lo in range(0, len(lot), step):
        some = slice(lo, lo + step)
        least = best.least[some, None].astype(np.float64)
        # The margin covers the rounding of means, deviations, their products and the threshold.
        need = least - np.abs(least) * 1e-12 - stats.length[some, None] * (here.length.max(initial=0.0) * 1e-9) - 1e-6
        left = np.arange(len(rows))
        alive = np.ones((len(need), len(rows)), dtype=bool)
        for q_level, x_level in zip(stats.levels, here.levels):
            alive = q_level[some] @ x_level[left].T >= need
            used = alive.any(0)
            left, alive = left[used], alive[:, used]
        exact += int(alive.sum())
        score = scores_of(lot[some], rows[left])
        alive &= (score >= best.least[some, None]) & (own[some, None] != row_no[left])
        q, x = np.nonzero(alive)
        best.add(q + lo, score[q, x], vec[left[x]], no_id[left[x]])
    return exact


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of whole numbers, the missing places zero."""
    out = np.zeros((len(column), dims), np.int64)
    size = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) == out.size:
        return flat.reshape(out.shape).astype(np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def whole(x: Column) -> Column:
    """floor(256 x), x as double, held at the bounds of 64 bits."""
    y = F.floor(x.cast("double") * SCALE)
    top = F.lit(2.0**63)
    scaled = x.cast("double") * SCALE
    return F.when(scaled >= top, F.lit(int(_I64.max))).when(scaled <= -top, F.lit(int(_I64.min))).otherwise(y)


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """row (a number of its own), vec_id, v (whole numbers) of every row that takes part, written."""
    x = F.col(f"`{vector_col}`")
    # A double that isn't finite less itself is NaN.
    fine = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double") - c.cast("double")))
    some = vectors.where(F.coalesce(fine, F.lit(False))).select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), F.transform(x, whole).alias("v"))
    return materialize(some.withColumn("row", F.monotonically_increasing_id()), "topk-vectors")


def top_k(
    vectors: DataFrame,
    is_query: Column | None = None,
    k: int = K,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    lot_rows: int = LOT,
) -> DataFrame:
    """query_id, rank, vec_id, score: of each query (``is_query`` over ``vec_id``; by default ids divisible by 50) the k
    best other rows, equal scores by id."""
    spark = vectors.sparkSession
    rows = quantised(vectors, id_col, vector_col)
    wanted = F.col("vec_id") % EVERY == 0 if is_query is None else is_query
    dims = rows.agg(F.max(F.size("v"))).first()[0]
    out, schema = scratch_path(spark, "topk-answers"), "query bigint, query_id bigint, vec_id bigint, score bigint"
    spark.createDataFrame([], schema).withColumn("rank", F.lit(0)).write.parquet(out)
    if dims is None:
        return spark.read.parquet(out).select("query_id", "rank", "vec_id", "score")
    per_lot = max(1, min(lot_rows, LOT_BYTES // (8 * max(1, dims))))
    queries = row_index(rows.where(F.coalesce(wanted, F.lit(False))), ["row"], name="no")
    queries = materialize(queries.withColumn("lot", F.floor((F.col("no") - 1) / per_lot)), "topk-queries")
    lots = queries.agg(F.max("lot")).first()[0]
    seeds = rows.select("row", "vec_id", "v").orderBy(F.xxhash64("row"), "row").limit(max(k + 1, min(SEEDS, LOT_BYTES // (8 * max(1, dims))))).toArrow()
    seed_v, seed_row = matrix(seeds.column("v").combine_chunks(), dims), seeds.column("row").to_numpy()
    for i in range(0 if lots is None else lots + 1):
        lot = queries.where(F.col("lot") == i).select("row", "vec_id", "v").toArrow()
        answers = answers_of(rows, lot, seed_v, seed_row, dims, k)
        by = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
        answers.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).write.mode("append").parquet(out)
    return spark.read.parquet(out).select("query_id", "rank", "vec_id", "score")


def answers_of(rows: DataFrame, lot: pa.Table, seed_v: np.ndarray, seed_row: np.ndarray, dims: int, k: int) -> DataFrame:
    """query (the row's number), query_id, vec_id, score: each task's k best for every query of the lot."""
    vectors, own, ids = matrix(lot.column("v").combine_chunks(), dims), lot.column("row").to_numpy(), lot.column("vec_id").to_numpy()
    first = np.full(len(vectors), _I64.min)
    for lo in range(0, len(vectors), 512):
        s = scores_of(vectors[lo : lo + 512], seed_v)
        s[own[lo : lo + 512, None] == seed_row[None, :]] = _I64.min
        if s.shape[1] >= k:
            first[lo : lo + 512] = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
    shared = rows.sparkSession.sparkContext.broadcast((vectors, own, ids, first))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, own, ids, first = shared.value
        best, stats = Best(first, k), Segments(vectors, dims)
        for b in batches:
            for lo in range(0, len(b), CHUNK):
                part = b.slice(lo, CHUNK)
                vec = part.column(1)
                search(vectors, own, stats, best, matrix(part.column(2), dims), part.column(0).to_numpy(), vec.fill_null(0).to_numpy(), vec.is_null().to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays(
            [pa.array(own[best.query]), pa.array(ids[best.query]), pa.array(best.vec, mask=best.no_id), pa.array(best.score)], ["query", "query_id", "vec_id", "score"]
        )

    return rows.select("row", "vec_id", "v").mapInArrow(task, "query bigint, query_id bigint, vec_id bigint, score bigint")


@register(
    "op11_exact_topk",
    """
    WITH v AS (
      SELECT row_number() OVER () AS no, vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::HUGEINT) AS v
      FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = len(embedding)),
    s AS (
      SELECT q.no, q.vec_id AS query_id, c.vec_id,
             coalesce(list_sum(list_transform(range(1, least(len(q.v), len(c.v)) + 1), lambda i: q.v[i] * c.v[i])), 0)::BIGINT AS score
      FROM v q JOIN v c ON q.no <> c.no WHERE q.vec_id % 50 = 0)
    SELECT query_id, (row_number() OVER (PARTITION BY no ORDER BY score DESC, vec_id NULLS LAST))::INTEGER AS rank, vec_id, score
    FROM s QUALIFY rank <= 5
    """,
)
def op11_exact_topk(spark, sf_dir) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))
