"""Sharding by longest-processing-time scheduling: groups of equal texts, the largest first, go to the least-loaded
shard through a heap.

The heap needs the groups one after another, but only their sizes. Groups of one size form a run, so the driver gets
one row (size, number of groups) for each different group size -- a summary whose length is below the square root of
twice the corpus's bytes, and in practice below the longest text -- and pushes whole runs through the heap: within a
run the j-th group goes to the j-th smallest of the arithmetic progressions load, load + size, ... of the shards, which
has a closed form. Each group then finds its shard from its place in its run and the loads at the run's start, in
parallel. The outcome is, group by group, that of the sequential heap (ties: larger size, smaller text hash, smaller
shard first); ``tests/llm`` compares the two.

Size is the UTF-8 length of the text plus one per document; a group's size is the sum over its copies. The law is
``bytes``: shard sizes are near equal as far as groups that must stay together allow.

Defined results: null text is a document without bytes (size 1) that groups with the empty text; null ids sort first
in the slots; repeated rows are two members of a group; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm.common import id_text, table, unused
from riskframe.llm.registry import register
from riskframe.operators.ordering import row_index
from riskframe.session import materialize

SHARDS = 16


def place(j: np.ndarray, size: np.ndarray, loads: np.ndarray) -> np.ndarray:
    """Shard of the j-th group (from 0) of a run of groups of ``size``, given the ``loads`` (n x shards) at its start.

    Group j takes the j-th smallest number among load + i * size, i = 0, 1, .. over all shards (ties: smaller shard).
    """
    n, k = loads.shape
    order = np.argsort(loads, axis=1, kind="stable")
    level = np.take_along_axis(loads, order, 1)
    out = np.zeros(n, dtype=np.int64)
    done = np.zeros(n, dtype=bool)
    for m in range(k - 1, -1, -1):  # all shards up to the m-th take part once its load is reached
        top, step = level[:, m : m + 1], size[:, None]
        turns = -((level[:, : m + 1] - top) // step)  # ceil((top - level) / size)
        before = turns.sum(axis=1)
        now = ~done & (j >= before)
        if now.any():
            nxt = level[now, : m + 1] + turns[now] * step[now]
            cycle = np.lexsort((order[now, : m + 1], nxt), axis=1)
            at = ((j[now] - before[now]) % (m + 1)).astype(np.int64)
            out[now] = np.take_along_axis(order[now, : m + 1], np.take_along_axis(cycle, at[:, None], 1), 1)[:, 0]
            done |= now
    return out


def schedule(runs: list[tuple[int, int]], shards: int) -> list[list[int]]:
    """Loads at the start of each run of (size, groups), largest size first, after pushing the runs through a heap."""
    heap, starts = [(0, i) for i in range(shards)], []
    for size, groups in runs:
        loads = [0] * shards
        for load, i in heap:
            loads[i] = load
        starts.append(loads)
        if groups > 4 * shards:  # whole rounds at once: level the shards, then each gets as many
            want, base = groups, np.array(loads, dtype=object)
            lo, hi = min(loads), max(loads) + size * (groups + 1)
            while lo < hi:  # the largest line that at most `groups` progressions' members lie below
                mid = (lo + hi + 1) // 2
                below = sum(max(0, -((b - mid) // size)) for b in base)
                lo, hi = (mid, hi) if below <= want else (lo, mid - 1)
            given = [max(0, -((b - lo) // size)) for b in base]
            heap = [(b + g * size, i) for i, (b, g) in enumerate(zip(loads, given))]
            heapq.heapify(heap)
            groups -= sum(given)
        for _ in range(groups):
            load, i = heap[0]
            heapq.heapreplace(heap, (load + size, i))
    return starts


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, g (SHA-256 of the text)."""
    return id_text(docs, id_col, text_col).select(
        "doc_id",
        (F.octet_length("text") + 1).cast("bigint").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.sha2("text", 256).alias("g"),
    )


def placed_rows(docs: DataFrame, id_col: str, text_col: str, shards: int) -> DataFrame:
    """doc_id, size, text_crc32, g, shard, slot (from 1) of every row."""
    spark = docs.sparkSession
    rows = materialize(sized(docs, id_col, text_col), "shard-rows")
    groups = rows.groupBy("g").agg(F.sum("size").alias("total"))
    ranked = row_index(groups, [F.col("total").desc(), "g"], name="pos")
    ranked = materialize(ranked, "shard-groups")
    runs = ranked.groupBy("total").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first")).sort(F.col("total").desc())
    sizes = [(int(r["total"]), int(r["n"]), int(r["first"])) for r in runs.collect()]
    loads = schedule([(s, n) for s, n, _ in sizes], shards)
    starts = pd.DataFrame({"total": [s for s, _, _ in sizes], "first": [f for _, _, f in sizes], "loads": loads})
    starts = spark.createDataFrame(starts, "total bigint, first bigint, loads array<bigint>")

    @F.pandas_udf("int")
    def shard_of(j: pd.Series, size: pd.Series, at: pd.Series) -> pd.Series:
        if not len(j):
            return pd.Series([], dtype="int32")
        return pd.Series(place(j.to_numpy(), size.to_numpy(), np.stack(at.to_numpy())).astype("int32"))

    placed = ranked.join(starts, "total").select("g", shard_of(F.col("pos") - F.col("first"), "total", "loads").alias("shard"))
    return row_index(rows.join(placed, "g"), ["doc_id", "g"], by=["shard"], name="slot")


def assign_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """One row for each row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    return placed_rows(docs, id_col, text_col, shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("slot") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, files_per_shard: int = 8) -> DataFrame:
    """Writes the rows of ``docs`` below ``path`` as shard=<n> folders of Parquet files, with their slot, and returns the
    assignment (doc_id, size, text_crc32, shard, slot).

    A row finds its place by id and SHA-256 of its text; rows that share both take the places of their kind in any order.
    Columns of the input named shard or slot are written as shard_in and slot_in. A shard's rows go to ``files_per_shard``
    tasks by slot, so no task writes a whole shard."""
    plan = placed_rows(docs, id_col, text_col, shards).withColumn("slot", F.col("slot") - 1)
    plan = materialize(plan.select("doc_id", "size", "text_crc32", "g", "shard", "slot"), "shard-plan")
    docs = docs.withColumnsRenamed({c: f"{c}_in" for c in docs.columns if c.lower() in ("shard", "slot")})
    p = unused(docs, "_p")
    kinds = plan.groupBy(F.col("doc_id").alias(f"{p}_id"), F.col("g").alias(f"{p}_g")).agg(F.min("slot").alias(f"{p}_at"), F.count(F.lit(1)).alias(f"{p}_n"), F.min("shard").alias("shard"))
    sha = F.sha2(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), 256)
    rows = docs.join(kinds, F.col(f"`{id_col}`").cast("bigint").eqNullSafe(F.col(f"{p}_id")) & (sha == F.col(f"{p}_g")))
    one = rows.where(F.col(f"{p}_n") == 1).withColumn(f"{p}_no", F.lit(1).cast("bigint"))
    more = rows.where(F.col(f"{p}_n") > 1)
    if not plan.groupBy("doc_id", "g").count().where("count > 1").isEmpty():
        one = one.unionByName(row_index(more, [F.rand(7)], [f"{p}_id", f"{p}_g"], f"{p}_no").select(one.columns))
    rows = one.withColumn("slot", F.col(f"{p}_at") + F.col(f"{p}_no") - 1).drop(*[f"{p}_{c}" for c in ("id", "g", "at", "n", "no")])
    lane = F.col("slot") % files_per_shard
    rows.repartition(shards * files_per_shard, "shard", lane).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return plan.drop("g")


@register("op6_shard_documents")
def op6_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents"))
