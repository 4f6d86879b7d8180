"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a seeded random order, repeated up to ``max_repeats`` times. A document's
virtual finish time is the number of its source's words up to and with it, divided by the source's target. All queues
are merged by one global range sort on the finish time and cut where the total budget is used up. Since each queue is
served in order, the cut is a prefix of every queue: one number for each source, which is joined back to the rows.

Targets: the budget is shared by weight; a source whose share would exceed ``max_repeats`` times its size is held
there and the excess reshared by weight until none is above. Solved in closed form: in ascending order of size / weight
the held sources are a prefix.

Running sums use the two-level prefix sums of ``riskframe.operators.ordering`` (range partitions plus one offset each),
so a source with a third of all rows is spread over many tasks. Only the table of sources, one row each, is sorted in
one task; it meets the rows by a broadcast where it is counted small, else by a shuffle.

Defined results: size is the number of words (null text: 0); null is a source of its own, sorted last; documents
without words take 0; documents that share id and source are queued by the hash of their text, and rows that share that too
stand for one another; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import WORD, table, unused
from riskframe.llm.common import sized as small
from riskframe.llm.registry import register
from riskframe.operators.ordering import prefix_sums, row_index
from riskframe.session import materialize

MAX_REPEATS = 3
WEIGHTS = 3
SEED = "mix-1"


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, size, k (the place in the shuffled queue), text_hash."""
    size = F.coalesce(F.regexp_count(F.col(f"`{text_col}`").cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint")
    return docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        F.col(f"`{source_col}`").cast("string").alias("source"),
        size.alias("size"),
        F.md5(F.concat(F.lit(f"{SEED}-"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))).alias("k"),
        hashed(text_col).alias("text_hash"),
    )


def hashed(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))


def targets_of(sizes: DataFrame, weight: Column | None = None, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """source, source_size, base (words of the sources before it), target, budget: one row for each source.

    ``weight`` is an expression over ``no`` (the source's place, from 1) and ``source``; by default 1, 2, 3, repeating.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = s.withColumn("no", F.row_number().over(by_name))
    s = s.withColumn("base", F.sum("source_size").over(by_name.rowsBetween(Window.unboundedPreceding, 0)) - F.col("source_size"))
    s = s.withColumn("w", ((F.col("no") - 1) % WEIGHTS + 1 if weight is None else weight).cast("double"))
    s = s.withColumn("cap", F.col("source_size") * F.lit(max_repeats))
    rising = Window.orderBy(F.col("cap") / F.col("w"), "no")
    upto, all_rows = rising.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy()
    s = s.withColumn("budget", F.sum("source_size").over(all_rows))
    s = s.withColumn("rest", F.col("budget") - F.sum("cap").over(upto) + F.col("cap"))
    s = s.withColumn("rest_w", F.sum("w").over(all_rows) - F.sum("w").over(upto) + F.col("w"))
    # The first source, in rising order, that its share doesn't fill sets the level of all from it on.
    s = s.withColumn("level", F.when(F.col("rest") / F.col("rest_w") < F.col("cap") / F.col("w"), F.col("rest") / F.col("rest_w")))
    s = s.withColumn("level", F.first("level", ignorenulls=True).over(upto))
    target = F.when(F.col("level").isNull(), F.col("cap").cast("double")).otherwise(F.col("level") * F.col("w"))
    return s.select("source", "no", "source_size", "base", target.alias("target"), "budget")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weight: Column | None = None,
    max_repeats: int = MAX_REPEATS,
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, size, source_size, target, taken, source, k, text_hash."""
    rows = materialize(sized(docs, id_col, text_col, source_col), "mix-sizes")
    sources = small(targets_of(rows, weight, max_repeats), "mix-sources")
    rows = rows.withColumnRenamed("source", "_s").join(sources, F.col("_s").eqNullSafe(F.col("source"))).drop("_s")
    queued = prefix_sums(rows, ["no", "k", "doc_id", "text_hash"], ["size"])
    queued = queued.withColumn("mine", F.col("cum_size") - F.col("base"))
    queued = materialize(queued, "mix-queues")
    epochs = F.sequence(F.lit(0), F.lit(max_repeats - 1))
    at = F.col("epoch") * F.col("source_size") + F.col("mine")
    served = (
        queued.where(F.col("size") > 0)
        .select("no", "size", "k", "doc_id", "target", "budget", "source_size", "mine", F.explode(epochs).alias("epoch"))
        .where(F.col("epoch") * F.col("source_size") < F.col("target"))
        .select("no", "size", "budget", at.alias("at"), (at / F.col("target")).alias("finish"))
    )
    merged = prefix_sums(served, ["finish", "no", "at"], ["size"])
    cuts = merged.where(F.col("cum_size") <= F.col("budget")).groupBy("no").agg(F.max("at").alias("cut"))
    cuts = small(cuts, "mix-cuts")
    out = queued.join(cuts, "no", "left")
    taken = F.lit(0).cast("bigint")
    for e in range(max_repeats):
        taken = taken + F.when(F.lit(e) * F.col("source_size") + F.col("mine") <= F.col("cut"), F.col("size")).otherwise(F.lit(0))
    return out.select("doc_id", "size", "source_size", "target", taken.cast("bigint").alias("taken"), "source", "k", "text_hash")


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mixed corpus: each row as often as the mix takes it, rows that it doesn't take left out. Rows without words
    weigh nothing and stay as they are."""
    p = unused(docs, "_m")
    plan = mix(docs, id_col, text_col, source_col, **options)
    times = F.when(F.col("size") == 0, 1).otherwise((F.col("taken") / F.col("size")).cast("int"))
    key = [F.col(c).alias(f"{p}_{c}") for c in ("doc_id", "source", "text_hash")]
    plan = plan.withColumn(f"{p}_t", times).groupBy(*key).agg(
        F.min(f"{p}_t").alias(f"{p}_low"), F.max(f"{p}_t").alias(f"{p}_high"), F.sum(f"{p}_t").alias(f"{p}_all"), F.count(F.lit(1)).alias(f"{p}_n")
    )
    plan = materialize(plan.where(F.col(f"{p}_high") > 0), "mix-plan")
    here = F.col(f"`{id_col}`").cast("bigint").eqNullSafe(F.col(f"{p}_doc_id")) & F.col(f"`{source_col}`").cast("string").eqNullSafe(F.col(f"{p}_source"))
    here = here & (hashed(text_col) == F.col(f"{p}_text_hash"))
    even = F.col(f"{p}_low") == F.col(f"{p}_high")
    rows = docs.join(plan.where(even), here).withColumn(f"{p}_times", F.col(f"{p}_low"))
    # A queue's cut is one place, so of each source at most one key has rows on both sides of it. Only its rows are numbered:
    # the first ones are taken once more.
    uneven = small(plan.where(~even), "mix-uneven")
    if not uneven.isEmpty():
        split = row_index(docs.join(uneven, here), [f"{p}_doc_id", f"{p}_text_hash", F.rand(7)], [f"{p}_source"], f"{p}_row")
        more = F.col(f"{p}_row") <= F.col(f"{p}_all") - F.col(f"{p}_low") * F.col(f"{p}_n")
        split = split.withColumn(f"{p}_times", F.col(f"{p}_low") + F.when(more, 1).otherwise(0)).drop(f"{p}_row")
        rows = rows.unionByName(split.where(F.col(f"{p}_times") > 0))
    rows = rows.drop(*[c for c in rows.columns if c.startswith(f"{p}_") and c != f"{p}_times"])
    return rows.withColumn(f"{p}_no", F.explode(F.sequence(F.lit(1), F.col(f"{p}_times")))).drop(f"{p}_no", f"{p}_times")


@register(
    "op4_mix_sources",
    r"""
    WITH d AS (
      SELECT doc_id, source, md5('mix-1-' || coalesce(doc_id::VARCHAR, '')) AS k,
             len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
      FROM documents),
    s AS (
      SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS no
      FROM d GROUP BY source),
    c AS (
      SELECT *, ((no - 1) % 3 + 1)::DOUBLE AS w, 3 * source_size AS cap, (sum(source_size) OVER ())::BIGINT AS budget FROM s),
    r AS (
      SELECT *, budget - (sum(cap) OVER up)::BIGINT + cap AS rest, sum(w) OVER () - sum(w) OVER up + w AS rest_w
      FROM c WINDOW up AS (ORDER BY cap / w, no ROWS UNBOUNDED PRECEDING)),
    l AS (
      SELECT *, first_value(CASE WHEN rest / rest_w < cap / w THEN rest / rest_w END IGNORE NULLS)
                OVER (ORDER BY cap / w, no ROWS UNBOUNDED PRECEDING) AS level FROM r),
    t AS (SELECT source, no, source_size, budget, CASE WHEN level IS NULL THEN cap::DOUBLE ELSE level * w END AS target FROM l),
    q AS (
      SELECT doc_id, size, k, no, source_size, target, budget,
             (sum(size) OVER (PARTITION BY no ORDER BY k, doc_id ROWS UNBOUNDED PRECEDING))::BIGINT AS mine
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
    v AS (
      SELECT q.*, e.epoch * source_size + mine AS upto, (e.epoch * source_size + mine) / target AS finish
      FROM q JOIN (SELECT unnest([0, 1, 2]) AS epoch) e ON e.epoch * source_size < target WHERE size > 0),
    m AS (SELECT *, sum(size) OVER (ORDER BY finish, no, upto ROWS UNBOUNDED PRECEDING) AS cum FROM v),
    x AS (SELECT doc_id, no, k, sum(size)::BIGINT AS taken FROM m WHERE cum <= budget GROUP BY ALL)
    SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(x.taken, 0) AS taken
    FROM q LEFT JOIN x ON q.doc_id IS NOT DISTINCT FROM x.doc_id AND q.no = x.no AND q.k = x.k
    """,
)
def op4_mix_sources(spark, sf_dir) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("source", "k", "text_hash")
