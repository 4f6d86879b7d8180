"""Splits, folds, balancing, synthetic rows, weights and mini-batches.

All chance comes from md5(``seed-key``) (see :mod:`riskframe.functions.hashing`), so results do not depend on
partitioning or task retries. Exact sizes use the distributed row numbering of
:mod:`riskframe.operators.ordering` (range partitions + broadcast offsets); only per-class counts (one number
per class) reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.defaults import BATCH_SIZE, N_FOLDS, SEED, SMOTE_K, TEST_SHARE
from riskframe.functions.hashing import hash_order, hash_u60
from riskframe.operators.neighbours import nearest
from riskframe.operators.ordering import row_index
from riskframe.session import materialize

KEY = "ACCT_NBR"


def _class_counts(df: DataFrame, label: str) -> dict:
    return {r[label]: int(r["n"]) for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}


def _narrow_ranks(df: DataFrame, key: str, seed: int, by: Sequence[str], name: str) -> DataFrame:
    """(key, *by, name): rows numbered 1..n within ``by`` in seeded hash order, over the narrow projection."""
    narrow = df.select(key, *by, hash_order(key, seed).alias("_rf_h"))
    return row_index(narrow, [F.col("_rf_h"), F.col(key)], by=by, name=name, drop=["_rf_h"])


def _join_back(df: DataFrame, ranks: DataFrame, key: str, by: Sequence[str], name: str) -> DataFrame:
    if len(df.columns) == len(by) + 1:
        return ranks
    return df.join(ranks.select(key, name), key)


def _group_sizes(ranks: DataFrame, by: Sequence[str], name: str) -> dict:
    """Rows per group, read off the numbered narrow table (largest number per group): no extra pass over the input."""
    if not by:
        r = ranks.agg(F.max(name).alias("n")).first()
        return {None: int(r["n"] or 0)}
    return {r[by[0]]: int(r["n"]) for r in ranks.groupBy(*by).agg(F.max(name).alias("n")).collect()}


def hash_ranked(df: DataFrame, key: str = KEY, seed: int = SEED, by: Sequence[str] = (), name: str = "_rf_r") -> DataFrame:
    """Rows numbered 1..n (within ``by``) in seeded hash order — a reproducible shuffle. ``key`` must be unique
    (it breaks hash ties). Only the narrow (key, by) projection is numbered; the numbers are joined back on the
    key, so wide tables are neither range-shuffled nor written for it."""
    return _join_back(df, _narrow_ranks(df, key, seed, by, name), key, by, name)


def split_random(df: DataFrame, key: str = KEY, share: float = TEST_SHARE, seed: int = SEED, name: str = "SPLIT") -> DataFrame:
    """Exactly ceil(share * n) rows go to 'test' (first in hash order), the rest to 'train'."""
    ranks = _narrow_ranks(df, key, seed, (), "_rf_r")
    cut = math.ceil(share * _group_sizes(ranks, (), "_rf_r")[None])
    r = _join_back(df, ranks, key, (), "_rf_r")
    return r.withColumn(name, F.when(F.col("_rf_r") <= cut, "test").otherwise("train")).drop("_rf_r")


def _by_class_cut(label: str, counts: dict, share: float) -> Column:
    expr = None
    for c, n in counts.items():
        cond = F.col(label) == F.lit(c)
        expr = F.when(cond, F.lit(math.ceil(share * n))) if expr is None else expr.when(cond, F.lit(math.ceil(share * n)))
    return expr if expr is not None else F.lit(0)


def split_stratified(df: DataFrame, label: str = "LABEL", key: str = KEY, share: float = TEST_SHARE, seed: int = SEED, name: str = "SPLIT") -> DataFrame:
    """Per class exactly ceil(share * n_class) rows to 'test'; class shares are kept."""
    ranks = _narrow_ranks(df, key, seed, [label], "_rf_r")
    counts = _group_sizes(ranks, [label], "_rf_r")
    r = _join_back(df, ranks, key, [label], "_rf_r")
    return r.withColumn(name, F.when(F.col("_rf_r") <= _by_class_cut(label, counts, share), "test").otherwise("train")).drop("_rf_r")


def split_three_way(
    df: DataFrame, label: str = "LABEL", key: str = KEY, shares: tuple[float, float] = (0.15, 0.15), seed: int = SEED, name: str = "SPLIT"
) -> DataFrame:
    """Stratified train / validation / test; one rank within the class, two cut points."""
    ranks = _narrow_ranks(df, key, seed, [label], "_rf_r")
    counts = _group_sizes(ranks, [label], "_rf_r")
    r = _join_back(df, ranks, key, [label], "_rf_r")
    t_cut = _by_class_cut(label, counts, shares[0])
    v_cut = _by_class_cut(label, counts, shares[0] + shares[1])
    return r.withColumn(
        name, F.when(F.col("_rf_r") <= t_cut, "test").when(F.col("_rf_r") <= v_cut, "validation").otherwise("train")
    ).drop("_rf_r")


def stratified_folds(df: DataFrame, label: str = "LABEL", key: str = KEY, k: int = N_FOLDS, seed: int = SEED, name: str = "FOLD") -> DataFrame:
    """K folds; within each class the hash order is dealt round-robin, so every fold keeps the shares."""
    r = hash_ranked(df, key, seed, by=[label])
    return r.withColumn(name, ((F.col("_rf_r") - 1) % k).cast("int")).drop("_rf_r")


def bootstrap_pick(cls: Column, draw: Column, size: Column, seed: int = SEED) -> Column:
    """The row (from 1) of its class that a draw picks: 60 bits of md5 modulo the class size."""
    return F.pmod(hash_u60(F.concat(cls.cast("string"), F.lit("-"), draw.cast("string")), seed), size) + 1


def balance_bootstrap(df: DataFrame, label: str = "LABEL", key: str = KEY, seed: int = SEED) -> DataFrame:
    """Both classes drawn with replacement up to the larger class's size M; labels reassigned 0 / 1.

    Draw j of class c picks row ``md5(seed-c-j) mod n_c`` of that class. Only the narrow (key, label) projection is
    numbered and its class sizes are read off the numbers; the draws are ``spark.range(2M)`` (distributed, grows with
    the data) joined to it by (class, number), and the wide columns join last, on the key (which must be unique)."""
    numbered = row_index(df.select(key, label), [F.col(key)], by=[label], name="_rf_i")
    counts = _group_sizes(numbered, [label], "_rf_i")
    n0, n1 = counts.get(0, 0), counts.get(1, 0)
    m = max(n0, n1)
    if n0 == 0 or n1 == 0:
        raise ValueError("bootstrap balancing needs rows of both classes")
    draws = df.sparkSession.range(2 * m).select((F.col("id") / m).cast("int").alias("_rf_c"), (F.col("id") % m).alias("DRAW"))
    size = F.when(F.col("_rf_c") == 0, F.lit(n0)).otherwise(F.lit(n1))
    draws = draws.withColumn("_rf_i", bootstrap_pick(F.col("_rf_c"), F.col("DRAW"), size, seed))
    picked = draws.join(numbered.withColumnRenamed(label, "_rf_c"), ["_rf_c", "_rf_i"]).select(key, "DRAW", "_rf_c")
    out = picked.join(df.drop(label), key)
    return out.select(*[c for c in df.columns if c != label], "DRAW", F.col("_rf_c").alias(label))


def smote(df: DataFrame, columns: Sequence[str], label: str = "LABEL", key: str = KEY, k: int = SMOTE_K, seed: int = SEED) -> DataFrame:
    """Synthetic rows of the smaller class, as many as it lacks to the larger one.

    Draw j takes row ``md5(seed-base-j) mod n`` of the smaller class (numbered by key), one of its k nearest rows of that class
    (all where it has fewer) by ``md5(seed-near-j)``, and lies at the share ``md5(seed-place-j)`` of the way between them. Rows
    (DRAW, BASE, NEIGHBOUR, U, the columns, label). The neighbours are exact (:mod:`riskframe.operators.neighbours`); the draws
    are ``spark.range`` joined on the number, so nothing but the class counts reaches the driver. ``key`` must be unique; null
    features count as 0."""
    counts = _class_counts(df, label)
    n0, n1 = counts.get(0, 0), counts.get(1, 0)
    small, n = (1, n1) if n1 <= n0 else (0, n0)
    if n < 2:
        raise ValueError("synthetic rows need two rows of the smaller class")
    features = [F.nanvl(F.coalesce(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(c) for c in columns]
    rows = materialize(df.where(F.col(label) == small).select(key, *features), "smote-rows")
    numbered = row_index(nearest(rows, columns, k, key), [F.col(key)], name="_rf_i")
    draws = df.sparkSession.range(abs(n0 - n1)).withColumnRenamed("id", "DRAW")

    def chance(what: str) -> Column:
        return hash_u60(F.concat(F.lit(f"{what}-"), F.col("DRAW").cast("string")), seed)

    picked = draws.withColumn("_rf_i", F.pmod(chance("base"), F.lit(n)) + 1).join(numbered, "_rf_i")
    other = F.element_at("NEIGHBOURS", (F.pmod(chance("near"), F.size("NEIGHBOURS")) + 1).cast("int"))["key"]
    picked = picked.select("DRAW", F.col(key).alias("BASE"), other.alias("NEIGHBOUR"), (chance("place") / F.lit(2.0**60)).alias("U"))
    for name in ("BASE", "NEIGHBOUR"):
        picked = picked.join(rows.select(F.col(key).alias(name), F.struct(*columns).alias(f"_rf_{name}")), name)
    between = [(F.col("_rf_BASE")[c] + F.col("U") * (F.col("_rf_NEIGHBOUR")[c] - F.col("_rf_BASE")[c])).alias(c) for c in columns]
    return picked.select("DRAW", "BASE", "NEIGHBOUR", "U", *between, F.lit(small).alias(label))


def zero_steps(synthetic: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The transaction sequence of a synthetic row: one step of zeros (it has no transactions of its own)."""
    return synthetic.select("DRAW", F.lit(1).alias("STEP"), *[F.lit(0.0).alias(c) for c in columns])


def class_weights(df: DataFrame, label: str = "LABEL", name: str = "WEIGHT") -> DataFrame:
    """Weight 1 for negatives and negatives/positives for positives (1 when there are no positives)."""
    counts = _class_counts(df, label)
    neg, pos = counts.get(0, 0), counts.get(1, 0)
    w = neg / pos if pos > 0 else 1.0
    return df.withColumn(name, F.when(F.col(label) == 1, F.lit(float(w))).otherwise(F.lit(1.0)))


def mini_batches(df: DataFrame, key: str = KEY, by: Sequence[str] = (), size: int = BATCH_SIZE, seed: int = SEED, name: str = "BATCH") -> DataFrame:
    """Batch number floor((position - 1) / size) after a seeded shuffle, within ``by`` (a few groups, e.g. the
    split)."""
    r = hash_ranked(df, key, seed, by=by)
    return r.withColumn(name, ((F.col("_rf_r") - 1) / size).cast("bigint")).drop("_rf_r")
