"""Scored-account operators: votes, class balance, risk counts, ranking, paging, sampling, unions (D9-D13,
G1-G7, H1-H2, I7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.defaults import HEAD_ROWS, PAGE_SIZE, RISK_LEVELS, SEED
from riskframe.functions.hashing import hash_order
from riskframe.operators.ordering import row_index
from riskframe.operators.windows import group_mode
from riskframe.session import materialize

KEY = "ACCT_NBR"


def vote_by_account(rows: DataFrame, accounts: DataFrame, key: str = KEY, pred: str = "PRED", name: str = "VOTE") -> DataFrame:
    """Per account the mode of its row predictions (smallest on ties); an account without rows votes 0."""
    votes = group_mode(rows, key, pred, name)
    return accounts.select(key).join(votes, key, "left").select(key, F.coalesce(F.col(name), F.lit(0)).alias(name))


def class_balance(df: DataFrame, label: str = "LABEL") -> DataFrame:
    """Negatives, positives, positive share (%) and the negative/positive weight (1.0 without positives)."""
    pos = F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("bigint")
    neg = F.sum(F.when(F.col(label) == 0, 1).otherwise(0)).cast("bigint")
    a = df.agg(neg.alias("N_NEG"), pos.alias("N_POS"), F.count(F.lit(1)).alias("N"))
    return a.select(
        "N_NEG", "N_POS", "N",
        F.coalesce(F.try_divide(100.0 * F.col("N_POS"), F.col("N")), F.lit(0.0)).alias("POS_PCT"),
        F.when(F.col("N_POS") > 0, F.col("N_NEG") / F.col("N_POS")).otherwise(F.lit(1.0)).alias("POS_WEIGHT"),
    )


def risk_distribution(df: DataFrame, level: str = "RISK_LEVEL", levels: Sequence[str] = RISK_LEVELS) -> DataFrame:
    """Accounts per risk level, every level present (zero counts kept); rows without a level are left out.

    One pass of conditional counts, then ``stack`` into rows — no join with a level table."""
    counts = df.agg(*[F.count(F.when(F.col(level) == lv, 1)).alias(f"n{i}") for i, lv in enumerate(levels)])
    pairs = ", ".join(f"'{lv}', n{i}" for i, lv in enumerate(levels))
    return counts.selectExpr(f"stack({len(levels)}, {pairs}) AS ({level}, N)")


def flag_summary(df: DataFrame, pred: str = "PRED") -> DataFrame:
    """Total, flagged and flagged share (%)."""
    a = df.agg(F.count(F.lit(1)).alias("TOTAL"), F.sum(F.col(pred)).cast("bigint").alias("FLAGGED"))
    return a.select(
        "TOTAL", F.coalesce("FLAGGED", F.lit(0)).cast("bigint").alias("FLAGGED"),
        F.coalesce(F.try_divide(100.0 * F.col("FLAGGED"), F.col("TOTAL")), F.lit(0.0)).alias("FLAGGED_PCT"),
    )


def duplicate_key_count(df: DataFrame, key: str = KEY) -> DataFrame:
    """Number of rows whose key occurs more than once (all copies counted)."""
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return g.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("DUPLICATE_ROWS"))


def rank_by_score(df: DataFrame, score: str = "SCORE", key: str = KEY, name: str = "RANK") -> DataFrame:
    """G1: position in the list sorted by score (highest first, key breaks ties), numbered without one-task sort."""
    return row_index(df, [F.col(score).desc(), F.col(key).asc()], name=name)


def page(df: DataFrame, number: int, size: int = PAGE_SIZE, score: str = "SCORE", key: str = KEY) -> DataFrame:
    """Page ``number`` (1-based) of the ranked list, with the page count ceil(n / size). ``df`` may be a ranked table
    that was written once (with its RANK): a page is then a filter on RANK that the scan takes over."""
    ranked = df if "RANK" in df.columns else materialize(rank_by_score(df, score, key), "ranked")
    lo, hi = (number - 1) * size, number * size
    rows = ranked.where((F.col("RANK") > lo) & (F.col("RANK") <= hi))
    n = ranked.agg(F.max("RANK")).first()[0] or 0  # read off the ranked table (Parquet statistics): no pass over the input
    return rows.withColumn("PAGES", F.lit(-(-n // size)).cast("bigint"))


def top_k(df: DataFrame, by: str, k: int, tie: str) -> DataFrame:
    """The k rows with the largest ``by`` (ties by ``tie``); a bounded TakeOrderedAndProject."""
    return df.orderBy(F.col(by).desc(), F.col(tie).asc()).limit(k)


def rank_trials(df: DataFrame, objective: str = "OBJECTIVE", trial: str = "TRIAL") -> DataFrame:
    """Trials by objective, highest first, nulls last; equal objectives in the order of the trial number."""
    return df.orderBy(F.col(objective).desc_nulls_last(), F.col(trial).asc())


def sample_one(df: DataFrame, key: str = KEY, seed: int = SEED) -> DataFrame:
    """One row chosen by a seeded hash order (same choice in every engine that has md5)."""
    return df.orderBy(hash_order(key, seed).asc(), F.col(key).asc()).limit(1)


def head_sample(df: DataFrame, order: Sequence[str], n: int = HEAD_ROWS) -> DataFrame:
    """The first ``n`` rows in an explicit order (all rows when fewer)."""
    return df.orderBy(*order).limit(n)


def sort_keys(df: DataFrame, order: Sequence[Column], name: str = "POS") -> DataFrame:
    """Multi-key, mixed-direction sort materialised as a position column (range-partitioned)."""
    return row_index(df, order, name=name)


def union_rows(parts: Sequence[DataFrame]) -> DataFrame:
    """H1: bag union by column name."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def feature_catalog(df: DataFrame, exclude: Sequence[str] = ()) -> list[tuple[int, str, str]]:
    """(position, name, type) of the feature columns of a table, from its schema."""
    cols = [f for f in df.schema.fields if f.name not in exclude]
    return [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(cols)]


def feature_drift(train: DataFrame, new: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """H2: feature names missing from / extra in a new table, as rows (STATUS, FEATURE)."""
    spark = train.sparkSession
    a = spark.createDataFrame([(n,) for _, n, _ in feature_catalog(train, exclude)], "FEATURE string")
    b = spark.createDataFrame([(n,) for _, n, _ in feature_catalog(new, exclude)], "FEATURE string")
    return a.exceptAll(b).withColumn("STATUS", F.lit("missing")).unionByName(
        b.exceptAll(a).withColumn("STATUS", F.lit("extra"))
    ).select("STATUS", "FEATURE")


def detail_rows(df: DataFrame, key: str, fields: Sequence[str], value_fmt: dict[str, str] | None = None) -> DataFrame:
    """Each row as (key, FIELD, VALUE) text rows; missing values become empty text."""
    value_fmt = value_fmt or {}

    def txt(c: str) -> Column:
        v = F.format_string(value_fmt[c], F.col(c)) if c in value_fmt else F.col(c).cast("string")
        return F.coalesce(F.when(F.col(c).isNotNull(), v), F.lit(""))

    pairs = F.array(*[F.struct(F.lit(c).alias("FIELD"), txt(c).alias("VALUE")) for c in fields])
    return df.select(key, F.inline(pairs))
