"""Evaluation on (score, label) tables.

Point metrics are single-pass conditional aggregates. Curve metrics (ROC, PR, AUC, AP) first collapse rows to
one row per distinct score (a combinable aggregate), then take running totals along the score order with the
two-level prefix sum of :mod:`riskframe.operators.ordering` — never a window over all rows in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.defaults import (
    FOCAL_GAMMA,
    FOCAL_SMOOTHING,
    FOCAL_WEIGHTS,
    SWEEP_COUNT,
    SWEEP_START,
    SWEEP_STEP,
    THRESHOLD_DEFAULT,
)
from riskframe.functions.bands import apply_threshold
from riskframe.operators.ordering import prefix_sums
from riskframe.session import materialize


def sweep_thresholds(start: float = SWEEP_START, step: float = SWEEP_STEP, count: int = SWEEP_COUNT) -> list[float]:
    """0.10, 0.15, ... (``count`` values), rounded to remove float drift."""
    return [round(start + i * step, 10) for i in range(count)]


def _div(a: Column, b: Column) -> Column:
    """a / b as double, 0 when b is 0 (the 'zero when undefined' convention)."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _f1(p: Column, r: Column) -> Column:
    return _div(2 * p * r, p + r)


def confusion_counts(df: DataFrame, pred: Column, label: str = "LABEL") -> DataFrame:
    """TP, FP, FN, TN in one aggregate."""
    y = F.col(label)
    return df.agg(
        F.count(F.when((pred == 1) & (y == 1), 1)).alias("TP"),
        F.count(F.when((pred == 1) & (y == 0), 1)).alias("FP"),
        F.count(F.when((pred == 0) & (y == 1), 1)).alias("FN"),
        F.count(F.when((pred == 0) & (y == 0), 1)).alias("TN"),
    )


def _pred(score: str, threshold: float) -> Column:
    return apply_threshold(score, threshold)


def confusion_matrix(df: DataFrame, score: str = "SCORE", label: str = "LABEL", threshold: float = THRESHOLD_DEFAULT) -> DataFrame:
    """L2: 2x2 counts as rows (TRUTH, PRED, N), zero cells kept."""
    c = confusion_counts(df, _pred(score, threshold), label)
    return c.selectExpr("stack(4, 0, 0, TN, 0, 1, FP, 1, 0, FN, 1, 1, TP) AS (TRUTH, PRED, N)")


def binary_metrics(df: DataFrame, score: str = "SCORE", label: str = "LABEL", threshold: float = THRESHOLD_DEFAULT) -> DataFrame:
    """L3: precision, recall and F1 of the positive class at a threshold (0 when undefined)."""
    c = confusion_counts(df, _pred(score, threshold), label)
    p, r = _div(F.col("TP"), F.col("TP") + F.col("FP")), _div(F.col("TP"), F.col("TP") + F.col("FN"))
    return c.select(F.lit(float(threshold)).alias("THRESHOLD"), p.alias("PRECISION"), r.alias("RECALL"), _f1(p, r).alias("F1"))


def auc_hard(df: DataFrame, score: str = "SCORE", label: str = "LABEL", threshold: float = THRESHOLD_DEFAULT) -> DataFrame:
    """L4: ROC area of hard predictions = (TPR + TNR) / 2."""
    c = confusion_counts(df, _pred(score, threshold), label)
    tpr, tnr = _div(F.col("TP"), F.col("TP") + F.col("FN")), _div(F.col("TN"), F.col("TN") + F.col("FP"))
    return c.select(((tpr + tnr) / 2).alias("AUC_HARD"))


def accuracy(df: DataFrame, score: str = "SCORE", label: str = "LABEL", threshold: float = THRESHOLD_DEFAULT) -> DataFrame:
    """Share of correct hard predictions."""
    return df.agg(F.avg(F.when(_pred(score, threshold) == F.col(label), 1.0).otherwise(0.0)).alias("ACCURACY"))


def classification_report(df: DataFrame, score: str = "SCORE", label: str = "LABEL", threshold: float = THRESHOLD_DEFAULT) -> DataFrame:
    """L1: per class precision/recall/F1/support, accuracy, macro and weighted means (0 when undefined)."""
    c = confusion_counts(df, _pred(score, threshold), label)
    tp, fp, fn, tn = (F.col(x) for x in ("TP", "FP", "FN", "TN"))
    p1, r1 = _div(tp, tp + fp), _div(tp, tp + fn)
    p0, r0 = _div(tn, tn + fn), _div(tn, tn + fp)
    f1, f0 = _f1(p1, r1), _f1(p0, r0)
    s1, s0 = (tp + fn).cast("bigint"), (tn + fp).cast("bigint")
    n = s0 + s1
    acc = _div(tp + tn, n)
    wide = c.select(
        p0.alias("p0"), r0.alias("r0"), f0.alias("f0"), s0.alias("s0"),
        p1.alias("p1"), r1.alias("r1"), f1.alias("f1"), s1.alias("s1"),
        acc.alias("acc"), n.alias("n"),
        ((p0 + p1) / 2).alias("pm"), ((r0 + r1) / 2).alias("rm"), ((f0 + f1) / 2).alias("fm"),
        _div(p0 * s0 + p1 * s1, n).alias("pw"), _div(r0 * s0 + r1 * s1, n).alias("rw"), _div(f0 * s0 + f1 * s1, n).alias("fw"),
    )
    return wide.selectExpr(
        "stack(5, '0', p0, r0, f0, s0, '1', p1, r1, f1, s1, 'accuracy', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), acc, n,"
        " 'macro avg', pm, rm, fm, n, 'weighted avg', pw, rw, fw, n) AS (CLASS, PRECISION, RECALL, F1, SUPPORT)"
    )


def _steps_below(score: str, ts: Sequence[float]) -> Column:
    """How many of the ascending thresholds lie below the score, by halving; 0 for null and NaN."""

    def place(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.col(score) > F.lit(float(ts[mid])), place(mid + 1, hi)).otherwise(place(lo, mid))

    return F.when(F.isnan(F.col(score).cast("double")), F.lit(0)).otherwise(place(0, len(ts)))


def threshold_curve(df: DataFrame, score: str = "SCORE", label: str = "LABEL", thresholds: Sequence[float] | None = None) -> DataFrame:
    """Precision, recall and F1 at each threshold.

    Each row gets one number, how many thresholds lie below its score (a few comparisons), and is counted by it: at most one
    row for each threshold and one more leaves the aggregate, over which the counts at a threshold are sums of the later
    ones. Null and NaN scores are never flagged."""
    ts = list(thresholds) if thresholds is not None else sweep_thresholds()
    rising = sorted(set(ts))
    y = F.col(label)
    counts = df.groupBy(_steps_below(score, rising).alias("_rf_k")).agg(F.count(F.when(y == 1, 1)).alias("_rf_p"), F.count(F.lit(1)).alias("_rf_n"))
    parts = [F.coalesce(F.sum("_rf_p"), F.lit(0)).alias("P")]
    for i in range(len(rising)):
        above = F.col("_rf_k") > i
        parts.append(F.coalesce(F.sum(F.when(above, F.col("_rf_p"))), F.lit(0)).alias(f"tp{i}"))
        parts.append(F.coalesce(F.sum(F.when(above, F.col("_rf_n"))), F.lit(0)).alias(f"pp{i}"))
    a = counts.agg(*parts)
    rows = []
    for t in ts:
        i = rising.index(t)
        p = _div(F.col(f"tp{i}"), F.col(f"pp{i}"))
        r = _div(F.col(f"tp{i}"), F.col("P"))
        rows.append(F.struct(F.lit(float(t)).alias("THRESHOLD"), p.alias("PRECISION"), r.alias("RECALL"), _f1(p, r).alias("F1")))
    return a.select(F.inline(F.array(*rows)))


def best_threshold(curve: DataFrame) -> DataFrame:
    """The first (smallest) threshold with the highest F1."""
    return curve.orderBy(F.col("F1").desc(), F.col("THRESHOLD").asc()).limit(1)


def score_groups(df: DataFrame, score: str = "SCORE", label: str = "LABEL") -> DataFrame:
    """One row per distinct score: positives and negatives at that score (combinable aggregate)."""
    return df.groupBy(F.col(score).alias("SCORE")).agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("POS"), F.count(F.when(F.col(label) != 1, 1)).alias("NEG")
    )


def _grouped(df: DataFrame, score: str, label: str) -> tuple[DataFrame, int, int]:
    """The score groups, written once, and the totals of positives and negatives read off them."""
    groups = materialize(score_groups(df, score, label), "score-groups")
    row = groups.agg(F.sum("POS").alias("P"), F.sum("NEG").alias("N")).first()
    return groups, int(row["P"] or 0), int(row["N"] or 0)


def roc_points(df: DataFrame, score: str = "SCORE", label: str = "LABEL") -> DataFrame:
    """(THRESHOLD, FPR, TPR) for each distinct score (score >= threshold is positive), plus the start point
    (+inf, 0, 0). All points are kept (no collinear-point dropping)."""
    groups, P, N = _grouped(df, score, label)
    cum = prefix_sums(groups, [F.col("SCORE").desc()], ["POS", "NEG"])
    pts = cum.select(
        F.col("SCORE").alias("THRESHOLD"), _div(F.col("cum_NEG"), F.lit(N)).alias("FPR"), _div(F.col("cum_POS"), F.lit(P)).alias("TPR")
    )
    start = df.sparkSession.range(1).select(
        F.lit(float("inf")).alias("THRESHOLD"), F.lit(0.0).alias("FPR"), F.lit(0.0).alias("TPR")
    )
    return pts.unionByName(start)


def pr_points(df: DataFrame, score: str = "SCORE", label: str = "LABEL") -> DataFrame:
    """(THRESHOLD, PRECISION, RECALL) for each distinct score, plus the end point (+inf, 1, 0)."""
    groups, P, _ = _grouped(df, score, label)
    cum = prefix_sums(groups, [F.col("SCORE").desc()], ["POS", "NEG"])
    pts = cum.select(
        F.col("SCORE").alias("THRESHOLD"),
        _div(F.col("cum_POS"), F.col("cum_POS") + F.col("cum_NEG")).alias("PRECISION"),
        _div(F.col("cum_POS"), F.lit(P)).alias("RECALL"),
    )
    end = df.sparkSession.range(1).select(
        F.lit(float("inf")).alias("THRESHOLD"), F.lit(1.0).alias("PRECISION"), F.lit(0.0).alias("RECALL")
    )
    return pts.unionByName(end)


def average_precision(df: DataFrame, score: str = "SCORE", label: str = "LABEL") -> DataFrame:
    """Sum over distinct scores (high to low) of (recall step) x precision = sum(pos_k * precision_k) / P."""
    groups, P, _ = _grouped(df, score, label)
    cum = prefix_sums(groups, [F.col("SCORE").desc()], ["POS", "NEG"])
    prec = _div(F.col("cum_POS"), F.col("cum_POS") + F.col("cum_NEG"))
    return cum.agg(_div(F.sum(F.col("POS") * prec), F.lit(P)).alias("AVERAGE_PRECISION"))


def auc_score(df: DataFrame, score: str = "SCORE", label: str = "LABEL") -> DataFrame:
    """ROC area on scores with ties counted half: sum_k pos_k * (neg strictly below + neg_k / 2) / (P * N)."""
    groups, P, N = _grouped(df, score, label)
    cum = prefix_sums(groups, [F.col("SCORE").asc()], ["NEG"], inclusive=False)
    return cum.agg(_div(F.sum(F.col("POS") * (F.col("cum_NEG") + F.col("NEG") / 2.0)), F.lit(P * N)).alias("AUC"))


def focal_loss(
    df: DataFrame,
    score: str = "SCORE",
    label: str = "LABEL",
    gamma: float = FOCAL_GAMMA,
    weights: Sequence[float] = FOCAL_WEIGHTS,
    smoothing: float = FOCAL_SMOOTHING,
    eps: float = 1e-6,
) -> DataFrame:
    """Mean focal loss of probabilities, with class-weighted, label-smoothed cross-entropy.

    ce = (1 - s) * w_y * -log p_y + s / 2 * (w_0 * -log p_0 + w_1 * -log p_1); loss = (1 - e^-ce)^gamma * ce.
    Probabilities are clipped to [eps, 1 - eps]."""
    p1 = F.least(F.greatest(F.col(score), F.lit(eps)), F.lit(1 - eps))
    l0, l1 = -F.log(1 - p1), -F.log(p1)
    w0, w1 = (F.lit(float(w)) for w in weights)
    y = F.col(label)
    nll = F.when(y == 1, w1 * l1).otherwise(w0 * l0)
    smooth = (w0 * l0 + w1 * l1) / 2
    ce = (1 - smoothing) * nll + smoothing * smooth
    fl = F.pow(1 - F.exp(-ce), F.lit(gamma)) * ce
    return df.agg(F.avg(fl).alias("FOCAL_LOSS"))
