"""Scalar band, threshold and text expressions (I1-I4, I6, I8). All are plain Column expressions (codegen)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskframe.defaults import AMOUNT_BANDS, AMOUNT_CUTS, RISK_CUTS, RISK_LEVELS, SCORE_HIGH, SCORE_MEDIUM


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def right_closed_band(c: Column | str, cuts: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the right-closed bin ``(cuts[i], cuts[i+1]]`` holding the value; null outside or for null.

    ``cuts`` has one entry fewer than bins when the last bin is open-ended (``len(labels) == len(cuts)``).
    """
    x = _c(c)
    bounds = list(cuts) + ([float("inf")] if len(labels) == len(cuts) else [])
    expr = None
    for lo, hi, lab in zip(bounds[:-1], bounds[1:], labels):
        cond = (x > F.lit(lo)) & (x <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def amount_band(c: Column | str, cuts: Sequence[float] = AMOUNT_CUTS, labels: Sequence[str] = AMOUNT_BANDS) -> Column:
    """Amount band (I1): (1,500] small, (500,100000] medium, (100000,inf) large; <= 1 or null gives null."""
    return right_closed_band(c, cuts, labels)


def risk_band_cut(p: Column | str, cuts: Sequence[float] = RISK_CUTS, labels: Sequence[str] = RISK_LEVELS) -> Column:
    """Risk level of a probability (I2): (0,0.3] Low, (0.3,0.6] Medium, (0.6,1] High; exactly 0 gives null."""
    return right_closed_band(p, cuts, labels)


def risk_band_score(s: Column | str, high: float = SCORE_HIGH, medium: float = SCORE_MEDIUM) -> Column:
    """Dashboard level of a score (I3): >= high 'high', >= medium 'medium', else 'low'; NaN and null are 'low'."""
    x = _c(s)
    real = x.isNotNull() & ~F.isnan(x)
    return F.when(real & (x >= high), "high").when(real & (x >= medium), "medium").otherwise("low")


def apply_threshold(p: Column | str, t: float | Column) -> Column:
    """Hard prediction (I4): 1 when the probability is strictly greater than the threshold, else 0 (also for null, and for
    NaN, which Spark would order above every number)."""
    over = _c(p) > (t if isinstance(t, Column) else F.lit(float(t)))
    return F.when(over & ~F.isnan(_c(p).cast("double")), 1).otherwise(0)


def feature_string(columns: Sequence[str]) -> Column:
    """Feature values joined with commas (I6); null contributes an empty field."""
    return F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def score_text(s: Column | str, decimals: int = 4) -> Column:
    """Score as text with fixed decimals (I8)."""
    return F.format_string(f"%.{decimals}f", _c(s))
