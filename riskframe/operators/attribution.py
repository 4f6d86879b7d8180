"""Feature attributions from a linear surrogate.

Tree-explainer values need a per-row single-machine library; what the reports use is (a) the mean absolute
contribution per feature and (b) (value, contribution) pairs for the top features. For a linear score on
standardised features the contributions are exact: ``beta_j * (x_j - mean_j) / std_j``. Here beta_j is the
feature's correlation with the label (fitted in one aggregate: three numbers per feature).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = "ACCT_NBR"


@dataclass(frozen=True)
class LinearAttribution:
    features: tuple[str, ...]
    means: tuple[float, ...]
    stds: tuple[float, ...]
    betas: tuple[float, ...]

    @staticmethod
    def fit(df: DataFrame, features: Sequence[str], label: str) -> LinearAttribution:
        aggs = []
        for c in features:
            x, y = F.col(c).cast("double"), F.col(label).cast("double")
            corr = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))  # null for a constant column
            aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"), corr.alias(f"r_{c}")]
        row = df.agg(*aggs).first()

        def beta(c: str) -> float:
            r, s = row[f"r_{c}"], row[f"s_{c}"]
            return 0.0 if r is None or (isinstance(r, float) and math.isnan(r)) or not s else float(r)

        return LinearAttribution(
            tuple(features),
            tuple(float(row[f"m_{c}"] or 0.0) for c in features),
            tuple(float(row[f"s_{c}"] or 0.0) for c in features),
            tuple(beta(c) for c in features),
        )

    def _of(self, c: str) -> Column:
        i = self.features.index(c)
        m, s, b = self.means[i], self.stds[i], self.betas[i]
        return F.lit(0.0) if s == 0 or b == 0 else F.lit(b) * (F.col(c) - F.lit(m)) / F.lit(s)

    def mean_abs(self, df: DataFrame) -> DataFrame:
        """(FEATURE, MEAN_ABS) of all features: one aggregate with a column for each, then stacked; no row is exploded."""
        wide = df.agg(*[F.avg(F.abs(self._of(c))).alias(c) for c in self.features])
        return wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("FEATURE"), F.col(c).alias("MEAN_ABS")) for c in self.features])))

    def contributions(self, df: DataFrame, features: Sequence[str] | None = None, key: str = KEY) -> DataFrame:
        """Long form (key, FEATURE, VALUE, CONTRIBUTION) of some features (default: all)."""
        rows = [
            F.struct(F.lit(c).alias("FEATURE"), F.col(c).cast("double").alias("VALUE"), self._of(c).alias("CONTRIBUTION"))
            for c in features or self.features
        ]
        return df.select(key, F.inline(F.array(*rows)))


def top_attributions(mean_abs: DataFrame, k: int) -> DataFrame:
    """The k features with the largest mean |contribution| (ties by name)."""
    return mean_abs.orderBy(F.col("MEAN_ABS").desc(), F.col("FEATURE").asc()).limit(k)


def dependence(fitted: LinearAttribution, df: DataFrame, k: int) -> DataFrame:
    """(value, contribution) pairs of the k top features; their names (k texts) come to the driver, and only their
    columns are exploded."""
    top = [r["FEATURE"] for r in top_attributions(fitted.mean_abs(df), k).collect()]
    return fitted.contributions(df, top).select("ACCT_NBR", "FEATURE", "VALUE", "CONTRIBUTION")
