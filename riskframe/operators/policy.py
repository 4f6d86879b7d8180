"""Declarative column policies (B1-B6) compiled to one ``select``.

A policy maps column -> action (``none``, ``drop``, ``turn_to_days``, ``one_hot_encode``, ``classify``) plus
value lists for ``classify``. Unlisted columns pass through. Columns changed in place keep their position;
columns created by ``one_hot_encode`` or a multi-list ``classify`` are appended in policy order and replace
their source. ``one_hot_encode`` needs the values present, so a policy is *fitted* first: the fitted policy
holds its category lists and therefore a fixed output schema, and can be applied to other tables (test data)
unchanged.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.defaults import TODAY
from riskframe.operators.ordering import row_index

ACTIONS = ("none", "drop", "turn_to_days", "one_hot_encode", "classify")


def days_since(c: Column | str, today: int = TODAY) -> Column:
    """``turn_to_days`` (B3): today minus an integer day serial; null stays null."""
    return F.lit(today) - (F.col(c) if isinstance(c, str) else c)


def in_list(c: Column | str, values: Sequence) -> Column:
    """1 if the value is in ``values`` else 0; null gives 0."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col.isin(list(values)), F.lit(False)).cast("int")


def class_flags(column: str, lists: Sequence[Sequence]) -> list[Column]:
    """Multi-list ``classify`` (B5): one 0/1 flag ``{column}_class_{i}`` per list; lists may overlap."""
    return [in_list(column, lst).alias(f"{column}_class_{i}") for i, lst in enumerate(lists)]


def _value_name(v, dtype: T.DataType) -> str:
    if isinstance(dtype, (T.FloatType, T.DoubleType)) and float(v).is_integer():
        return str(int(v))
    return str(v)


def one_hot_flags(column: str, values: Sequence, dtype: T.DataType) -> list[Column]:
    """One-hot (B6): ``{column}_{value}`` indicators for the fitted values; null gives all zeros."""
    return [
        F.when(F.col(column) == F.lit(v), 1).otherwise(0).alias(f"{column}_{_value_name(v, dtype)}") for v in values
    ]


@dataclass(frozen=True)
class ColumnPolicy:
    actions: Mapping[str, str]
    classes: Mapping[str, Sequence[Sequence]] = field(default_factory=dict)
    today: int = TODAY
    #: Declared value lists of one-hot columns; ``fit`` reads those that aren't declared from the table.
    categories: Mapping[str, Sequence] = field(default_factory=dict)

    def __post_init__(self) -> None:
        for col, act in self.actions.items():
            if act not in ACTIONS:
                raise ValueError(f"unknown action {act!r} for column {col!r}")
            if act == "classify" and not self.classes.get(col):
                raise ValueError(f"classify needs value lists for column {col!r}")

    def fit(self, df: DataFrame) -> FittedPolicy:
        """The category list of every one-hot column: as declared, else its distinct values (one small distinct job per
        column; their number is the width of the output's schema)."""
        cats: dict[str, list] = {}
        for col, act in self.actions.items():
            if act == "one_hot_encode" and col in df.columns:
                if col in self.categories:
                    cats[col] = list(self.categories[col])
                else:
                    cats[col] = [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col).collect()]
        return FittedPolicy(self, cats)

    def apply(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)


@dataclass(frozen=True)
class FittedPolicy:
    policy: ColumnPolicy
    categories: Mapping[str, Sequence]

    def transform(self, df: DataFrame) -> DataFrame:
        acts = self.policy.actions
        types = {f.name: f.dataType for f in df.schema.fields}
        kept: list[Column] = []
        for col in df.columns:
            act = acts.get(col, "none")
            if act == "none":
                kept.append(F.col(col))
            elif act == "turn_to_days":
                kept.append(days_since(col, self.policy.today).alias(col))
            elif act == "classify" and len(self.policy.classes[col]) == 1:
                kept.append(in_list(col, self.policy.classes[col][0]).alias(col))
            # drop, one-hot and multi-list classify remove the source column
        appended: list[Column] = []
        for col, act in acts.items():
            if col not in types:
                continue
            if act == "one_hot_encode":
                appended += one_hot_flags(col, self.categories.get(col, []), types[col])
            elif act == "classify" and len(self.policy.classes[col]) > 1:
                appended += class_flags(col, self.policy.classes[col])
        return df.select(*kept, *appended)


def label_encode(df: DataFrame, column: str, fitted_on: DataFrame | None = None, unknown: str = "UNKNOWN") -> DataFrame:
    """Label encoding (I5): distinct texts sorted ascending -> 0..n-1; null is read as the text ``unknown``.

    The value table is fitted once (on ``fitted_on`` or ``df``), numbered without a single-task sort, and joined
    back; it has one row per distinct text, so AQE broadcasts it only when its measured size allows.
    """
    src = fitted_on if fitted_on is not None else df
    txt = F.coalesce(F.col(column).cast("string"), F.lit(unknown))
    codes = row_index(src.select(txt.alias("_txt")).distinct(), ["_txt"], name="_code")
    out = df.withColumn("_txt", txt).join(codes, "_txt", "left")
    return out.withColumn(column, (F.col("_code") - 1).cast("int")).drop("_txt", "_code")
