"""Shapley values of a trained model: sums, brute force over orders, and the path table evaluated by another engine."""

from itertools import combinations
from math import factorial

import duckdb
import pytest
from pyspark.sql import functions as F

from riskframe.operators import models
from riskframe.operators.tree_attribution import Path, TreeAttribution, raw_prediction, unexplained

FEATURES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def explained(spark):
    r = lambda i: F.pmod(F.hash(F.col("ACCT_NBR") * 31 + i), F.lit(1000)) / 100.0
    df = spark.range(600).withColumnRenamed("id", "ACCT_NBR").withColumns({f: r(i) for i, f in enumerate(FEATURES)})
    df = df.withColumn("LABEL", ((F.col("a") * F.col("b") > 20) | (F.col("c") > 9)).cast("int"))
    model = models.fit(models.with_class_weight(df), FEATURES, models.gbt({"maxIter": 3, "maxDepth": 4}))
    return df, model, TreeAttribution.of(model, FEATURES, spark)


def shapley(paths, row):
    """Of one row, from the definition: mean gain of each feature over all sets of known features."""

    def worth(known):
        total = 0.0
        for p in paths:
            v = p.value
            for f, lo, hi, share in p.bounds:
                v *= (lo < row[f] <= hi) if f in known else share
            total += v
        return total

    n, out = len(FEATURES), {}
    for f in FEATURES:
        rest = [g for g in FEATURES if g != f]
        out[f] = sum(factorial(k) * factorial(n - k - 1) / factorial(n) * (worth({*s, f}) - worth(set(s))) for k in range(n) for s in combinations(rest, k))
    return out


def test_base_and_contributions_are_the_raw_prediction(explained):
    df, model, fitted = explained
    rows = fitted.contributions(raw_prediction(model, df)).withColumn("DIFF", unexplained(fitted))
    assert rows.agg(F.max("DIFF")).first()[0] < 1e-9
    assert rows.count() == 600 and rows.columns[: len(df.columns)] == df.columns
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "ArrowEval" not in plan.replace("vector_to_array", "")


def test_equals_the_definition(explained):
    df, _, fitted = explained
    for row in fitted.contributions(df.limit(25)).collect():
        want = shapley(fitted.paths, row)
        assert [row[f"SHAP_{f}"] for f in FEATURES] == pytest.approx([want[f] for f in FEATURES], abs=1e-12)


def test_another_engine_evaluates_the_path_table(spark, explained):
    """The raw prediction and the worth of two sets of known features, from the path table in SQL."""
    df, model, fitted = explained
    con = duckdb.connect()
    con.register("p", fitted.path_table(spark).toPandas())
    con.register("d", raw_prediction(model, df).toPandas())
    x = "CASE FEATURE " + " ".join(f"WHEN '{f}' THEN d.{f}" for f in FEATURES) + " END"
    holds = f"CASE WHEN FEATURE IS NULL OR ((ABOVE IS NULL OR {x} > ABOVE) AND (UPTO IS NULL OR {x} <= UPTO)) THEN 1.0 ELSE 0.0 END"

    def worth(known):
        names = ", ".join(repr(f) for f in known) or "''"
        sql = f"SELECT ACCT_NBR, sum(v) FROM (SELECT ACCT_NBR, PATH, any_value(VALUE) * product(CASE WHEN FEATURE IN ({names}) THEN {holds} ELSE coalesce(SHARE, 1) END) AS v FROM d, p GROUP BY ACCT_NBR, PATH) GROUP BY ACCT_NBR"
        return dict(con.execute(sql).fetchall())

    raw = dict(con.execute("SELECT ACCT_NBR, RAW FROM d").fetchall())
    assert worth(FEATURES) == pytest.approx(raw, abs=1e-9)
    assert list(worth([]).values()) == pytest.approx([fitted.base] * 600, abs=1e-9)


def test_table_of_one_path():
    assert Path(2.0, (("a", 0.0, 1.0, 0.25),)).table() == [[-0.5, 1.5]]
    two = Path(1.0, (("a", 0.0, 1.0, 0.5), ("b", 0.0, 1.0, 0.5))).table()
    assert [a + b for a, b in zip(*two)] == pytest.approx([-0.25, -0.25, -0.25, 0.75])


def test_mean_and_dependence(explained):
    df, _, fitted = explained
    means = {r.FEATURE: r.MEAN_ABS for r in fitted.mean_abs(df).collect()}
    assert set(means) == set(FEATURES) and means["d"] < means["a"]
    pairs = fitted.dependence(df, 2).collect()
    assert len(pairs) == 1200 and {p.FEATURE for p in pairs} == set(sorted(means, key=means.get)[-2:])


def test_nulls_and_nan_and_batches_of_rows(spark, explained):
    """Contributions are computed on batches of rows, not by functions that walk the paths for each row; a null meets every
    condition, NaN is above every bound."""
    df, _, fitted = explained
    odd = df.withColumn("a", F.when(F.col("ACCT_NBR") % 3 == 0, None).when(F.col("ACCT_NBR") % 3 == 1, F.lit(float("nan"))).otherwise(F.col("a")))
    rows = fitted.contributions(odd.where("ACCT_NBR < 60"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "aggregate(" not in plan
    for r in rows.collect():
        got = {f: 0.0 for f in FEATURES}
        for p in fitted.paths:
            held = [r[f] is None or ((r[f] != r[f] or r[f] > lo) and (hi == float("inf") or r[f] <= hi)) for f, lo, hi, _ in p.bounds]
            for (f, *_), values in zip(p.bounds, p.table()):
                got[f] += values[sum(h << j for j, h in enumerate(held))]
        assert [r[f"SHAP_{f}"] for f in FEATURES] == [got[f] for f in FEATURES]


def test_dependence_query_adds_up_its_own_pairs(spark, monkeypatch):
    """WHOLE comes from the contributions of the returned pairs, also of an account that repeats: one pair that is off shows."""
    from riskframe.plans import eval_queries

    names = eval_queries._ATTR_COLS
    r = lambda i: F.pmod(F.hash(F.col("ACCT_NBR") * 31 + i), F.lit(1000)) / 100.0
    df = spark.range(300).withColumnRenamed("id", "ACCT_NBR").withColumns({f: r(i) for i, f in enumerate(names)})
    df = df.withColumn("LABEL", (F.col(names[0]) * F.col(names[1]) > 20).cast("int"))
    model = models.fit(models.with_class_weight(df), names, models.gbt({"maxIter": 2}))
    fitted = TreeAttribution.of(model, names, spark)
    rows = fitted.contributions(raw_prediction(model, df.unionByName(df.where("ACCT_NBR = 7"))))
    monkeypatch.setattr(eval_queries, "_explained", lambda *a: (fitted, rows))
    good = eval_queries.attribution_dependence(spark, "")
    assert good.columns == ["ACCT_NBR", "FEATURE", "VALUE", "WHOLE"] and good.where("WHOLE").count() == good.count() == (299 + 4) * len(names)
    right = TreeAttribution.dependence
    shift = F.when((F.col("ACCT_NBR") == 11) & (F.col("FEATURE") == names[0]), 1e-3).otherwise(0.0)
    monkeypatch.setattr(TreeAttribution, "dependence", lambda self, *a: right(self, *a).withColumn("CONTRIBUTION", F.col("CONTRIBUTION") + shift))
    assert {x.ACCT_NBR for x in eval_queries.attribution_dependence(spark, "").where("NOT WHOLE").collect()} == {11}
