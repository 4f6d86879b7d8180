"""Registered queries: evaluation on the fixed score view (L1-L12, L15, I14) attributions of a trained model and of a
linear surrogate (L13, L14)."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from riskframe.defaults import SEED
from riskframe.functions.hashing import sql_hash_order
from riskframe.operators import attribution, metrics, models, sampling, tree_attribution
from riskframe.plans.common import rounded
from riskframe.plans.registry import register
from riskframe.session import materialize
from riskframe.sources import fixtures as fx
from riskframe.sources.fixtures import with_views


def _scored(spark, sf):
    return fx.scored(spark, sf)


def _cm(t: float = 0.5) -> str:
    return (
        f"SELECT count(CASE WHEN SCORE > {t} AND LABEL = 1 THEN 1 END) AS TP, count(CASE WHEN SCORE > {t} AND LABEL = 0 THEN 1 END) AS FP, "
        f"count(CASE WHEN SCORE <= {t} AND LABEL = 1 THEN 1 END) AS FN, count(CASE WHEN SCORE <= {t} AND LABEL = 0 THEN 1 END) AS TN FROM v_scored"
    )


def _d(a: str, b: str) -> str:
    return f"COALESCE(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0), 0.0)"


@register(
    "confusion_matrix",
    with_views(
        f"WITH c AS ({_cm()}) SELECT 0 AS TRUTH, 0 AS PRED, TN AS N FROM c UNION ALL SELECT 0, 1, FP FROM c "
        "UNION ALL SELECT 1, 0, FN FROM c UNION ALL SELECT 1, 1, TP FROM c",
        "v_scored",
    ),
)
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(_scored(spark, sf))


_PR = f"{_d('TP', 'TP + FP')} AS P, {_d('TP', 'TP + FN')} AS R"


@register(
    "binary_metrics",
    with_views(
        f"WITH c AS ({_cm()}), m AS (SELECT {_PR} FROM c) SELECT CAST(0.5 AS DOUBLE) AS THRESHOLD, round(P, 6) AS PRECISION, round(R, 6) AS RECALL, "
        f"round({_d('2 * P * R', 'P + R')}, 6) AS F1 FROM m",
        "v_scored_nan",
    ),
)
def binary_metrics(spark, sf):
    return rounded(metrics.binary_metrics(_scored(spark, sf)))


@register(
    "auc_hard",
    with_views(f"WITH c AS ({_cm()}) SELECT round(({_d('TP', 'TP + FN')} + {_d('TN', 'TN + FP')}) / 2, 6) AS AUC_HARD FROM c", "v_scored"),
)
def auc_hard(spark, sf):
    return rounded(metrics.auc_hard(_scored(spark, sf)))


@register(
    "accuracy",
    with_views("SELECT round(avg(CASE WHEN (CASE WHEN SCORE > 0.5 THEN 1 ELSE 0 END) = LABEL THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END), 6) AS ACCURACY FROM v_scored", "v_scored"),
)
def accuracy(spark, sf):
    return rounded(metrics.accuracy(_scored(spark, sf)))


_REPORT = f"""WITH c AS ({_cm()}),
 m AS (SELECT {_d('TN', 'TN + FN')} AS p0, {_d('TN', 'TN + FP')} AS r0, TN + FP AS s0,
              {_d('TP', 'TP + FP')} AS p1, {_d('TP', 'TP + FN')} AS r1, TP + FN AS s1, {_d('TP + TN', 'TP + TN + FP + FN')} AS acc FROM c),
 f AS (SELECT *, {_d('2 * p0 * r0', 'p0 + r0')} AS f0, {_d('2 * p1 * r1', 'p1 + r1')} AS f1, s0 + s1 AS n FROM m)
SELECT '0' AS CLASS, round(p0, 6) AS PRECISION, round(r0, 6) AS RECALL, round(f0, 6) AS F1, s0 AS SUPPORT FROM f
UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1, 6), s1 FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round(acc, 6), n FROM f
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), n FROM f
UNION ALL SELECT 'weighted avg', round({_d('p0 * s0 + p1 * s1', 'n')}, 6), round({_d('r0 * s0 + r1 * s1', 'n')}, 6),
  round({_d('f0 * s0 + f1 * s1', 'n')}, 6), n FROM f"""


@register("classification_report", with_views(_REPORT, "v_scored"))
def classification_report(spark, sf):
    return rounded(metrics.classification_report(_scored(spark, sf)))


_TS = ", ".join(f"({round(0.10 + 0.05 * i, 2)})" for i in range(16))
_CURVE = f"""WITH t AS (SELECT * FROM (VALUES {_TS}) v(THRESHOLD)),
 c AS (SELECT t.THRESHOLD, count(CASE WHEN s.SCORE > t.THRESHOLD AND NOT isnan(s.SCORE) AND s.LABEL = 1 THEN 1 END) AS TP,
   count(CASE WHEN s.SCORE > t.THRESHOLD AND NOT isnan(s.SCORE) THEN 1 END) AS PP, count(CASE WHEN s.LABEL = 1 THEN 1 END) AS P
   FROM t, v_scored_nan s GROUP BY t.THRESHOLD),
 m AS (SELECT THRESHOLD, {_d('TP', 'PP')} AS PRECISION, {_d('TP', 'P')} AS RECALL FROM c)"""


@register(
    "threshold_curve",
    with_views(
        _CURVE + f" SELECT CAST(THRESHOLD AS DOUBLE) AS THRESHOLD, round(PRECISION, 6) AS PRECISION, round(RECALL, 6) AS RECALL, "
        f"round({_d('2 * PRECISION * RECALL', 'PRECISION + RECALL')}, 6) AS F1 FROM m",
        "v_scored_nan",
    ),
)
def threshold_curve(spark, sf):
    return rounded(metrics.threshold_curve(fx.scored_with_nan(spark, sf)))


@register(
    "best_threshold",
    with_views(
        _CURVE + f", f AS (SELECT CAST(THRESHOLD AS DOUBLE) AS THRESHOLD, round(PRECISION, 6) AS PRECISION, round(RECALL, 6) AS RECALL, "
        f"round({_d('2 * PRECISION * RECALL', 'PRECISION + RECALL')}, 6) AS F1 FROM m) SELECT * FROM f ORDER BY F1 DESC, THRESHOLD ASC LIMIT 1",
        "v_scored_nan",
    ),
)
def best_threshold(spark, sf):
    return metrics.best_threshold(rounded(metrics.threshold_curve(fx.scored_with_nan(spark, sf))))


_GROUPS = "g AS (SELECT SCORE, count(CASE WHEN LABEL = 1 THEN 1 END) AS POS, count(CASE WHEN LABEL <> 1 THEN 1 END) AS NEG FROM v_scored GROUP BY SCORE)"
_TOT = "tot AS (SELECT count(CASE WHEN LABEL = 1 THEN 1 END) AS P, count(CASE WHEN LABEL <> 1 THEN 1 END) AS N FROM v_scored)"
_CUM = (
    "cum AS (SELECT SCORE, POS, NEG, sum(POS) OVER (ORDER BY SCORE DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS CP, "
    "sum(NEG) OVER (ORDER BY SCORE DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS CN FROM g)"
)


@register(
    "roc_points",
    with_views(
        f"WITH {_GROUPS}, {_TOT}, {_CUM} SELECT round(SCORE, 6) AS THRESHOLD, round({_d('CN', 'N')}, 6) AS FPR, round({_d('CP', 'P')}, 6) AS TPR "
        "FROM cum, tot UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0",
        "v_scored",
    ),
)
def roc_points(spark, sf):
    return rounded(metrics.roc_points(_scored(spark, sf)))


@register(
    "pr_points",
    with_views(
        f"WITH {_GROUPS}, {_TOT}, {_CUM} SELECT round(SCORE, 6) AS THRESHOLD, round({_d('CP', 'CP + CN')}, 6) AS PRECISION, "
        f"round({_d('CP', 'P')}, 6) AS RECALL FROM cum, tot UNION ALL SELECT CAST('inf' AS DOUBLE), 1.0, 0.0",
        "v_scored",
    ),
)
def pr_points(spark, sf):
    return rounded(metrics.pr_points(_scored(spark, sf)))


@register(
    "average_precision",
    with_views(
        f"WITH {_GROUPS}, {_TOT}, {_CUM} SELECT round({_d('sum(POS * ' + _d('CP', 'CP + CN') + ')', 'max(P)')}, 6) AS AVERAGE_PRECISION FROM cum, tot",
        "v_scored",
    ),
)
def average_precision(spark, sf):
    return rounded(metrics.average_precision(_scored(spark, sf)))


@register(
    "auc_score",
    with_views(
        f"WITH {_GROUPS}, {_TOT}, c AS (SELECT SCORE, POS, NEG, COALESCE(sum(NEG) OVER (ORDER BY SCORE ASC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BELOW FROM g) "
        f"SELECT round({_d('sum(POS * (BELOW + NEG / 2.0))', 'max(P) * max(N)')}, 6) AS AUC FROM c, tot",
        "v_scored",
    ),
)
def auc_score(spark, sf):
    return rounded(metrics.auc_score(_scored(spark, sf)))


@register(
    "score_scatter",
    with_views(
        f"SELECT row_number() OVER (ORDER BY {sql_hash_order('ACCT_NBR', SEED)}, ACCT_NBR) AS ROW_IDX, round(SCORE, 6) AS SCORE, LABEL FROM v_scored",
        "v_scored",
    ),
)
def score_scatter(spark, sf):
    s = sampling.hash_ranked(_scored(spark, sf), "ACCT_NBR", SEED, name="ROW_IDX")
    return rounded(s.select("ROW_IDX", "SCORE", "LABEL"))


@register(
    "focal_loss",
    with_views(
        """WITH p AS (SELECT LABEL, least(greatest(SCORE, 1e-6), 1 - 1e-6) AS p1 FROM v_scored),
 l AS (SELECT LABEL, -ln(1 - p1) AS l0, -ln(p1) AS l1 FROM p),
 c AS (SELECT 0.9 * (CASE WHEN LABEL = 1 THEN 7.0 * l1 ELSE 1.0 * l0 END) + 0.1 * (1.0 * l0 + 7.0 * l1) / 2 AS ce FROM l)
SELECT round(avg(pow(1 - exp(-ce), 1.5) * ce), 6) AS FOCAL_LOSS FROM c""",
        "v_scored",
    ),
)
def focal_loss(spark, sf):
    return rounded(metrics.focal_loss(_scored(spark, sf)))


@register(
    "split_report",
    with_views(
        f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY LABEL ORDER BY {sql_hash_order('ACCT_NBR', SEED)}, ACCT_NBR) AS rn,
  count(*) OVER (PARTITION BY LABEL) AS nc FROM v_scored),
 s AS (SELECT CASE WHEN rn <= ceil(0.2 * nc) THEN 'test' ELSE 'train' END AS SPLIT, LABEL FROM r)
SELECT SPLIT, count(*) AS N, CAST(sum(LABEL) AS BIGINT) AS POSITIVES, round(avg(LABEL), 6) AS POS_SHARE FROM s GROUP BY SPLIT""",
        "v_scored",
    ),
)
def split_report(spark, sf):
    s = sampling.split_stratified(_scored(spark, sf))
    return rounded(
        s.groupBy("SPLIT").agg(
            F.count(F.lit(1)).alias("N"), F.sum("LABEL").cast("bigint").alias("POSITIVES"), F.avg("LABEL").alias("POS_SHARE")
        )
    )


# ------------------------------------------------------------------------------------------- L13 / L14
def _attr_input(spark, sf):
    from riskframe.plans.account_queries import _profile

    prof = _profile(spark, sf)
    s = fx.scored(spark, sf).select("ACCT_NBR", "LABEL")
    return materialize(prof.join(s, "ACCT_NBR"), "attribution-input")  # read by the fit, the means and the result


#: Boosting rounds of the model that the attribution queries train and explain.
ATTR_ROUNDS = 10
_ATTR_COLS = ["TX_COUNT", "TX_MEAN", "TX_STD", "AVG_PB_BAL", "UNIQUE_CHANNELS", "UNIQUE_TRN_CODES", "IS_WEEKEND", "AUM_AMT", "ACCOUNT_AGE", "AGE"]


def _attr_sql(final: str) -> str:
    from riskframe.plans.account_queries import unrounded_profile_sql

    body = unrounded_profile_sql()
    last = body.rfind("SELECT acc.ACCT_NBR")
    ctes, prof_sel = body[:last].rstrip(), body[last:]
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}, corr({c}, LABEL) AS r_{c}" for c in _ATTR_COLS)
    contrib = " UNION ALL ".join(
        f"SELECT d.ACCT_NBR, '{c}' AS FEATURE, CAST(d.{c} AS DOUBLE) AS VALUE, "
        f"CASE WHEN st.s_{c} = 0 OR st.r_{c} IS NULL OR isnan(st.r_{c}) THEN 0.0 ELSE st.r_{c} * (d.{c} - st.m_{c}) / st.s_{c} END AS CONTRIBUTION FROM d, st"
        for c in _ATTR_COLS
    )
    return (
        f"{ctes}, prof AS ({prof_sel}), d AS (SELECT prof.*, v.LABEL FROM prof JOIN v_scored v ON prof.ACCT_NBR = v.ACCT_NBR), "
        f"st AS (SELECT {stats} FROM d), ct AS ({contrib}), "
        "imp AS (SELECT FEATURE, avg(abs(CONTRIBUTION)) AS MEAN_ABS FROM ct GROUP BY FEATURE), "
        "top AS (SELECT * FROM imp ORDER BY MEAN_ABS DESC, FEATURE ASC LIMIT 5) " + final
    )


def _explained(spark, sf):
    """The attribution input with the raw prediction of a trained model and its attributions."""
    d = _attr_input(spark, sf)
    model = models.fit(models.with_class_weight(d), _ATTR_COLS, models.gbt({"maxIter": ATTR_ROUNDS}))
    fitted = tree_attribution.TreeAttribution.of(model, _ATTR_COLS, spark)
    return fitted, materialize(fitted.contributions(tree_attribution.raw_prediction(model, d)), "attributions")


def _whole(fitted) -> Column:
    """Base plus contributions are the model's raw prediction."""
    return tree_attribution.unexplained(fitted) <= 1e-9 * (F.lit(1.0) + F.abs("RAW"))


@register("attribution_summary", "SELECT CAST(r AS INT) AS RANK, TRUE AS ORDER_OK, (SELECT count(*) FROM orders) AS WHOLE_ROWS FROM range(1, 6) v(r)")
def attribution_summary(spark, sf):
    """The five features with the largest mean absolute Shapley value of a trained model. A learner's values have no
    SQL text; what is exact: the ranks, that means fall, and on how many rows contributions and base are the raw prediction
    (all accounts)."""
    fitted, rows = _explained(spark, sf)
    n = rows.where(_whole(fitted)).count()
    top = attribution.top_attributions(fitted.mean_abs(rows.select("ACCT_NBR", *_ATTR_COLS)), 5)
    over = Window.orderBy(F.col("MEAN_ABS").desc(), "FEATURE")  # five rows
    ordered = top.select(F.row_number().over(over).alias("RANK"), (F.coalesce(F.lag("MEAN_ABS").over(over), F.col("MEAN_ABS")) >= F.col("MEAN_ABS")).alias("ORDER_OK"))
    return ordered.withColumn("WHOLE_ROWS", F.lit(n).cast("bigint"))


@register(
    "attribution_dependence",
    with_views(
        _attr_sql("SELECT ACCT_NBR, FEATURE, round(VALUE, 6) AS VALUE, TRUE AS WHOLE FROM ct"),
        "v_accounts", "v_identity", "v_txn", "v_scored",
    ),
)
def attribution_dependence(spark, sf):
    """(value, contribution) pairs, here of all explained features; exact are the values, and that the contributions of an
    account's own pairs and base add up to the raw prediction."""
    fitted, rows = _explained(spark, sf)
    pairs = fitted.dependence(rows.select("ACCT_NBR", *_ATTR_COLS), len(_ATTR_COLS))
    return rounded(_pairs_whole(fitted, pairs, rows.select("ACCT_NBR", "RAW")).select("ACCT_NBR", "FEATURE", "VALUE", "WHOLE"))


def _pairs_whole(fitted, pairs, raw):
    """``pairs`` with WHOLE: the contributions of all the account's pairs are its raw predictions less the base. A pair meets
    each raw prediction of its account (more than one if the account repeats), each of these a pair for every feature."""
    all_of = lambda c: F.sum(c).over(Window.partitionBy("ACCT_NBR"))
    each = 1.0 / len(fitted.features)
    off = F.abs(all_of(F.col("CONTRIBUTION")) - all_of((F.col("RAW") - F.lit(fitted.base)) * each))
    return pairs.join(raw, "ACCT_NBR").withColumn("WHOLE", off <= 1e-9 * all_of((F.lit(1.0) + F.abs("RAW")) * each))


@register(
    "linear_attribution_summary",
    with_views(_attr_sql("SELECT FEATURE, round(MEAN_ABS, 6) AS MEAN_ABS FROM top"), "v_accounts", "v_identity", "v_txn", "v_scored"),
)
def linear_attribution_summary(spark, sf):
    d = _attr_input(spark, sf)
    lin = attribution.LinearAttribution.fit(d, _ATTR_COLS, "LABEL")
    return rounded(attribution.top_attributions(lin.mean_abs(d), 5))


@register(
    "linear_attribution_dependence",
    with_views(
        _attr_sql(
            "SELECT ct.ACCT_NBR, ct.FEATURE, round(ct.VALUE, 6) AS VALUE, round(ct.CONTRIBUTION, 6) AS CONTRIBUTION FROM ct JOIN top ON ct.FEATURE = top.FEATURE"
        ),
        "v_accounts", "v_identity", "v_txn", "v_scored",
    ),
)
def linear_attribution_dependence(spark, sf):
    d = _attr_input(spark, sf)
    lin = attribution.LinearAttribution.fit(d, _ATTR_COLS, "LABEL")
    return rounded(attribution.dependence(lin, d, 5))
