"""Registered queries: Spark ML training, search and scoring.

A learner's scores can't equal another learner's, so the SQL text of the model keys states what is exact -- which rows
come out, with which labels, in which split -- and that every probability lies in [0, 1] and every flag follows from it.
It checks invariants, not the quality of the learner; tests look at that on planted signals.

The library's defaults are the full budgets (1000 rounds, 100 in each fold, 50 trials of 100 to 500 rounds). Cross-validation
and early stopping run them. A fit of 1000 rounds of Spark's learner takes minutes even on the small test tables, so the other
queries pass ``ROUNDS`` and ``TRIALS`` instead; the data that they learn from is not cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.defaults import EARLY_FOLDS, EARLY_PATIENCE, GBT_PARAMS, N_FOLDS, SEED, TUNE_SPACE
from riskframe.functions.hashing import sql_hash_order
from riskframe.operators import clean, features, joins, models, sampling, scoring
from riskframe.plans import oracle_sql as osql
from riskframe.plans.common import rounded
from riskframe.plans.registry import register
from riskframe.plans.sample_queries import _LAB, _LAB_VIEWS
from riskframe.session import materialize, scratch_path
from riskframe.sources import fixtures as fx
from riskframe.sources.fixtures import FIXTURE_CUTS, FIXTURE_TODAY, with_views

KEY = "ACCT_NBR"
#: Boosting rounds and search trials of these queries (the library's defaults: GBT_PARAMS, CV_ROUNDS, TUNE_TRIALS).
ROUNDS, TRIALS = 10, 5
#: Depth of the forests of these queries (the library's default is FOREST_DEPTH).
FOREST_CUT = 8
#: Transactions whose accounts are made features at a time: their shuffle files go before the next ones are written.
LOT_ROWS = 1 << 26
_BANDS = list(features.BAND_COUNT_COLS + features.BAND_RATIO_COLS)
_MARKS = [KEY, "LABEL", "SPLIT", "FOLD", "WAY"]


def _ml_table(spark: SparkSession, sf: str, mark: str = "SPLIT", keep: bool = True) -> tuple[DataFrame, list[str]]:
    """Labelled feature table with flags for missing bands, and beside it, from the narrow (key, label) rows, the
    stratified split (SPLIT), with it the fold (FOLD, FOLD3: of three), or the three-way split (WAY): joined once, written once
    (not if ``keep`` is false: for a table that is read once). With very many transactions the accounts go by lots."""
    lab = joins.label_accounts(fx.accounts(spark, sf).select(KEY), fx.notices(spark, sf))
    lab = materialize(lab, "labels")
    marks = sampling.split_three_way(lab, name="WAY") if mark == "WAY" else sampling.split_stratified(lab)
    if mark.startswith("FOLD"):
        marks = marks.join(sampling.stratified_folds(lab, k=int(mark[4:] or N_FOLDS)).drop("LABEL"), KEY)
    acc, txn = fx.accounts(spark, sf), fx.transactions(spark, sf)
    fitted = features.fit_txn_policy(txn, features.txn_policy(FIXTURE_TODAY))
    lots = max(1, -(-txn.count() // LOT_ROWS))

    def lot(i: int) -> DataFrame:
        of = lambda df: df.where(F.pmod(F.xxhash64(KEY), F.lit(lots)) == i) if lots > 1 else df
        ft = features.feature_table(of(acc), fx.identity(spark, sf), of(txn), today=FIXTURE_TODAY, txn_fitted=fitted, cuts=FIXTURE_CUTS)
        return models.impute_with_flags(ft, _BANDS).join(marks, KEY)

    ml = materialize(lot(0), "ml-table", *[lot(i) for i in range(1, lots)]) if keep or lots > 1 else lot(0)
    return ml, models.feature_columns(ml, exclude=_MARKS)


def _gbt_model(ml: DataFrame, feats: list[str]):
    return models.fit(models.with_class_weight(ml.where("SPLIT = 'train'")), feats, models.gbt({"maxIter": ROUNDS}))


def _checked(scored: DataFrame, *keep: str, threshold: float = 0.5) -> DataFrame:
    """The scored rows with the two flags that stand for exact values."""
    p = F.col("PROBABILITY")
    return scored.select(KEY, *keep, p.between(0, 1).alias("P_OK"), (F.col("PREDICTION") == (p > threshold).cast("int")).alias("PRED_OK"))


_SPLIT = _LAB + ", sp AS (SELECT ACCT_NBR, LABEL, CASE WHEN rn <= ceil(0.2 * nc) THEN 'test' ELSE 'train' END AS SPLIT FROM r) "
_TEST_ROWS = with_views(_SPLIT + "SELECT ACCT_NBR, LABEL, TRUE AS P_OK, TRUE AS PRED_OK FROM sp WHERE SPLIT = 'test'", *_LAB_VIEWS)


# ------------------------------------------------------------------------------------------- K1 (exact)
_K1_COLS = ["TX_COUNT", "TX_MEAN", "TX_STD", "AVG_PB_BAL", "UNIQUE_CHANNELS", "AUM_AMT", "AGE"]


def _k1_sql() -> str:
    from riskframe.plans.account_queries import unrounded_profile_sql

    body = unrounded_profile_sql()
    last = body.rfind("SELECT acc.ACCT_NBR")
    ctes, prof = body[:last].rstrip(), body[last:]
    h = sql_hash_order("ACCT_NBR", SEED)
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _K1_COLS)
    z = ", ".join(f"round((p.{c} - st.m_{c}) / CASE WHEN st.s_{c} = 0 THEN 1.0 ELSE st.s_{c} END, 6) AS {c}" for c in _K1_COLS)
    return (
        f"{ctes}, prof AS ({prof}), r AS (SELECT ACCT_NBR, row_number() OVER (ORDER BY {h}, ACCT_NBR) AS rn, count(*) OVER () AS n FROM prof), "
        "sp AS (SELECT ACCT_NBR, CASE WHEN rn <= ceil(0.2 * n) THEN 'test' ELSE 'train' END AS SPLIT FROM r), "
        "p AS (SELECT prof.*, sp.SPLIT FROM prof JOIN sp ON prof.ACCT_NBR = sp.ACCT_NBR), "
        f"st AS (SELECT {stats} FROM p WHERE SPLIT = 'train') SELECT p.ACCT_NBR, p.SPLIT, {z} FROM p, st"
    )


@register("standard_scale", with_views(_k1_sql(), "v_accounts", "v_identity", "v_txn"))
def standard_scale(spark, sf):
    """K1: population mean/std fitted on the training split, applied to every row. The profile is written once."""
    from riskframe.plans.account_queries import _profile

    prof = sampling.split_random(materialize(_profile(spark, sf).select(KEY, *_K1_COLS), "profile"))
    scaler = models.StandardScale.fit(prof.where("SPLIT = 'train'"), _K1_COLS)
    return rounded(scaler.transform(prof).select(KEY, "SPLIT", *_K1_COLS))


# ------------------------------------------------------------------------------------------- K11 (exact)
def _assemble_sql() -> str:
    names = osql.ACCOUNT_COLS[1:] + osql.agg_columns()[1:] + osql.slot_columns()
    values = [f"printf('%.6f', CAST(COALESCE({n}, 0) AS DOUBLE))" for n in names] + [f"CASE WHEN {n} IS NULL THEN '1.000000' ELSE '0.000000' END" for n in _BANDS]
    return f"WITH {osql.feature_ctes()}, f AS ({osql.features_select()}) SELECT ACCT_NBR, LABEL, concat_ws(',', {', '.join(values)}) AS FEATURES FROM f"


def _six_places(x):
    """``format_string("%.6f", x)`` without its formatter for zero, whole numbers and numbers of ordinary size: the decimal
    type rounds like it, half up on the shortest digits."""
    whole, size = x.try_cast("bigint"), F.abs(x)
    zero = F.when(x.cast("string") == "-0.0", F.lit("-0.000000")).otherwise(F.lit("0.000000"))
    text = F.when(x == 0, zero).when((size < 1e15) & (x == whole.cast("double")), F.concat(whole.cast("string"), F.lit(".000000")))
    text = text.when((size >= 1e-3) & (size < 1e11), x.try_cast("decimal(18,6)").cast("string"))
    return text.otherwise(F.format_string("%.6f", x))


@register("assemble_features", with_views(_assemble_sql(), "v_accounts", "v_identity", "v_txn", "v_notices"))
def assemble_features(spark, sf):
    """Feature table -> vector in feature-list order, shown as text with six places."""
    from pyspark.ml.functions import vector_to_array

    ml, feats = _ml_table(spark, sf, keep=False)
    v = models.assembler(feats).transform(ml).select(KEY, "LABEL", vector_to_array("features").alias("f"))
    return v.select(KEY, "LABEL", F.array_join(F.transform("f", _six_places), ",").alias("FEATURES"))


# ------------------------------------------------------------------------------------------- K: models (invariants)
@register("train_gbt", _TEST_ROWS)
def train_gbt(spark, sf):
    """K2: boosted trees on the training split (class-weighted), test split scored."""
    ml, feats = _ml_table(spark, sf)
    return _checked(models.score(_gbt_model(ml, feats), ml.where("SPLIT = 'test'"), KEY, keep=["LABEL"]), "LABEL")


#: The chosen round, recomputed from the curves: the lowest mean before ``patience`` rounds in a row bring no gain.
CHOSEN_SQL = """
WITH m AS (SELECT ROUND AS r, avg(LOSS) AS l FROM {curves} GROUP BY ROUND),
 b AS (SELECT r, l, min(l) OVER (ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lowest FROM m),
 g AS (SELECT r, l, max(CASE WHEN lowest IS NULL OR l < lowest THEN r END) OVER (ORDER BY r ROWS UNBOUNDED PRECEDING) AS gained FROM b),
 s AS (SELECT coalesce(min(r), 2147483647) AS stop FROM g WHERE r - gained >= {patience})
SELECT CAST(max(gained) AS INT) AS chosen FROM g, s WHERE r <= stop
"""


@register("train_gbt_early_stop", with_views(
    _SPLIT + "SELECT ACCT_NBR, LABEL, TRUE AS P_OK, TRUE AS PRED_OK, TRUE AS ROUNDS_OK FROM sp WHERE SPLIT = 'test'", *_LAB_VIEWS))
def train_gbt_early_stop(spark, sf):
    """K3: the mean curve of three folds chooses the number of rounds (of all that ``GBT_PARAMS`` allows), one model on all
    training rows. ROUNDS_OK: the model's rounds are what SQL finds in the curves, which cover every fold and round."""
    ml, feats = _ml_table(spark, sf, "FOLD3")
    m, curves = models.fit_early_stop(ml.where("SPLIT = 'train'"), feats)
    n = spark.sql(CHOSEN_SQL.format(curves="{curves}", patience=EARLY_PATIENCE), curves=curves).first().chosen
    folds, rounds, rows = curves.agg(F.count_distinct("FOLD"), F.max("ROUND"), F.count(F.lit(1))).first()
    s = _checked(models.score(m, ml.where("SPLIT = 'test'"), KEY, keep=["LABEL"]), "LABEL")
    return s.withColumn("ROUNDS_OK", F.lit(1 <= n <= GBT_PARAMS["maxIter"] and m.stages[-1].getNumTrees == n and folds == EARLY_FOLDS and rows == folds * rounds))


@register("train_forest_account", _TEST_ROWS)
def train_forest_account(spark, sf):
    """K4: 100-tree forest on the account table; test split scored."""
    ml, feats = _ml_table(spark, sf)
    m = models.fit(ml.where("SPLIT = 'train'"), feats, models.forest(100, FOREST_CUT))
    return _checked(models.score(m, ml.where("SPLIT = 'test'"), KEY, keep=["LABEL"]), "LABEL")


@register("train_forest_txn", with_views(
    f"WITH acc AS ({osql.account_cte()}), tx AS ({osql.txn_cte()}), lab AS (SELECT DISTINCT ACCT_NBR FROM v_notices WHERE ACCT_NBR IS NOT NULL), "
    "la AS (SELECT k.ACCT_NBR, CASE WHEN lab.ACCT_NBR IS NULL THEN 0 ELSE 1 END AS LABEL FROM (SELECT DISTINCT ACCT_NBR FROM tx) k "
    "LEFT JOIN lab ON k.ACCT_NBR = lab.ACCT_NBR), "
    f"r AS (SELECT *, row_number() OVER (PARTITION BY LABEL ORDER BY {sql_hash_order('ACCT_NBR', SEED)}, ACCT_NBR) AS rn, "
    "count(*) OVER (PARTITION BY LABEL) AS nc FROM la) SELECT ACCT_NBR, LABEL AS VOTE_TRUTH, TRUE AS VOTE_OK FROM r WHERE rn <= ceil(0.2 * nc)",
    "v_accounts", "v_identity", "v_txn", "v_notices"))
def train_forest_txn(spark, sf):
    """K5: forest on transactions (account attributes joined on, written once with their split), then per-account votes of
    truth and prediction (D9)."""
    from riskframe.plans.account_queries import _acc

    lab, known, txn = joins.label_accounts(_acc(spark, sf), fx.notices(spark, sf)), fx.accounts(spark, sf).select(KEY), fx.transactions(spark, sf)
    # The accounts of the transactions as C6 gives them: known ones, each label once. The wide rows are written once, with the split.
    seen = joins.txn_with_account(joins.restrict_to_known(txn.select(KEY).distinct(), known), lab.select(KEY, "LABEL"))
    split = sampling.split_stratified(materialize(seen.where(F.col(KEY).isNotNull()).distinct(), "labels"))
    tx = features.transaction_table(txn, known, features.txn_policy(FIXTURE_TODAY), by_key=not clean.hot_keys(txn, KEY))
    rows = materialize(joins.txn_with_account(tx, lab).join(split.select(KEY, "SPLIT"), KEY), "ml-transactions")
    feats = models.feature_columns(rows, exclude=[KEY, "LABEL", "SPLIT"])
    m = models.fit(rows.where("SPLIT = 'train'"), feats, models.forest(100, FOREST_CUT))
    s = materialize(models.score(m, rows.where("SPLIT = 'test'"), KEY, keep=["LABEL"]), "ml-scored")
    accounts = s.select(KEY).distinct()
    truth = scoring.vote_by_account(s.select(KEY, F.col("LABEL").alias("PRED")), accounts, name="VOTE_TRUTH")
    pred = scoring.vote_by_account(s.select(KEY, F.col("PREDICTION").alias("PRED")), accounts, name="VOTE_PRED")
    return truth.join(pred, KEY).select(KEY, "VOTE_TRUTH", F.col("VOTE_PRED").isin(0, 1).alias("VOTE_OK"))


def _rate(c: str):
    return F.col(c).between(0, 1)


_CV_SQL = (
    _LAB + ", f AS (SELECT ACCT_NBR, LABEL, CAST((rn - 1) % 5 AS INT) AS FOLD FROM r), "
    "c AS (SELECT FOLD, count(*) AS ROWS, count(CASE WHEN LABEL = 1 THEN 1 END) AS POSITIVES FROM f GROUP BY FOLD), "
    "t AS (SELECT sum(ROWS) AS n, sum(POSITIVES) AS p FROM c), "
    "w AS (SELECT FOLD, ROWS, POSITIVES, ((n - ROWS) - (p - POSITIVES)) / CAST(p - POSITIVES AS DOUBLE) AS WEIGHT FROM c, t) "
    "SELECT FOLD, ROWS, POSITIVES, round(WEIGHT, 6) AS WEIGHT, TRUE AS METRICS_OK FROM w "
    "UNION ALL SELECT -1, CAST(sum(ROWS) AS BIGINT), CAST(sum(POSITIVES) AS BIGINT), round(avg(WEIGHT), 6), TRUE FROM w"
)
#: All folds' metrics from the out-of-fold table, as a plain query.
FOLDS_SQL = """
WITH c AS (SELECT FOLD, count(*) AS n, sum(LABEL) AS pos, sum(CASE WHEN PROBABILITY > 0.5 THEN 1 ELSE 0 END) AS pp,
   sum(CASE WHEN PROBABILITY > 0.5 AND LABEL = 1 THEN 1 ELSE 0 END) AS tp FROM {rows} GROUP BY FOLD),
 m AS (SELECT FOLD, coalesce(CAST(tp AS DOUBLE) / nullif(pp, 0), 0.0) AS p, coalesce(CAST(tp AS DOUBLE) / nullif(pos, 0), 0.0) AS r FROM c),
 f AS (SELECT FOLD, p, r, coalesce(2 * p * r / nullif(p + r, 0.0), 0.0) AS f FROM m)
SELECT FOLD, p, r, f FROM f UNION ALL SELECT -1, avg(p), avg(r), avg(f) FROM f
"""


@register("cross_validate", with_views(_CV_SQL, *_LAB_VIEWS))
def cross_validate(spark, sf):
    """K6: 5 stratified folds; each fold's rows, positives and class weight (from the other folds), and whether precision,
    recall and F1 at 0.5 and their means (FOLD -1) are what SQL finds in the out-of-fold table, which holds every row once.
    All ``CV_ROUNDS`` rounds of every fold."""
    ml, feats = _ml_table(spark, sf, "FOLD")
    rows = models.out_of_fold(ml, feats)
    cv = models.fold_metrics(rows)
    again = spark.sql(FOLDS_SQL, rows=rows).withColumnRenamed("FOLD", "AGAIN")
    j = cv.join(again, F.col("FOLD") == F.col("AGAIN"))
    same = [F.abs(F.col(a) - F.col(b)) < 1e-12 for a, b in (("PRECISION", "p"), ("RECALL", "r"), ("F1", "f"))]
    once = rows.select(KEY).distinct().count() == rows.count()
    return rounded(j.select("FOLD", "ROWS", "POSITIVES", "WEIGHT", (same[0] & same[1] & same[2] & _rate("F1") & F.lit(once)).alias("METRICS_OK")))


#: The full space but for the rounds, which are bounded by ``ROUNDS`` here.
_SPACE = {**TUNE_SPACE, "maxIter": (5, ROUNDS)}
#: Who goes on from a rung, from the trials' objectives alone.
GOES_ON_SQL = """
WITH n AS (SELECT RUNG, count(*) AS trials FROM {trials} GROUP BY RUNG),
 a AS (SELECT n.RUNG, coalesce(m.trials, 1) AS after FROM n LEFT JOIN n m ON m.RUNG = n.RUNG + 1)
SELECT t.TRIAL, t.RUNG, row_number() OVER (PARTITION BY t.RUNG ORDER BY t.OBJECTIVE DESC, t.TRIAL) <= a.after AS AGAIN
FROM {trials} t JOIN a ON a.RUNG = t.RUNG
"""


@register("tune", f"SELECT CAST(t AS INT) AS TRIAL, TRUE AS PARAMS_OK, TRUE AS OBJECTIVE_OK, TRUE AS RUNGS_OK FROM range({TRIALS}) v(t)")
def tune(spark, sf):
    """K7: seeded search over step size, row and column sampling, depth and rounds in rungs; validation F1 as objective.
    RUNGS_OK: who goes on, and who has a row on the next rung, is what SQL finds in the objectives.
    Cut: ``TRIALS`` trials, 5 to ``ROUNDS`` rounds."""
    ml, feats = _ml_table(spark, sf, "WAY")
    maps = models.random_param_maps(TRIALS, _SPACE)
    got = models.tune(ml.where("WAY = 'train'"), ml.where("WAY = 'validation'"), feats, maps, parallelism=2)
    inside = F.lit(True)
    for name, (lo, hi) in _SPACE.items():
        inside = inside & F.get_json_object("PARAMS", f"$.{name}").cast("double").between(lo, hi)
    again = spark.sql(GOES_ON_SQL, trials=got)
    last = got.groupBy("TRIAL").agg(F.max("RUNG").alias("LAST"))
    rungs = got.join(again, ["TRIAL", "RUNG"]).join(last, "TRIAL")
    reached = (F.col("LAST") > F.col("RUNG")) | (F.col("RUNG") == F.lit(len(models.rungs_of(maps)) - 1))
    return rungs.groupBy("TRIAL").agg(
        F.bool_and(inside).alias("PARAMS_OK"),
        F.bool_and(_rate("OBJECTIVE")).alias("OBJECTIVE_OK"),
        F.bool_and((F.col("GOES_ON") == F.col("AGAIN")) & (~F.col("GOES_ON") | reached)).alias("RUNGS_OK"),
    )


_TRIALS_SQL = (
    "SELECT o_custkey AS TRIAL, CASE WHEN o_custkey % 9 = 0 THEN CAST('-inf' AS DOUBLE) "
    "ELSE CAST(count(*) % 7 AS DOUBLE) / 10 END AS OBJECTIVE FROM orders GROUP BY o_custkey"
)


@register("rank_trials", f"WITH t AS ({_TRIALS_SQL}) SELECT TRIAL, OBJECTIVE, row_number() OVER (ORDER BY OBJECTIVE DESC, TRIAL) AS RANK "
          "FROM t WHERE OBJECTIVE > CAST('-inf' AS DOUBLE)")
def rank_trials(spark, sf):
    """G4 (+B10): finite trials by objective, highest first, ties by trial number; objectives from the orders, many equal."""
    from riskframe.operators.ordering import row_index

    o = fx.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("TRIAL")).agg(F.count(F.lit(1)).alias("n"))
    t = o.select("TRIAL", F.when(F.col("TRIAL") % 9 == 0, F.lit(float("-inf"))).otherwise((F.col("n") % 7).cast("double") / 10).alias("OBJECTIVE"))
    t = clean.filter_known(t, "OBJECTIVE")
    return row_index(scoring.rank_trials(t), [F.col("OBJECTIVE").desc_nulls_last(), F.col("TRIAL").asc()], name="RANK")


@register("predict_accounts", with_views(_SPLIT + "SELECT ACCT_NBR AS account_id, TRUE AS P_OK, TRUE AS PRED_OK, TRUE AS LEVEL_OK FROM sp", *_LAB_VIEWS))
def predict_accounts(spark, sf):
    """K8: every account -> align -> scale with the training scaler -> score -> threshold 0.5 -> risk level."""
    ml, feats = _ml_table(spark, sf)
    scaler = models.StandardScale.fit(ml.where("SPLIT = 'train'"), feats)
    m = _gbt_model(scaler.transform(ml), feats)
    out = models.predict_accounts(m, ml, feats, scaler)
    p = F.col("fraud_probability")
    level = F.when(p > 0.6, "High").when(p > 0.3, "Medium").when(p > 0, "Low")
    flag = F.col("fraud_prediction") == (p > 0.5).cast("int")
    return out.select("account_id", p.between(0, 1).alias("P_OK"), flag.alias("PRED_OK"), F.col("risk_level").eqNullSafe(level).alias("LEVEL_OK"))


@register("predict_to_sheet", with_views("SELECT ACCT_NBR, TRUE AS Y_OK FROM v_sheet", "v_sheet"))
def predict_to_sheet(spark, sf):
    """K9: score with threshold 0.6 and fill the answer sheet (every account, repeats, unknown accounts stay empty)."""
    from riskframe.sources import files

    ml, feats = _ml_table(spark, sf)
    pred = models.predict_accounts(_gbt_model(ml, feats), ml, feats, threshold=0.6)
    filled = files.fill_answer_sheet(fx.answer_sheet(spark, sf), pred.select(F.col("account_id").alias(KEY), F.col("fraud_prediction").alias("PRED")))
    ok = F.when(F.col(KEY) < 0, F.col("Y") == "").otherwise(F.col("Y").isin("", "1"))
    return filled.select(KEY, ok.alias("Y_OK"))


def _names_sql() -> str:
    names = osql.ACCOUNT_COLS[1:] + osql.agg_columns()[1:] + osql.slot_columns() + [f"{n}_missing" for n in _BANDS]
    return f"SELECT FEATURE, TRUE AS IMPORTANCE_OK FROM (VALUES {', '.join(f'({n!r})' for n in names)}) v(FEATURE)"


@register("feature_importance", _names_sql())
def feature_importance(spark, sf):
    """Importance of every feature: each in [0, 1], together 1."""
    ml, feats = _ml_table(spark, sf)
    imp = models.feature_importance(spark, _gbt_model(ml, feats), feats)
    total = imp.agg(F.sum("IMPORTANCE")).first()[0]
    return imp.select("FEATURE", (_rate("IMPORTANCE") & F.lit(abs(total - 1) < 1e-6)).alias("IMPORTANCE_OK"))


@register("top_features", "SELECT FEATURE, IMPORTANCE FROM (SELECT 'p_' || p_partkey AS FEATURE, CAST(p_size AS DOUBLE) / 100 AS IMPORTANCE FROM part) p "
          "ORDER BY IMPORTANCE DESC, FEATURE LIMIT 10")
def top_features(spark, sf):
    """The ten most important features; importances from the part sizes, many equal."""
    p = fx.table(spark, sf, "part")
    imp = p.select(F.concat(F.lit("p_"), F.col("p_partkey").cast("string")).alias("FEATURE"), (F.col("p_size").cast("double") / 100).alias("IMPORTANCE"))
    return scoring.top_k(imp, "IMPORTANCE", 10, "FEATURE")


@register("model_save_load", with_views(_SPLIT + "SELECT ACCT_NBR, TRUE AS P_OK, TRUE AS EQUAL FROM sp WHERE SPLIT = 'test'", *_LAB_VIEWS))
def model_save_load(spark, sf):
    """Save, reload, and score the test split with both; the two probabilities must be equal."""
    ml, feats = _ml_table(spark, sf)
    m = _gbt_model(ml, feats)
    loaded = models.save_load(m, scratch_path(spark, "model"))
    test = ml.where("SPLIT = 'test'")
    a = models.score(m, test, KEY).select(KEY, F.col("PROBABILITY").alias("p"))
    b = models.score(loaded, test, KEY).select(KEY, F.col("PROBABILITY").alias("q"))
    return a.join(b, KEY).select(KEY, F.col("p").between(0, 1).alias("P_OK"), (F.col("p") == F.col("q")).alias("EQUAL"))
