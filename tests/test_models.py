"""Invariants for model keys (no SQL oracle): probabilities, folds, save/load, planted signal."""

import duckdb
import pytest
from pyspark.sql import functions as F

from riskframe.operators import metrics, models
from riskframe.plans.model_queries import CHOSEN_SQL, GOES_ON_SQL

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def planted(spark):
    # label fully determined by x1 > 0.5: a tree model must find it
    df = spark.range(2000).select(
        F.col("id").alias("ACCT_NBR"), (F.abs(F.hash("id")) % 1000 / 1000.0).alias("x1"), (F.abs(F.hash(F.col("id") + 7)) % 1000 / 1000.0).alias("x2")
    ).withColumn("LABEL", (F.col("x1") > 0.5).cast("int"))
    return models.with_class_weight(df)


def test_planted_signal_auc(spark, planted):
    m = models.fit(planted, ["x1", "x2"], models.gbt({"maxIter": 5}))
    s = models.score(m, planted, keep=["LABEL"])
    lo, hi = s.agg(F.min("PROBABILITY"), F.max("PROBABILITY")).first()
    assert 0.0 <= lo <= hi <= 1.0
    auc = metrics.auc_score(s.select(F.col("PROBABILITY").alias("SCORE"), "LABEL")).first().AUC
    assert auc > 0.9


def test_save_load_same_scores(spark, planted, tmp_path):
    m = models.fit(planted, ["x1", "x2"], models.forest(10))
    m2 = models.save_load(m, str(tmp_path / "m"))
    a = models.score(m, planted).select("ACCT_NBR", F.col("PROBABILITY").alias("a"))
    b = models.score(m2, planted).select("ACCT_NBR", F.col("PROBABILITY").alias("b"))
    assert a.join(b, "ACCT_NBR").where("a <> b").count() == 0


def test_folds_choose_the_rounds_and_all_rows_train(spark, planted):
    """Noisy labels: the mean curve turns, its lowest point before three rounds without gain is taken, also by SQL."""
    noisy = planted.withColumns({"LABEL": F.when(F.pmod(F.hash("ACCT_NBR"), F.lit(7)) == 0, 1 - F.col("LABEL")).otherwise(F.col("LABEL")), "FOLD": F.pmod(F.hash(F.col("ACCT_NBR") + 1), F.lit(3))})
    params = {"maxIter": 12, "stepSize": 0.9, "maxDepth": 5}
    m, curves = models.fit_early_stop(noisy, ["x1", "x2"], params=params, start=3)
    rows = curves.collect()
    mean = {}
    for r in rows:
        mean.setdefault(r.ROUND, []).append(r.LOSS)
    mean = [sum(mean[i]) / 3 for i in sorted(mean)]
    best = 0
    for i, v in enumerate(mean):
        if v < mean[best]:
            best = i
        elif i - best >= 3:
            break
    n = m.stages[-1].getNumTrees
    assert n == best + 1 == models.chosen_round(curves)[0] and n < 12
    con = duckdb.connect()
    con.register("curves", curves.toPandas())
    assert con.execute(CHOSEN_SQL.format(curves="curves", patience=3)).fetchone()[0] == n
    # a longer run begins with the same rounds
    whole = models.validation_curves(noisy, ["x1", "x2"], params=params).where(F.col("ROUND") <= len(mean)).groupBy("ROUND").agg(F.avg("LOSS").alias("l")).orderBy("ROUND").collect()
    assert [r.l for r in whole] == pytest.approx(mean, rel=1e-9)


def test_a_curve_without_a_turn_takes_its_last_gain(spark):
    curves = spark.createDataFrame([(f, r, 1.0 / r if r < 4 else 0.4) for f in (0, 1) for r in range(1, 6)], "FOLD int, ROUND int, LOSS double")
    assert models.chosen_round(curves) == (3, False) and models.chosen_round(curves, 2) == (3, True)
    assert spark.sql(CHOSEN_SQL.format(curves="{curves}", patience=3), curves=curves).first().chosen == 3


def test_out_of_fold_table_gives_all_metrics(spark, planted):
    df = planted.withColumn("FOLD", (F.col("ACCT_NBR") % 3).cast("int"))
    rows = models.out_of_fold(df, ["x1", "x2"], k=3, params={"maxIter": 2})
    assert rows.count() == 2000 == rows.select("ACCT_NBR").distinct().count()
    got = {r.FOLD: r for r in models.fold_metrics(rows).collect()}
    data = rows.collect()
    for i in range(3):
        part = [r for r in data if r.FOLD == i]
        tp, pp, pos = sum(r.LABEL and r.PROBABILITY > 0.5 for r in part), sum(r.PROBABILITY > 0.5 for r in part), sum(r.LABEL for r in part)
        assert (got[i].ROWS, got[i].POSITIVES) == (len(part), pos)
        assert (got[i].PRECISION, got[i].RECALL) == pytest.approx((tp / pp, tp / pos)) and got[i].F1 > 0.9
        rest = [r for r in data if r.FOLD != i]
        assert got[i].WEIGHT == pytest.approx(sum(1 - r.LABEL for r in rest) / sum(r.LABEL for r in rest))
    assert got[-1].F1 == pytest.approx(sum(got[i].F1 for i in range(3)) / 3) and got[-1].ROWS == 2000


def test_search_draws_from_the_full_space():
    from riskframe.defaults import TUNE_SPACE, TUNE_TRIALS

    maps = models.random_param_maps()
    assert len(maps) == TUNE_TRIALS
    for m in maps:
        assert set(m) == set(TUNE_SPACE) and isinstance(m["maxDepth"], int) and isinstance(m["featureSubsetStrategy"], str)
        assert all(lo <= float(m[k]) <= hi for k, (lo, hi) in TUNE_SPACE.items())


def test_rungs_halve_the_trials_up_to_the_full_rounds():
    plan = models.rungs_of([{}] * 50)
    assert [n for n, _ in plan] == [50, 13, 4] and [p for _, p in plan] == [1 / 16, 1 / 4, 1]
    assert models.rungs_of([{}] * 3) == [(3, 1)] and models.rungs_of([{}]) == [(1, 1)]


def test_search_in_rungs(spark, planted):
    """Nine settings, most of them too weak to learn; who goes on follows from the objectives, also by SQL."""
    maps = [{"maxIter": 4, "stepSize": 0.5, "maxDepth": d, "subsamplingRate": 1.0} for d in (1, 1, 2, 3, 1, 1, 2, 1, 3)]
    noisy = planted.withColumn("LABEL", ((F.col("x1") > 0.5) & (F.col("x2") > 0.4)).cast("int"))
    train, valid = noisy.where("ACCT_NBR % 4 <> 0"), noisy.where("ACCT_NBR % 4 = 0")
    got = models.tune(train, valid, ["x1", "x2"], maps, parallelism=2, keep=3)
    rows = got.collect()
    assert [(r.RUNG, r.TRIAL) for r in rows if r.RUNG == 0] == [(0, i) for i in range(9)]
    by_rung = {k: [r for r in rows if r.RUNG == k] for k in range(2)}
    assert [len(v) for v in by_rung.values()] == [9, 3] and {r.ROUNDS for r in by_rung[0]} == {1} and {r.ROUNDS for r in by_rung[1]} == {4}
    assert {r.TRIAL for r in by_rung[0] if r.GOES_ON} == {r.TRIAL for r in by_rung[1]} <= {2, 3, 6, 8}
    assert sum(r.GOES_ON for r in by_rung[1]) == 1
    con = duckdb.connect()
    con.register("trials", got.toPandas())
    again = {(t, k): on for t, k, on in con.execute(GOES_ON_SQL.format(trials="trials")).fetchall()}
    assert all(again[r.TRIAL, r.RUNG] == r.GOES_ON for r in rows)


def test_training_rows_are_spread_by_their_number(spark, monkeypatch):
    """A learner's partitions hold a bounded number of values, however few files the rows come from."""
    monkeypatch.setattr(models, "PART_VALUES", 100)
    df = spark.range(1000, numPartitions=1).select((F.col("id") % 2).cast("int").alias("LABEL"), F.col("id").cast("double").alias("x"))
    assert models.spread(df, 5).rdd.getNumPartitions() == 50
    monkeypatch.setattr(models, "PART_VALUES", 10**6)
    assert models.spread(df, 5).rdd.getNumPartitions() == 1  # a few rows stay as they are
    seen = []
    monkeypatch.setattr(models, "spread", lambda train, width: seen.append(width) or train)
    models.fit(df, ["x"], models.forest(3, 2))
    assert seen == [4]


def test_six_places_are_the_formatters(spark):
    """The text of assemble_features: as format_string gives it, on odd values and on ties too; whole numbers and numbers of
    ordinary size don't go through it."""
    from riskframe.plans.model_queries import _six_places

    odd = [0.0, -0.0, 1.0, -7.0, 0.5, 1e-7, -1e-7, 5e-7, -4.9e-7, 1.0000005, -2.0000015, 0.0009999995, 99999999999.5, 1e11, 1e14 + 0.5, 1e15, 1e300, float("inf"), float("-inf"), float("nan")]
    d = spark.createDataFrame([(x,) for x in odd], "x double").union(spark.range(2000).select(F.rand(3) * 1e5 - (F.col("id") % 32) / 64))
    got = d.select("x", _six_places(F.col("x")).alias("a"), F.format_string("%.6f", "x").alias("b"))
    assert got.where(~F.col("a").eqNullSafe(F.col("b"))).collect() == []


def _made(monkeypatch, planted, folds):
    """The model queries on the planted rows; what they fit is kept by its number of rounds."""
    from riskframe.plans import model_queries

    ml = planted.withColumns({"FOLD": F.pmod(F.hash(F.col("ACCT_NBR") + 1), F.lit(folds)), "SPLIT": F.when(F.col("ACCT_NBR") % 5 == 0, "test").otherwise("train")})
    monkeypatch.setattr(model_queries, "_ml_table", lambda *a: (ml, ["x1", "x2"]))
    rounds, fit = [], models.fit
    return model_queries, rounds, lambda train, feats, learner: rounds.append(learner.getMaxIter()) or fit(train, feats, learner)


def test_cross_validate_query_fits_every_round_of_every_fold(spark, planted, monkeypatch):
    from riskframe.defaults import CV_ROUNDS, N_FOLDS

    queries, rounds, kept = _made(monkeypatch, planted, N_FOLDS)
    monkeypatch.setattr(models, "fit", lambda train, feats, learner: kept(train, feats, learner.copy({learner.maxDepth: 1})))
    rows = queries.cross_validate(spark, "").collect()
    assert rounds == [CV_ROUNDS] * N_FOLDS and sorted(r.FOLD for r in rows) == [-1, *range(N_FOLDS)] and all(r.METRICS_OK for r in rows)


def test_early_stop_query_is_ended_by_the_curve_alone(spark, planted, monkeypatch):
    """The folds' curve turns at round 20: the query reaches it, whatever number of rounds it begins with."""
    queries, rounds, kept = _made(monkeypatch, planted, 3)
    monkeypatch.setattr(models, "fit", kept)
    curve = lambda most: [(f, r, abs(r - 20) + 1.0) for f in range(3) for r in range(1, most + 1)]
    monkeypatch.setattr(models, "validation_curves", lambda df, feats, label, fold, k, params: spark.createDataFrame(curve(params["maxIter"]), "FOLD int, ROUND int, LOSS double"))
    rows = queries.train_gbt_early_stop(spark, "").collect()
    assert rounds == [20] and len(rows) == 400 and all(r.ROUNDS_OK and r.P_OK and r.PRED_OK for r in rows)
