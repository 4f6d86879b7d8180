"""Model training, search and scoring on Spark ML.

The learners are Spark ML's own (GBTClassifier, RandomForestClassifier); this module only prepares the feature
table (imputation flags, fitted scaling, vector assembly), wires class weights, runs fold / trial loops whose
every fit is a distributed Spark job, and turns models back into tables (scores, importances).
Leaf counts of the original boosting setup map to depth (31-52 leaves ~ depth 5-6).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.defaults import CV_ROUNDS, EARLY_FOLDS, EARLY_PATIENCE, EARLY_START, FOREST_DEPTH, GBT_PARAMS, N_FOLDS, SEED, THRESHOLD_DEFAULT, TUNE_KEEP, TUNE_PARALLEL, TUNE_SPACE, TUNE_TRIALS
from riskframe.functions.bands import apply_threshold, risk_band_cut
from riskframe.session import materialize, own_reads, read_in

KEY = "ACCT_NBR"
#: Numbers (rows times what a learner keeps of one) in a partition of training rows; a learner keeps each in four bytes.
PART_VALUES = 1 << 24
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def feature_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    return [f.name for f in df.schema.fields if f.name not in exclude and isinstance(f.dataType, _NUMERIC)]


def impute_with_flags(df: DataFrame, columns: Sequence[str], suffix: str = "_missing") -> DataFrame:
    """Trees cannot take null/NaN: nulls become 0 and a ``{col}_missing`` 0/1 flag keeps the information."""
    flags = [F.col(c).isNull().cast("int").alias(f"{c}{suffix}") for c in columns]
    filled = [F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)).alias(c) if c in columns else F.col(c) for c in df.columns]
    return df.select(*filled, *flags)


@dataclass(frozen=True)
class StandardScale:
    """K1: mean / population std fitted once (two numbers per column), applied as literals; std 0 -> 1."""

    columns: tuple[str, ...]
    means: tuple[float, ...]
    stds: tuple[float, ...]

    @staticmethod
    def fit(df: DataFrame, columns: Sequence[str]) -> StandardScale:
        row = df.agg(*[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]).first()
        return StandardScale(
            tuple(columns), tuple(float(row[f"m_{c}"] or 0.0) for c in columns), tuple(float(row[f"s_{c}"] or 0.0) for c in columns)
        )

    def transform(self, df: DataFrame) -> DataFrame:
        z = {
            c: ((F.col(c) - F.lit(m)) / F.lit(s if s else 1.0)).alias(c)
            for c, m, s in zip(self.columns, self.means, self.stds)
        }
        return df.select(*[z.get(c, F.col(c)) for c in df.columns])


def assembler(features: Sequence[str], out: str = "features") -> VectorAssembler:
    """Feature list -> vector column, in list order."""
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error")


def gbt(params: Mapping[str, object] | None = None, label: str = "LABEL", weight: str | None = "WEIGHT", seed: int = SEED,
        validation: str | None = None) -> GBTClassifier:
    """K2: boosted trees with the reference's budget by default (``GBT_PARAMS``)."""
    p = dict(GBT_PARAMS)
    p.update(params or {})
    kw = dict(labelCol=label, featuresCol="features", seed=seed, **p)
    if weight:
        kw["weightCol"] = weight
    if validation:
        kw["validationIndicatorCol"] = validation
    return GBTClassifier(**kw)


def forest(num_trees: int = 100, max_depth: int = FOREST_DEPTH, label: str = "LABEL", seed: int = SEED) -> RandomForestClassifier:
    """K4/K5: random forest (100 trees by default), as deep as Spark's trees go unless ``max_depth`` says otherwise."""
    return RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=num_trees, maxDepth=max_depth, seed=seed)


def spread(train: DataFrame, width: int) -> DataFrame:
    """``train`` in at least as many partitions as rows of ``width`` numbers need at ``PART_VALUES`` each. Learners keep their
    binned rows in the partitions of the input, which a file reader sizes by compressed bytes: it gets smaller ones, and only
    rows that can't be read so are shuffled. A few rows are left as they are."""
    n = -(-train.count() * width // PART_VALUES)
    return train if n <= train.sparkSession.sparkContext.defaultParallelism or read_in(train, n) else train.repartition(n)


def fit(train: DataFrame, features: Sequence[str], learner) -> PipelineModel:
    """The learner's model on the assembled features. A forest keeps a number for each tree beside a row's features."""
    with own_reads(train.sparkSession):
        train = spread(train, len(features) + (learner.getNumTrees() if isinstance(learner, RandomForestClassifier) else 0))
        return Pipeline(stages=[assembler(features), learner]).fit(train)


def score(model: PipelineModel, df: DataFrame, key: str = KEY, keep: Sequence[str] = (), threshold: float = THRESHOLD_DEFAULT) -> DataFrame:
    """(key, kept columns, PROBABILITY of class 1, PREDICTION = PROBABILITY > threshold)."""
    out = model.transform(df)
    p = vector_to_array(F.col("probability"))[1]
    return out.select(key, *keep, p.alias("PROBABILITY")).withColumn("PREDICTION", apply_threshold("PROBABILITY", threshold))


def predict_accounts(model: PipelineModel, df: DataFrame, features: Sequence[str], scaler: StandardScale | None = None,
                     key: str = KEY, threshold: float = THRESHOLD_DEFAULT) -> DataFrame:
    """K8: align -> scale -> score -> threshold -> risk level, as the result table."""
    from riskframe.operators.clean import align_features

    x = align_features(df, features, keep=[key])
    if scaler is not None:
        x = scaler.transform(x)
    s = score(model, x, key, threshold=threshold)
    return s.select(
        F.col(key).alias("account_id"), F.col("PROBABILITY").alias("fraud_probability"),
        F.col("PREDICTION").alias("fraud_prediction"), risk_band_cut("PROBABILITY").alias("risk_level"),
    )


def feature_importance(spark, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """(FEATURE, IMPORTANCE) from the fitted trees (normalised to sum 1), largest first. The importance
    vector has one entry per feature (bounded by the schema width)."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    rows = [(f, float(v)) for f, v in zip(features, imp)]
    return spark.createDataFrame(rows, "FEATURE string, IMPORTANCE double").orderBy(F.col("IMPORTANCE").desc(), "FEATURE")


def f1_at(scored: DataFrame, label: str = "LABEL", pred: str = "PREDICTION") -> dict:
    """Precision / recall / F1 of the positive class from a scored table (one aggregate)."""
    r = scored.agg(
        F.count(F.when((F.col(pred) == 1) & (F.col(label) == 1), 1)).alias("tp"),
        F.count(F.when((F.col(pred) == 1) & (F.col(label) == 0), 1)).alias("fp"),
        F.count(F.when((F.col(pred) == 0) & (F.col(label) == 1), 1)).alias("fn"),
    ).first()
    p = r.tp / (r.tp + r.fp) if r.tp + r.fp else 0.0
    rc = r.tp / (r.tp + r.fn) if r.tp + r.fn else 0.0
    return {"precision": p, "recall": rc, "f1": 2 * p * rc / (p + rc) if p + rc else 0.0}


def positive_weight(df: DataFrame, label: str = "LABEL") -> float:
    """Negatives for each positive, 1 without positives."""
    r = df.agg(F.count(F.when(F.col(label) == 0, 1)).alias("n"), F.count(F.when(F.col(label) == 1, 1)).alias("p")).first()
    return r.n / r.p if r.p else 1.0


def with_class_weight(df: DataFrame, label: str = "LABEL", name: str = "WEIGHT") -> DataFrame:
    from riskframe.operators.sampling import class_weights

    return class_weights(df, label, name)


def each_fold(df: DataFrame, width: int, k: int, run: Callable[[int], object]) -> list:
    """``run`` of every fold. Fits of a few rows (of ``width`` numbers) wait for the scheduler more than they compute: so many
    go side by side as need together no more than a partition of training rows for each core, larger ones one by one."""
    room = df.sparkSession.sparkContext.defaultParallelism * PART_VALUES
    with ThreadPoolExecutor(max_workers=max(1, min(k, room // max(1, df.count() * width)))) as ex:
        return list(ex.map(run, range(k)))


def validation_curves(df: DataFrame, features: Sequence[str], label: str = "LABEL", fold: str = "FOLD", k: int = EARLY_FOLDS,
                      params: Mapping[str, object] | None = None) -> DataFrame:
    """(FOLD, ROUND, LOSS): the log loss on each fold after every round of a model trained on the other folds. One number
    for each fold and round comes to the driver."""

    def run(i: int) -> list[tuple[int, int, float]]:
        model = fit(with_class_weight(df.where(F.col(fold) != i), label), features, gbt(params, label))
        test = model.stages[0].transform(with_class_weight(df.where(F.col(fold) == i), label))
        return [(i, n + 1, float(v)) for n, v in enumerate(model.stages[-1].evaluateEachIteration(test))]

    rows = [r for part in each_fold(df, len(features), k, run) for r in part]
    return df.sparkSession.createDataFrame(rows, "FOLD int, ROUND int, LOSS double")


def chosen_round(curves: DataFrame, patience: int = EARLY_PATIENCE) -> tuple[int, bool]:
    """The round with the lowest mean loss before ``patience`` rounds in a row bring no gain (the first of equals), and
    whether such a stop was found. The mean curve has one row for each round."""
    mean = curves.groupBy("ROUND").agg(F.avg("LOSS").alias("LOSS")).orderBy("ROUND").collect()
    best, since = 0, 0
    for i, r in enumerate(mean):
        if i and not r.LOSS < mean[best].LOSS:
            since += 1
            if since >= patience:
                return mean[best].ROUND, True
        else:
            best, since = i, 0
    return (mean[best].ROUND if mean else 1), False


def fit_early_stop(df: DataFrame, features: Sequence[str], label: str = "LABEL", fold: str = "FOLD", k: int = EARLY_FOLDS,
                   params: Mapping[str, object] | None = None, patience: int = EARLY_PATIENCE, start: int = EARLY_START) -> tuple[PipelineModel, DataFrame]:
    """K3: the folds' mean curve chooses the number of rounds, then one model is fitted on all rows with it; the model and
    the curves (FOLD, ROUND, LOSS).

    A model of few rounds is the beginning of one of many (each round's chance comes from the seed and its number), so the
    folds start with ``start`` rounds and double until the curve stops or the full number is reached: at most four times the
    rounds that matter are trained, not the whole budget."""
    most = int({**GBT_PARAMS, **(params or {})}["maxIter"])
    rounds = min(start, most)
    while True:
        curves = validation_curves(df, features, label, fold, k, {**(params or {}), "maxIter": rounds})
        n, stopped = chosen_round(curves, patience)
        if stopped or rounds >= most:
            break
        rounds = min(2 * rounds, most)
    return fit(with_class_weight(df, label), features, gbt({**(params or {}), "maxIter": n}, label)), curves


def out_of_fold(df: DataFrame, features: Sequence[str], label: str = "LABEL", fold: str = "FOLD", k: int = N_FOLDS,
                params: Mapping[str, object] | None = None, key: str = KEY) -> DataFrame:
    """(key, FOLD, LABEL, WEIGHT, PROBABILITY) of every row, scored by the model of the other folds (``CV_ROUNDS`` rounds
    unless ``params`` says otherwise); WEIGHT is the class weight that these gave to positives. Written once."""

    def run(i: int) -> DataFrame:
        rest = df.where(F.col(fold) != i)
        weight = positive_weight(rest, label)
        train = rest.withColumn("WEIGHT", F.when(F.col(label) == 1, F.lit(weight)).otherwise(F.lit(1.0)))
        scored = score(fit(train, features, gbt({"maxIter": CV_ROUNDS, **(params or {})}, label)), df.where(F.col(fold) == i), key, keep=[label])
        return scored.select(key, F.lit(i).alias("FOLD"), F.col(label).alias("LABEL"), F.lit(weight).alias("WEIGHT"), "PROBABILITY")

    return materialize(reduce(DataFrame.unionByName, each_fold(df, len(features), k, run)), "out-of-fold")


def fold_metrics(scored: DataFrame, threshold: float = THRESHOLD_DEFAULT) -> DataFrame:
    """(FOLD, ROWS, POSITIVES, WEIGHT, PRECISION, RECALL, F1) of each fold and, as FOLD -1, the folds' means (rows and
    positives: their sums): one aggregate over the out-of-fold table, a second over its few rows."""
    flag = apply_threshold("PROBABILITY", threshold) == 1
    c = scored.groupBy("FOLD").agg(
        F.count(F.lit(1)).alias("ROWS"), F.count(F.when(F.col("LABEL") == 1, 1)).alias("POSITIVES"), F.first("WEIGHT").alias("WEIGHT"),
        F.count(F.when(flag & (F.col("LABEL") == 1), 1)).alias("tp"), F.count(F.when(flag, 1)).alias("pp"),
    )
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    p, r = ratio(F.col("tp"), F.col("pp")), ratio(F.col("tp"), F.col("POSITIVES"))
    folds = c.select("FOLD", "ROWS", "POSITIVES", "WEIGHT", p.alias("PRECISION"), r.alias("RECALL"), ratio(2 * p * r, p + r).alias("F1"))
    mean = folds.agg(F.lit(-1).alias("FOLD"), F.sum("ROWS").alias("ROWS"), F.sum("POSITIVES").alias("POSITIVES"), *[F.avg(m).alias(m) for m in ("WEIGHT", "PRECISION", "RECALL", "F1")])
    return folds.unionByName(mean)


def cross_validate(df: DataFrame, features: Sequence[str], label: str = "LABEL", fold: str = "FOLD", k: int = N_FOLDS,
                   params: Mapping[str, object] | None = None, key: str = KEY, threshold: float = THRESHOLD_DEFAULT) -> DataFrame:
    """K6: every row scored by the model of the other folds, all folds' metrics from that one table."""
    return fold_metrics(out_of_fold(df, features, label, fold, k, params, key), threshold)


def random_param_maps(n: int = TUNE_TRIALS, space: Mapping[str, tuple[float, float]] = TUNE_SPACE, seed: int = SEED) -> list[dict]:
    """K7: ``n`` seeded random draws from box ranges (a stand-in for the managed Bayesian search). Ranges of whole numbers
    give whole numbers; the column share is a text, as the learner wants it."""
    import random

    rnd = random.Random(seed)
    maps = []
    for _ in range(n):
        m = {}
        for name, (lo, hi) in space.items():
            v = rnd.uniform(lo, hi)
            whole = isinstance(lo, int) and isinstance(hi, int)
            m[name] = int(round(v)) if whole else str(round(v, 4)) if name == "featureSubsetStrategy" else round(v, 4)
        maps.append(m)
    return maps


def rungs_of(maps: Sequence[Mapping], keep: int = TUNE_KEEP) -> list[tuple[int, float]]:
    """(trials, share of their full rounds) of each rung: one of ``keep`` goes on, until ``keep`` or fewer trials run their
    full rounds."""
    sizes = [len(maps)]
    while sizes[-1] > keep:
        sizes.append(math.ceil(sizes[-1] / keep))
    return [(n, keep ** (i - len(sizes) + 1)) for i, n in enumerate(sizes)]


def tune(train: DataFrame, valid: DataFrame, features: Sequence[str], maps: Sequence[Mapping] | None = None, label: str = "LABEL",
         key: str = KEY, parallelism: int = TUNE_PARALLEL, keep: int = TUNE_KEEP) -> DataFrame:
    """K7: all drawn settings (the full search by default) start with a share of their rounds; on each rung one of ``keep``
    goes on (the best by validation F1 at 0.5, the first of equals) with ``keep`` times the rounds, the last ones with all of
    them. ``parallelism`` fits at a time. Rows (TRIAL, RUNG, ROUNDS, PARAMS json, OBJECTIVE, GOES_ON), one for each trial and
    rung that it reached; the last rung's GOES_ON is the winner.

    A model of a later rung begins with the trees of the earlier one (a round's chance comes from the seed and its number),
    so a setting is judged by the beginning of its own full model."""
    import json

    maps = random_param_maps() if maps is None else maps
    full = [int({**GBT_PARAMS, **m}["maxIter"]) for m in maps]
    w = with_class_weight(train, label)

    def run(trial: int, rounds: int) -> float:
        return f1_at(score(fit(w, features, gbt({**maps[trial], "maxIter": rounds}, label)), valid, key, keep=[label]), label)["f1"]

    rows, alive = [], list(range(len(maps)))
    plan = rungs_of(maps, keep)
    for rung, (n, part) in enumerate(plan):
        rounds = [max(1, round(full[t] * part)) for t in alive]
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
            got = dict(zip(alive, ex.map(run, alive, rounds)))
        after = plan[rung + 1][0] if rung + 1 < len(plan) else 1
        on = sorted(alive, key=lambda t: (-got[t], t))[:after]
        rows += [(t, rung, r, json.dumps(maps[t], sort_keys=True), got[t], t in on) for t, r in zip(alive, rounds)]
        alive = sorted(on)
    return train.sparkSession.createDataFrame(rows, "TRIAL int, RUNG int, ROUNDS int, PARAMS string, OBJECTIVE double, GOES_ON boolean")


def save_load(model: PipelineModel, path: str) -> PipelineModel:
    """Persist with Spark's writer and read back."""
    model.write().overwrite().save(path)
    return PipelineModel.load(path)
