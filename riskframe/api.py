"""Call-site parity: the reader / detector / helper entry points of the original project, as thin compositions
of the DataFrame operators. Methods return DataFrames or fitted objects. No rows are collected, but fitted things (one-hot
lists, scalers, splits' class sizes, thresholds) run their small jobs when they are made.

    tables = AccountTables(spark, accounts=..., identity=..., transactions=..., notices=...)
    features = tables.get_transaction_merge_into_account()          # labelled account feature table
    det = FraudDetector(tables)
    result = det.run_pipeline()                                      # split, train, evaluate, threshold, CV, predict
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.defaults import (
    ACCOUNT_FILLS,
    N_FOLDS,
    SEED,
    TEST_SHARE,
    THRESHOLD_DEFAULT,
    THRESHOLD_SHEET,
    TODAY,
    TOP_ATTRIBUTIONS,
)
from riskframe.operators import attribution, features, joins, metrics, models, sampling, scoring
from riskframe.operators.tree_attribution import TreeAttribution
from riskframe.operators.policy import ColumnPolicy, FittedPolicy, class_flags, in_list
from riskframe.session import materialize
from riskframe.sources import files, schemas

KEY = "ACCT_NBR"


def _load(spark: SparkSession, src, fmt: str, schema=None) -> DataFrame | None:
    if src is None or isinstance(src, DataFrame):
        return src
    return files.read_table(spark, src, schema, fmt)


class AccountTables:
    """The account / identity / transaction / notice tables and the operations the original reader offered.

    Tables are DataFrames or paths (``fmt`` = 'csv' with header, typed by :mod:`riskframe.sources.schemas`, or 'parquet'). ``txn_policy`` may be a policy
    already fitted on training data, so a test-set reader produces the same columns (one-hot lists are not
    re-fitted per file)."""

    def __init__(self, spark: SparkSession, accounts, identity, transactions, notices=None, answer=None,
                 today: int = TODAY, fmt: str = "csv", txn_policy: ColumnPolicy | FittedPolicy | None = None,
                 account_policy: ColumnPolicy | None = None, fills: Mapping[str, object] = ACCOUNT_FILLS):
        self.spark = spark
        self.accounts = _load(spark, accounts, fmt, schemas.ACCOUNTS)
        self.identity = _load(spark, identity, fmt, schemas.IDENTITY)
        self.transactions = _load(spark, transactions, fmt, schemas.TRANSACTIONS)
        self.notices = _load(spark, notices, fmt, schemas.NOTICES)
        self.answer = _load(spark, answer, fmt, schemas.ANSWER)
        self.today = today
        self.fills = fills
        self._acc_policy = account_policy or features.account_policy(today)
        pol = txn_policy or features.txn_policy(today)
        self.txn_policy = pol if isinstance(pol, FittedPolicy) else pol.fit(self.transactions)

    # -- tables
    def read_account_info(self) -> DataFrame:
        """Accounts joined to identity, policy applied, nulls filled; LABEL when notices are given."""
        acc = features.account_table(self.accounts, self.identity, self._acc_policy, self.fills)
        return joins.label_accounts(acc, self.notices) if self.notices is not None else acc

    def read_transaction_info(self) -> DataFrame:
        """Transactions deduplicated, policy applied, nulls zero, restricted to known accounts."""
        return features.transaction_table(self.transactions, self.accounts.select(KEY), self.txn_policy)

    def get_info(self) -> tuple[DataFrame, DataFrame]:
        return self.read_account_info(), self.read_transaction_info()

    def get_transaction_merge_into_account(self, cuts=None) -> DataFrame:
        """The account feature table (C5), with LABEL when notices are given; the account key is kept."""
        return features.feature_table(self.accounts, self.identity, self.transactions, self.notices, self.today, self.txn_policy,
                                      cuts=cuts or features.AMOUNT_CUTS, acc_policy=self._acc_policy, fills=self.fills)

    def get_account_merge_into_transaction(self) -> DataFrame:
        """Transactions with their account's attributes (and LABEL) attached."""
        return joins.txn_with_account(self.read_transaction_info(), self.read_account_info())

    # -- column helpers
    @staticmethod
    def column_classify(df: DataFrame, column: str, standard: Sequence[Sequence]) -> DataFrame:
        """One list: the column becomes 0/1 in place; several lists: ``{column}_class_{i}`` flags replace it."""
        if len(standard) == 1:
            return df.withColumn(column, in_list(column, standard[0]))
        return df.select(*[c for c in df.columns if c != column], *class_flags(column, standard))

    @staticmethod
    def one_hot_encode(df: DataFrame, column: str) -> DataFrame:
        return ColumnPolicy({column: "one_hot_encode"}).apply(df)

    # -- answer sheet
    def write_answer(self, predictions: DataFrame, path: str, pred: str = "PRED") -> str:
        """Fill the answer sheet from (ACCT_NBR, PRED) and write it to a new path."""
        return files.write_sheet(files.fill_answer_sheet(self.answer, predictions, KEY, pred), path)

    def clean_answer(self, path: str) -> str:
        """Write the answer sheet with every answer cleared to a new path."""
        return files.write_sheet(files.clear_answer_sheet(self.answer), path)


# ------------------------------------------------------------------------------------------- helpers
def balance_data(df: DataFrame, label: str = "LABEL", key: str = KEY, seed: int = SEED) -> DataFrame:
    """Both classes drawn with replacement up to the larger class size."""
    return sampling.balance_bootstrap(df, label, key, seed)


def split_train_test(df: DataFrame, key: str = KEY, test_size: float = TEST_SHARE, seed: int = SEED) -> DataFrame:
    """Adds SPLIT = 'train' / 'test' with exactly ceil(test_size * n) test rows."""
    return sampling.split_random(df, key, test_size, seed)


def print_result(df: DataFrame, score: str = "SCORE", label: str = "LABEL", threshold: float = THRESHOLD_DEFAULT) -> dict[str, DataFrame]:
    """Classification report, confusion matrix, hard-prediction AUC and F1 as tables (L1-L4)."""
    return {
        "report": metrics.classification_report(df, score, label, threshold),
        "confusion": metrics.confusion_matrix(df, score, label, threshold),
        "auc": metrics.auc_hard(df, score, label, threshold),
        "f1": metrics.binary_metrics(df, score, label, threshold).select("F1"),
    }


def vote_for_prediction(rows: DataFrame, accounts: DataFrame, pred: str = "PRED", key: str = KEY) -> DataFrame:
    """Per account the majority of row predictions, smallest on ties, 0 without rows."""
    return scoring.vote_by_account(rows, accounts, key, pred)


# ------------------------------------------------------------------------------------------- detector
@dataclass
class FraudDetector:
    """Account-based detector: stratified split, class-weighted boosted trees, threshold sweep, CV, prediction."""

    tables: AccountTables
    params: Mapping[str, object] = field(default_factory=dict)
    threshold: float = THRESHOLD_DEFAULT
    seed: int = SEED
    feature_names: list[str] = field(default_factory=list)
    model: object = None
    scaler: models.StandardScale | None = None

    def prepare_data(self, strategy: str = "account_based") -> DataFrame:
        """Feature table with imputed band columns (+ missing flags), standard-scaled on the training split;
        SPLIT marks train / test (stratified). The feature table is written once to the checkpoint folder."""
        if strategy == "transaction_based":
            raise NotImplementedError("transaction-based strategy is not part of the account detector")
        if strategy != "account_based":
            raise ValueError("strategy must be 'account_based' or 'transaction_based'")
        ft = self.tables.get_transaction_merge_into_account()
        bands = list(features.BAND_COUNT_COLS + features.BAND_RATIO_COLS)
        lab = materialize(joins.label_accounts(self.tables.accounts.select(KEY), self.tables.notices), "detector-labels")
        split = sampling.split_stratified(lab, seed=self.seed).drop("LABEL")
        ml = materialize(models.impute_with_flags(ft, bands).join(split, KEY), "detector-table")  # computed and split once
        self.feature_names = models.feature_columns(ml, exclude=[KEY, "LABEL", "SPLIT"])
        self.scaler = models.StandardScale.fit(ml.where("SPLIT = 'train'"), self.feature_names)
        return self.scaler.transform(ml)

    def train_model(self, data: DataFrame):
        train = models.with_class_weight(data.where("SPLIT = 'train'"))
        self.model = models.fit(train, self.feature_names, models.gbt(self.params, seed=self.seed))
        return self.model

    def evaluate_model(self, data: DataFrame) -> dict[str, DataFrame]:
        scored = models.score(self.model, data.where("SPLIT = 'test'"), KEY, keep=["LABEL"]).withColumnRenamed("PROBABILITY", "SCORE")
        scored = materialize(scored, "detector-scored")  # scored once, read by all tables
        out = print_result(scored, threshold=self.threshold)
        out["curve"] = metrics.threshold_curve(scored)
        out["scored"] = scored
        return out

    def optimize_threshold(self, scored: DataFrame) -> float:
        """First threshold of the 0.10..0.85 sweep with the highest F1 (one aggregate, one row back)."""
        best = metrics.best_threshold(metrics.threshold_curve(scored)).first()
        self.threshold = float(best["THRESHOLD"])
        return self.threshold

    def cross_validate(self, data: DataFrame, k: int = N_FOLDS) -> DataFrame:
        folded = sampling.stratified_folds(data.drop("SPLIT"), k=k, seed=self.seed)
        return models.cross_validate(folded, self.feature_names, k=k, params=self.params, threshold=THRESHOLD_DEFAULT)

    def predict(self, tables: AccountTables | None = None, threshold: float | None = None) -> DataFrame:
        """Score new tables (default: this detector's) into (account_id, fraud_probability, fraud_prediction,
        risk_level); features are aligned to the training list and scaled with the training scaler."""
        t = tables or self.tables
        ft = models.impute_with_flags(t.get_transaction_merge_into_account(), list(features.BAND_COUNT_COLS + features.BAND_RATIO_COLS))
        return models.predict_accounts(self.model, ft, self.feature_names, self.scaler, KEY,
                                       self.threshold if threshold is None else threshold)

    def curve_series(self, evaluation: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        """The plotted series as tables: ROC and precision-recall points, the threshold sweep, the score scatter."""
        s = evaluation["scored"]
        return {"roc": metrics.roc_points(s), "pr": metrics.pr_points(s), "threshold": evaluation["curve"], "scatter": s.select(KEY, "SCORE", "LABEL")}

    def attributions(self, data: DataFrame, k: int = TOP_ATTRIBUTIONS) -> DataFrame:
        """The k features with the largest mean absolute Shapley value of the trained model."""
        return attribution.top_attributions(self._explained(data).mean_abs(data), k)

    def attribution_pairs(self, data: DataFrame, k: int = TOP_ATTRIBUTIONS) -> DataFrame:
        """(account, feature, value, contribution) of these features."""
        return self._explained(data).dependence(data, k)

    def _explained(self, data: DataFrame) -> TreeAttribution:
        return TreeAttribution.of(self.model, self.feature_names, data.sparkSession)

    def run_pipeline(self, k: int = N_FOLDS) -> dict[str, object]:
        data = self.prepare_data()
        self.train_model(data)
        ev = self.evaluate_model(data)
        best = self.optimize_threshold(ev["scored"])
        return {
            "evaluation": ev,
            "best_threshold": best,
            "cv": self.cross_validate(data, k),
            "series": self.curve_series(ev),
            "attributions": self.attributions(data),
            "importance": models.feature_importance(data.sparkSession, self.model, self.feature_names),
            "predictions": self.predict(),
        }


def lightgbm_by_account(train: AccountTables, params: Mapping[str, object] | None = None, threshold: float = THRESHOLD_DEFAULT) -> FraudDetector:
    """Split, train and threshold on the account table, in one call; the fitted detector predicts other tables."""
    det = FraudDetector(train, params=params or {}, threshold=threshold)
    det.train_model(det.prepare_data())
    return det


def predict_and_save(det: FraudDetector, test: AccountTables, path: str, threshold: float = THRESHOLD_SHEET) -> str:
    """Score a test set's accounts and write its answer sheet, filled, to a new path."""
    pred = det.predict(test, threshold).select(F.col("account_id").alias(KEY), F.col("fraud_prediction").alias("PRED"))
    return test.write_answer(pred, path)


def from_fixtures(spark: SparkSession, sf_dir: str) -> AccountTables:
    """Reader over the test-data views (FIXTURES.md)."""
    from riskframe.sources import fixtures as fx

    return AccountTables(spark, fx.accounts(spark, sf_dir), fx.identity(spark, sf_dir), fx.transactions(spark, sf_dir),
                         fx.notices(spark, sf_dir), today=fx.FIXTURE_TODAY,
                         answer=fx.answer_sheet(spark, sf_dir))
