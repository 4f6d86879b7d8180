"""What the model queries leave on disk while they run: one shuffle of the transactions, no shuffle of training rows."""

import pytest
from pyspark.sql import functions as F

from riskframe.operators import clean, features, models
from riskframe.session import READS, materialize

POLICY = features.ColumnPolicy({"BRANCH_NO": "drop", "TX_DATE": "turn_to_days"}, {}, 100)


@pytest.fixture(scope="module")
def tables(spark):
    acc = spark.createDataFrame([(i if i < 40 else None, i % 7, 5, 10, 0, 20, 1, 12) for i in range(41)], "ACCT_NBR long, CUST_ID long, AUM_AMT int, ACCT_OPEN_DT int, IS_DIGITAL int, X int, Y int, CANCEL_NO_CONTACT int")
    who = spark.createDataFrame([(i, 30 + i) for i in range(6)], "CUST_ID long, DATE_OF_BIRTH int")
    key = F.when(F.col("id") < 300, 3).when(F.col("id") % 50 == 0, None).otherwise(F.col("id") % 45)
    txn = spark.range(900).select(key.alias("ACCT_NBR"), (F.col("id") % 11).cast("int").alias("TX_DATE"), (F.col("id") % 13 * 100.0).alias("TX_AMT"), (F.col("id") % 5).cast("int").alias("BRANCH_NO"))
    return acc, who, txn.unionByName(txn.where("TX_DATE = 4"))


def _made(tables):
    acc, who, txn = tables
    ft = features.feature_table(acc, who, txn, txn_fitted=POLICY.fit(txn))
    return ft, sorted(map(repr, ft.collect()))


def test_transactions_are_shuffled_once_by_account(tables):
    acc, who, txn = tables
    tx = features.transaction_table(txn, None, POLICY, by_key=True)
    for made in (features.txn_aggregates(tx), features.topk_wide(tx)):
        assert made._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    assert sorted(map(repr, tx.collect())) == sorted(map(repr, features.transaction_table(txn, None, POLICY).collect()))


def test_an_account_with_very_many_rows_is_dealt_over_the_tasks(tables, monkeypatch):
    plain, rows = _made(tables)
    assert clean.hot_keys(tables[2], "ACCT_NBR") == []
    monkeypatch.setattr(clean, "HOT_ROWS", 100)
    assert clean.hot_keys(tables[2], "ACCT_NBR") == [3]
    dealt, again = _made(tables)
    assert len(rows) == 40 and again == rows
    unions = [ft._jdf.queryExecution().executedPlan().toString().count("Union") for ft in (plain, dealt)]
    assert unions[0] < unions[1]


def test_training_rows_from_files_are_not_shuffled(spark, monkeypatch):
    """Smaller reading partitions instead, for as long as the fit lasts."""
    from riskframe import session

    monkeypatch.setattr(session, "ROW_GROUP", 1 << 20)
    df = materialize(spark.range(0, 2_000_000, numPartitions=1).select((F.col("id") % 2).cast("int").alias("LABEL"), F.rand(1).alias("x")), "train")
    n = 2 * spark.sparkContext.defaultParallelism
    monkeypatch.setattr(models, "PART_VALUES", -(-2_000_000 // (n - 2)))
    before, seen = spark.conf.get(READS), []
    right = models.spread
    monkeypatch.setattr(models, "spread", lambda train, width: seen.append(right(train, width)) or seen[-1])
    monkeypatch.setattr(models.Pipeline, "fit", lambda self, train: seen.append(train.select("*").rdd.getNumPartitions()))
    models.fit(df, ["x"], models.gbt({"maxIter": 1}, weight=None))
    assert "Exchange" not in seen[0]._jdf.queryExecution().executedPlan().toString() and seen[1] >= n - 2
    assert spark.conf.get(READS) == before


def test_shuffle_files_of_a_written_table_go(spark, monkeypatch):
    """They are marked for removal with the query, whatever the driver keeps of it."""
    from pyspark.sql.readwriter import DataFrameWriter

    right = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: seen.append(spark.conf.get(conf)) or right(self, path))
    conf = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, seen = spark.conf.get(conf, "false"), []
    made = materialize(spark.range(1000).repartition(4, "id"), "cleaned", spark.range(1000, 1200))
    assert seen == ["true", "true"] and made.count() == 1200 and made.distinct().count() == 1200 and spark.conf.get(conf, "false") == before


def test_lots_of_accounts_make_the_same_table(spark, monkeypatch):
    from riskframe.plans import model_queries as queries

    from .conftest import SF_SMALL

    whole, names = queries._ml_table(spark, SF_SMALL)
    monkeypatch.setattr(queries, "LOT_ROWS", 3000)
    lots, again = queries._ml_table(spark, SF_SMALL, keep=False)
    cols = ["ACCT_NBR", "LABEL", "SPLIT", *[F.round(n, 6).alias(n) if t == "double" else n for n, t in whole.dtypes if n in names]]
    assert names == again and whole.count() == lots.count() == 1500
    assert whole.select(cols).exceptAll(lots.select(cols)).count() == 0


def test_forest_rows_are_written_once_with_their_split(spark, monkeypatch):
    from riskframe.plans import model_queries as queries

    from .conftest import SF_SMALL

    made = {}
    monkeypatch.setattr(queries, "materialize", lambda df, name: made.setdefault(name, []).append(materialize(df, name)) or made[name][-1])
    monkeypatch.setattr(models, "fit", lambda *a: (_ for _ in ()).throw(StopIteration))
    with pytest.raises(StopIteration):
        queries.train_forest_txn(spark, SF_SMALL)
    (rows,), (labels,) = made["ml-transactions"], made["labels"]
    assert rows.select("ACCT_NBR").distinct().count() == labels.count() > 0 and rows.where("SPLIT IS NULL OR LABEL IS NULL").count() == 0
