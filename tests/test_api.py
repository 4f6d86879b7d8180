"""Call-site parity facade: reader, helpers and detector over the sf0.001 views."""

from pyspark.sql import functions as F

from riskframe import api
from riskframe.session import scratch_path

from .conftest import SF_SMALL


def test_reader_tables(spark):
    t = api.from_fixtures(spark, SF_SMALL)
    acc, tx = t.get_info()
    assert "LABEL" in acc.columns and acc.select("ACCT_NBR").distinct().count() == acc.count()
    assert "DRCR_1" in tx.columns and "CHANNEL_CODE" not in tx.columns
    ft = t.get_transaction_merge_into_account()
    assert ft.count() == acc.count() and "TOP_N_5" in ft.columns
    assert t.get_account_merge_into_transaction().count() == tx.count()
    df = spark.createDataFrame([(8,), (18,)], "TRN_CODE int")
    assert t.column_classify(df, "TRN_CODE", [[8]]).collect()[0][0] == 1
    assert t.column_classify(df, "TRN_CODE", [[8], [8, 18]]).columns == ["TRN_CODE_class_0", "TRN_CODE_class_1"]


def test_answer_sheet_roundtrip(spark):
    t = api.from_fixtures(spark, SF_SMALL)
    preds = t.read_account_info().select("ACCT_NBR", F.col("LABEL").alias("PRED"))
    path = t.write_answer(preds, scratch_path(spark, "ans"))
    back = spark.read.option("header", True).csv(path)
    assert back.count() == t.answer.count()
    cleared = spark.read.option("header", True).csv(t.clean_answer(scratch_path(spark, "ans-clean")))
    assert cleared.where("Y IS NOT NULL AND Y <> ''").count() == 0


def test_detector_pipeline(spark):
    det = api.FraudDetector(api.from_fixtures(spark, SF_SMALL), params={"maxIter": 3})
    out = det.run_pipeline(k=2)
    assert 0.1 <= out["best_threshold"] <= 0.85
    assert out["cv"].count() == 3
    p = out["predictions"]
    assert set(p.columns) == {"account_id", "fraud_probability", "fraud_prediction", "risk_level"}
    lo, hi = p.agg(F.min("fraud_probability"), F.max("fraud_probability")).first()
    assert 0.0 <= lo <= hi <= 1.0


def test_reader_from_csv_paths(spark):
    from riskframe.sources import files
    from riskframe.sources import fixtures as fx

    paths = {}
    for name, df in {"acc": fx.accounts(spark, SF_SMALL), "idn": fx.identity(spark, SF_SMALL),
                     "txn": fx.transactions(spark, SF_SMALL), "ntc": fx.notices(spark, SF_SMALL)}.items():
        paths[name] = files.write_csv(df, scratch_path(spark, f"csv-{name}"))
    t = api.AccountTables(spark, paths["acc"], paths["idn"], paths["txn"], paths["ntc"], today=fx.FIXTURE_TODAY)
    from_csv = t.get_transaction_merge_into_account()
    from_df = api.from_fixtures(spark, SF_SMALL).get_transaction_merge_into_account()
    assert from_csv.count() == from_df.count()
    assert from_csv.agg(F.sum("LABEL")).first()[0] == from_df.agg(F.sum("LABEL")).first()[0]
    assert abs(from_csv.agg(F.sum("TX_AMT_1")).first()[0] - from_df.agg(F.sum("TX_AMT_1")).first()[0]) < 1e-6
