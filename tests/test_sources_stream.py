"""Header-driven CSV reading (A2) and the streaming upsert on hand-made files (M1, M2)."""

import pytest
from pyspark.sql import functions as F

from riskframe.session import scratch_path
from riskframe.sources import files
from riskframe.streaming import upsert


def _write_text(spark, lines, path):
    spark.createDataFrame([(l,) for l in lines], "value string").coalesce(1).write.text(path)
    return path


def test_profile_csv_header_rules(spark):
    path = _write_text(spark, [" Acct_Nbr , TX_COUNT ,AGE", "A1,3,40", "", "A2,x,", "A3,5,61", ",7,8"], scratch_path(spark, "csv"))
    df = files.read_profile_csv(spark, path).orderBy("ACCT_NBR")
    assert df.columns == ["ACCT_NBR", "TX_COUNT", "AGE"]
    # a column with a text stays text; an empty key keeps its row
    assert [tuple(r) for r in df.collect()] == [(None, "7", 8.0), ("A1", "3", 40.0), ("A2", "x", None), ("A3", "5", 61.0)]
    typed = files.read_profile_csv(spark, path, numeric=["TX_COUNT", "AGE"]).where("ACCT_NBR = 'A2'").first()
    assert tuple(typed) == ("A2", None, None)
    bad = _write_text(spark, ["ID,TX_COUNT", "A1,3"], scratch_path(spark, "csv-bad"))
    with pytest.raises(ValueError):
        files.read_profile_csv(spark, bad)


def test_stream_upsert_out_of_order_and_failures(spark):
    src = scratch_path(spark, "src")
    schema = "ACCT_NBR long, SEQ long, AMT double"
    # file 1: account 1 scored at SEQ 5 and (failed) at SEQ 9; file 2: account 1 again, older SEQ 3, and account 2
    spark.createDataFrame([(1, 5, 0.9), (1, 9, None)], schema).write.parquet(f"{src}/f=1")
    spark.createDataFrame([(1, 3, 0.1), (2, 4, 0.55)], schema).write.parquet(f"{src}/f=2")
    sink, ck = scratch_path(spark, "sink"), scratch_path(spark, "ck")
    upsert.run_upsert_stream(spark, f"{src}/f=*", schema, sink, ck, lambda r: r.withColumn("SCORE", F.col("AMT")),
                             state_partitions=4)
    cur = {r.ACCT_NBR: (r.SEQ, r.SCORE, r.LEVEL) for r in upsert.current_table(spark, sink).collect()}
    assert cur == {1: (5, 0.9, "high"), 2: (4, 0.55, "medium")}
    counts = {r.NAME: r.N for r in upsert.latest_counts(spark, sink).collect()}
    assert counts == {"high": 1, "medium": 1, "low": 0, "stored": 2, "flagged": 2, "processed": 4}


def test_stream_hot_account_text_keys_and_compaction(spark):
    src = scratch_path(spark, "src")
    schema = "ACCT_NBR string, SEQ long, AMT double"
    rows = [("ACCT1" if i % 3 == 0 else f"ACCT{i % 50}", i, None if i % 11 == 0 else (i % 100) / 100) for i in range(900)]
    for f in (2, 0, 1):  # files out of order
        spark.createDataFrame(rows[f * 300 : f * 300 + 300], schema).write.parquet(f"{src}/f={2 - f}")
    sink, ck = scratch_path(spark, "sink"), scratch_path(spark, "ck")
    upsert.run_upsert_stream(spark, f"{src}/f=*", schema, sink, ck, lambda r: r.withColumn("SCORE", F.col("AMT")), files_per_trigger=1)
    want = {}
    for a, s, v in rows:
        if v is not None and s >= want.get(a, (-1,))[0]:
            want[a] = (s, v)
    for at in (sink, upsert.compact(spark, sink)):
        assert {r.ACCT_NBR: (r.SEQ, r.SCORE) for r in upsert.current_table(spark, at).collect()} == want
        counts = {r.NAME: r.N for r in upsert.latest_counts(spark, at).collect()}
        assert counts["processed"] == 900 and counts["stored"] == len(want)
        assert counts["flagged"] == sum(v >= 0.5 for _, v in want.values())


def test_stream_state_runs_in_the_jvm(spark):
    df = spark.createDataFrame([("a", 1, 0.5)], "ACCT_NBR string, SEQ long, SCORE double")
    plan = upsert.latest_scored(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "partial_max_by" in plan


def test_sample_layouts_have_text_keys(spark):
    path = _write_text(spark, ["ACCT_NBR,CUST_ID,CANCEL_NO_CONTACT,IS_DIGITAL,ACCT_OPEN_DT,AUM_AMT", "ACCT28942,CUST1,0,1,5000,12.5"], scratch_path(spark, "csv"))
    from riskframe.sources import schemas

    df = files.read_table(spark, path, schemas.ACCOUNTS)
    assert dict(df.dtypes)["AUM_AMT"] == "double" and df.first().ACCT_NBR == "ACCT28942"
