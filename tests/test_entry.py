"""Driver contract: entry() runs the flagship on sf0.001 with a stable schema."""

import __spark_entry__ as E


def test_entry_flagship(spark):
    df = E.entry(spark)
    assert "LABEL" in df.columns and "TX_AMT_5" in df.columns
    assert df.count() > 0
    assert E.entry(spark).schema == df.schema
