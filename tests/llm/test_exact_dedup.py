import hashlib
import re

from pyspark.sql import functions as F

from riskframe.llm import exact_dedup as op

from .cases import ROWS, docs, rows_of


def expected(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(norm(t), []).append(i)
    out = []
    for i, t, *_ in rows:
        ids = groups[norm(t)]
        keep = min((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r))


COLUMNS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_groups(spark):
    assert rows_of(op.exact_duplicates(docs(spark)), *COLUMNS) == expected(ROWS)


def test_empty(spark):
    assert op.exact_duplicates(docs(spark, [])).count() == 0
    assert op.deduplicate(docs(spark, [])).count() == 0


def test_directory_doubles_and_keeps_results(spark):
    rows = [(i, f"text {i % 300}", None, None) for i in range(700)]
    df = docs(spark, rows)
    index, _, _ = op.build_index(df, capacity=4)
    buckets = index.groupBy("depth", "bucket").count().collect()
    assert max(r["count"] for r in buckets) <= 4
    assert len({r["depth"] for r in buckets}) > 1  # some buckets split further than others
    assert index.count() == 300
    assert rows_of(op.exact_duplicates(df, capacity=4), *COLUMNS) == expected(rows)


def test_deduplicate_keeps_one_row_of_each_group_with_its_columns(spark):
    kept = op.deduplicate(docs(spark))
    assert kept.columns == docs(spark).columns
    assert rows_of(kept, "doc_id") == [(0,), (1,), (3,), (6,), (7,), (8,), (9,), (10,), (None,)]


def test_no_python_on_the_main_path(spark):
    plan = op.exact_duplicates(docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_the_directory_decides_where_texts_are_compared_and_found(spark):
    """With a bucket missing from the directory its keys find nothing; with copies sent to two buckets groups fall apart."""
    rows = [(i, f"text {i % 60}", None, None) for i in range(180)]
    df = docs(spark, rows)
    keys = op.keys_of(df)
    index, directory, depths = op.build_index(df, capacity=4)
    assert op.probed(keys, index, directory, depths).count() == 180
    gone = directory.orderBy("depth", "prefix").first()
    less = directory.where((F.col("depth") != gone.depth) | (F.col("prefix") != gone.prefix))
    assert op.probed(keys, index, less, depths).count() == 180 - 3 * gone.n
    entries = op.entries_of(df, less, depths)
    assert entries.count() == 60 - gone.n


def test_files_hold_whole_buckets(spark):
    df = docs(spark, [(i, f"text {i}", None, None) for i in range(400)])
    index, _, _ = op.build_index(df, capacity=8)
    files = index.withColumn("file", F.input_file_name())
    split = files.groupBy("depth", "bucket").agg(F.count_distinct("file").alias("files"), F.count_distinct("h").alias("n"))
    assert split.where("files > 1 OR n > 8").count() == 0


def test_colliding_hashes_are_chained_and_compared(spark, monkeypatch):
    """With a hash of four values, different texts of one hash stay apart."""
    monkeypatch.setattr(op.F, "xxhash64", lambda c: F.pmod(F.length(F.col(c) if isinstance(c, str) else c), F.lit(4)).cast("bigint"))
    rows = [(i, f"text {i % 23}" + "x" * (i % 3), None, None) for i in range(120)]
    df = docs(spark, rows)
    assert rows_of(op.exact_duplicates(df, capacity=2), *COLUMNS) == expected(rows)
    index, _, _ = op.build_index(df, capacity=2)
    assert index.agg(F.max("chain")).first()[0] > 3
