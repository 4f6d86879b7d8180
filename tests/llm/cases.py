"""Small tables with every odd case: nulls in any column, empty and long texts, ties, repeated rows, clashing names."""

from pyspark.sql import functions as F

LONG = " ".join(f"w{i % 977}" for i in range(30_000))
BASE = "the quick brown fox jumps over the lazy dog while seven wizards boil an odd potion and nobody minds at all today"
ROWS = [
    (0, BASE, "en", "a"),
    (1, None, "en", "a"),
    (2, "", None, None),
    (3, " \t\n", "en", "b"),
    (4, BASE.replace(" ", "  ", 2), "en", "b"),
    (5, BASE, "en", None),
    (5, BASE, "en", None),
    (6, LONG, "en", "c"),
    (7, "!!! 123 ???", None, "c"),
    (8, BASE + " indeed", "en", "é"),
    (9, "ein Satz", "de", "é"),
    (None, "no id here", None, "a"),
    (10, "don't stop 日本語 \U0001f600  <|endoftext|> x", "de", "a"),
]
#: Names that operators use inside.
CLASHING = ["h", "sha", "norm", "k", "k1", "node", "size", "id", "toxic", "no", "start", "value", "shard", "slot", "fp", "n", "raw", "part", "keep_id", "score", "_p", "_lid", "_m_id", "_m_times", "_d_id", "_d_sha", "tree", "place", "seen", "term"]


def docs(spark, rows=None):
    rows = ROWS if rows is None else rows
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return df.withColumns({c: F.lit(f"x-{c}") for c in CLASHING})


def rows_of(df, *columns):
    order = lambda r: tuple((x is None, x) for x in r)
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=order)
