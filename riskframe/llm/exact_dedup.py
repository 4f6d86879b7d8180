"""Exact dedup on an extendible-hash index, with DataFrame functions only.

Texts are equal when identical after every run of white space becomes one blank. The work runs in four steps:

1. **Keys.** One scan gives every document a 64-bit hash and the SHA-256 of its normalised text (a narrow table in the
   shared folder).
2. **Directory.** Hashes go to buckets by their leading bits. While a bucket holds more than ``capacity`` different hashes
   the directory doubles: overfull buckets split on their next bit, the others keep their depth. It has one row for each
   bucket, about twice the hashes divided by ``capacity``, and is broadcast where it is counted small.
3. **Index.** The directory sends every text to its bucket; within the bucket ``groupBy(bucket, hash, text)`` compares the
   bytes themselves, and different texts of one hash are chained (``chain`` 0, 1, ..). The copies of a text are combined
   before the shuffle, so a text that a third of all rows hold arrives as one row from each map task. The entries, sorted by
   bucket and hash, are written as files in the shared folder, each task owning a range of whole buckets.
4. **Probe.** A key finds its bucket through the directory and its entry in the bucket's chain, by hash and digest.

Defined results: null text counts as empty; a null id is never the smallest unless all ids of the group are null (then
``keep_id`` is null and the rows are kept); rows that repeat id and text get equal answers, and ``deduplicate`` leaves
one of them; an empty table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import SPACES, id_text, sized, table, unused
from riskframe.llm.registry import register
from riskframe.session import materialize

#: Entries of a bucket before it splits.
CAPACITY = 65_536
FIRST_DEPTH, LAST_DEPTH = 4, 60


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACES, " ")


def keys_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, h, sha: the narrow form of every document."""
    norm = id_text(docs, id_col, text_col).select("doc_id", normalised(F.col("text")).alias("norm"))
    return norm.select("doc_id", F.xxhash64("norm").alias("h"), F.sha2("norm", 256).alias("sha"))


def prefix(h: Column, depth: int) -> Column:
    """The leading ``depth`` bits of a 64-bit hash as a number from 0."""
    return F.shiftrightunsigned(h, 64 - depth)


def bucketed(df: DataFrame, directory: DataFrame, depths: list[int]) -> DataFrame:
    """``df`` (with a column h) with the depth and number of each row's bucket; a hash without a bucket has no place."""
    found = []
    for d in depths:
        part = directory.where(F.col("depth") == d).select(F.col("prefix").alias(f"_b_{d}"))
        df = df.withColumn(f"_h_{d}", prefix(F.col("h"), d)).join(part, F.col(f"_h_{d}") == F.col(f"_b_{d}"), "left").drop(f"_h_{d}")
        found.append(F.when(F.col(f"_b_{d}").isNotNull(), F.struct(F.lit(d).alias("depth"), F.col(f"_b_{d}").alias("bucket"))))
    if not found:
        return df.withColumns({"depth": F.lit(FIRST_DEPTH), "bucket": F.lit(None).cast("bigint")}).where(F.lit(False))
    df = df.withColumn("_b", F.coalesce(*found)).where(F.col("_b").isNotNull())
    return df.withColumns({"depth": F.col("_b.depth"), "bucket": F.col("_b.bucket")}).drop("_b", *[f"_b_{d}" for d in depths])


def entries_of(docs: DataFrame, directory: DataFrame, depths: list[int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """depth, bucket, h, chain, sha, keep_id, group_size: one row for each different text, compared byte by byte within its
    bucket."""
    norm = id_text(docs, id_col, text_col).select("doc_id", normalised(F.col("text")).alias("norm"))
    norm = bucketed(norm.withColumn("h", F.xxhash64("norm")), directory, depths)
    groups = (
        norm.groupBy("depth", "bucket", "h", "norm")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("depth", "bucket", "h", F.sha2("norm", 256).alias("sha"), "keep_id", "group_size")
    )
    chain = F.row_number().over(Window.partitionBy("depth", "bucket", "h").orderBy("sha")) - 1
    return groups.withColumn("chain", chain)


def directory_of(keys: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """depth, prefix, n: the buckets over the hashes h. Their number follows the different hashes divided by ``capacity``; of
    each doubling only one number, the bits, comes to the driver."""
    left, found, depth = keys.select("h"), None, FIRST_DEPTH
    while True:
        counts = left.distinct().groupBy(prefix(F.col("h"), depth).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))
        counts = materialize(counts, "dedup-directory")
        last = depth >= LAST_DEPTH
        full = counts.where(F.lit(last) | (F.col("n") <= capacity))
        level = full.select(F.lit(depth).alias("depth"), "prefix", "n")
        found = level if found is None else found.unionByName(level)
        over = counts.where((F.col("n") > capacity) & F.lit(not last))
        if over.isEmpty():
            return found
        left = left.join(over.select("prefix"), prefix(F.col("h"), depth) == F.col("prefix"), "left_semi")
        depth += 1


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, keys: DataFrame | None = None) -> tuple[DataFrame, DataFrame, list[int]]:
    """The index as read back from its files (depth, bucket, h, chain, sha, keep_id, group_size), the directory (depth,
    prefix, n) and its depths. ``keys`` are those of the documents, where they are written already."""
    keys = materialize(keys_of(docs, id_col, text_col), "dedup-keys") if keys is None else keys
    directory = sized(directory_of(keys, capacity), "dedup-buckets")
    depths = [r[0] for r in directory.select("depth").distinct().sort("depth").collect()]
    entries = entries_of(docs, directory, depths, id_col, text_col)
    start = F.shiftrightunsigned(F.call_function("shiftleft", F.col("bucket"), (64 - F.col("depth")).cast("int")), 1)  # in the order of the hashes
    owned = entries.withColumn("_s", start).repartitionByRange("_s").sortWithinPartitions("_s", F.shiftrightunsigned("h", 1), "chain").drop("_s")
    return materialize(owned, "dedup-index"), directory, depths


def probed(keys: DataFrame, index: DataFrame, directory: DataFrame, depths: list[int]) -> DataFrame:
    """doc_id, sha, keep_id, group_size of every key: its bucket through the directory, its entry in the bucket's chain."""
    here = index.select("depth", "bucket", "h", "sha", "keep_id", "group_size")
    return bucketed(keys, directory, depths).join(here, ["depth", "bucket", "h", "sha"]).select("doc_id", "sha", "keep_id", "group_size")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    keys = materialize(keys_of(docs, id_col, text_col), "dedup-keys")
    index, directory, depths = build_index(docs, id_col, text_col, capacity, keys)
    return probed(keys, index, directory, depths).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """The rows that stay, one of each group of equal texts, with all their columns."""
    p = unused(docs, "_d")
    kept = build_index(docs, id_col, text_col, capacity)[0].select(F.col("keep_id").alias(f"{p}_id"), F.col("sha").alias(f"{p}_sha"))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.withColumns({f"{p}_id": F.col(f"`{id_col}`").cast("bigint"), f"{p}_sha": F.sha2(normalised(text), 256)})
    kept = kept.withColumnsRenamed({f"{p}_id": f"{p}_kid", f"{p}_sha": f"{p}_ksha"})
    same = F.col(f"{p}_id").eqNullSafe(F.col(f"{p}_kid")) & (F.col(f"{p}_sha") == F.col(f"{p}_ksha"))
    return rows.join(kept, same, "left_semi").dropDuplicates([f"{p}_id", f"{p}_sha"]).drop(f"{p}_id", f"{p}_sha")


@register(
    "op10_exact_dedup",
    r"""
    SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
    FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
    WINDOW w AS (PARTITION BY t)
    """,
)
def op10_exact_dedup(spark, sf_dir) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))
