"""Document fingerprints: 64-bit SimHash, and the search for all fingerprints within a Hamming radius.

**Fingerprint.** The terms of a text are its words (A-Z in lower case) and its pairs of neighbouring words. Every distinct
term hashes to 64 bits, each of which votes +w or -w on its place, w = (1 + ln count) * weight of the kind of term; the
signs of the sums are the fingerprint. Equal texts have equal fingerprints; a text without words has all bits 0.

**Search.** The 64 places are cut into ``blocks`` blocks. Two fingerprints that differ in at most ``radius`` places agree
in at least blocks - radius whole blocks, so with one table for each choice of that many blocks, keyed by the bits of the
chosen blocks, every match meets in some table. Tables hold distinct fingerprints with their counts, so copies cost one
row; the join on (table, key) is an ordinary shuffled join, and ``bit_count`` confirms the radius.

**Neighbours.** ``edited_fingerprints`` range-partitions the documents by id once and goes through each range in order;
the last document of a range meets the first of the next one in a join of one row for each range.

Defined results: null text is empty; null ids come first, equal ids in the order of the text hash; after the last
document comes the first (a single document follows itself); an empty table gives an empty result; other columns aren't
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.llm.common import id_text, table
from riskframe.llm.registry import register
from riskframe.llm.shingles import WordHashes, ordered_hash, words_of
from riskframe.llm.words import slices
from riskframe.session import materialize

BITS = 64
#: Weights of a word and of a pair of words.
WORD_WEIGHT, PAIR_WEIGHT = 0.5, 1.0
RADIUS, BLOCKS = 3, 5


def fingerprint(text: str | None, known: WordHashes) -> int:
    """SimHash as an unsigned 64-bit number."""
    words = words_of(text)
    if not words:
        return 0
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    single, n1 = np.unique(ordered_hash(h, 1), return_counts=True)
    pairs, n2 = np.unique(ordered_hash(h, 2), return_counts=True) if len(h) > 1 else (h[:0], np.zeros(0))
    weight = np.concatenate([(1 + np.log(n1)) * WORD_WEIGHT, (1 + np.log(np.maximum(n2, 1))) * PAIR_WEIGHT]).astype(np.float32)
    bits = np.unpackbits(np.concatenate([single, pairs]).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    votes = weight @ (bits.astype(np.float32) * 2 - 1)
    return int.from_bytes(np.packbits(votes > 1e-3).tobytes(), "big")


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (bigint: the 64 bits) of every row."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([signed(fingerprint(t.as_py(), known)) for t in b.column(1)], pa.int64())], ["doc_id", "fp"])

    return id_text(docs, id_col, text_col).mapInArrow(task, "doc_id bigint, fp bigint")


def block_masks(radius: int = RADIUS, blocks: int = BLOCKS) -> list[int]:
    """The places kept by each table, as 64-bit masks: every choice of blocks - radius blocks."""
    if not 0 <= radius < blocks <= BITS:
        raise ValueError("radius must be below the number of blocks, and that 64 at most")
    edge = [BITS * i // blocks for i in range(blocks + 1)]
    block = [(1 << edge[i + 1]) - (1 << edge[i]) for i in range(blocks)]
    return [sum(some) for some in combinations(block, blocks - radius)]


def within_radius(queries: DataFrame, fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """q, fp, n, distance: for each distinct fingerprint q of ``queries`` the distinct fingerprints of ``fps`` within
    ``radius``, with the number n of rows that have them. Both tables need a column ``fp``; null is never found."""
    masks = block_masks(radius, blocks)
    tables = F.array(*[F.struct(F.lit(i).alias("t"), F.lit(signed(m)).alias("mask")) for i, m in enumerate(masks)])

    def keyed(df: DataFrame, name: str) -> DataFrame:
        rows = df.select("*", F.explode(tables).alias("b"))
        return rows.select(*df.columns, F.col("b.t").alias(f"{name}_t"), F.col(name).bitwiseAND(F.col("b.mask")).alias(f"{name}_key"))

    q = keyed(queries.where(F.col("fp").isNotNull()).select(F.col("fp").alias("q")).distinct(), "q")
    every = keyed(fps.where(F.col("fp").isNotNull()).groupBy("fp").agg(F.count(F.lit(1)).alias("n")), "fp")
    distance = F.bit_count(F.col("q").bitwiseXOR(F.col("fp")))
    met = q.join(every, (F.col("q_t") == F.col("fp_t")) & (F.col("q_key") == F.col("fp_key")) & (distance <= radius))
    # A pair that agrees in more blocks meets in several tables; it is kept in the first one.
    differs = F.col("q").bitwiseXOR(F.col("fp"))
    first = F.coalesce(*[F.when(differs.bitwiseAND(F.lit(signed(m))) == 0, F.lit(i)) for i, m in enumerate(masks)])
    return met.where(F.col("q_t") == first).select("q", "fp", "n", distance.alias("distance"))


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter (floor) replaced by as many characters of the one that follows."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


#: What a task gives for a document: done rows have everything but texts; the first and last row of a range wait.
_ROW = "kind int, part int, doc_id bigint, n_chars bigint, edited_sha256 string, fp bigint, edited_fp bigint, next_fp bigint, text string"
_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
_NAMES = [x.split()[0] for x in _ROW.split(", ")]
DONE, FIRST, LAST = 0, 1, 2


def _finished(part: int | None, doc_id: int | None, text: str, fp: int, following: str, next_fp: int, known: WordHashes) -> tuple:
    new = edited(text, following)
    return (DONE, part, doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), fp, signed(fingerprint(new, known)), next_fp, None)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), _TYPES)], _NAMES)


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fp, edited_fp, next_fp of every row (the fingerprints as bigint)."""

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = WordHashes(), None
        for b in batches:
            ids, texts, parts = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()
            for i, j in slices(texts):
                rows = []
                for doc_id, text, part in zip(ids[i:j], texts[i:j], parts[i:j]):
                    fp = signed(fingerprint(text, known))
                    if held is None:
                        rows.append((FIRST, part, doc_id, len(text), None, fp, None, None, text))
                    else:
                        rows.append(_finished(*held, text, fp, known))
                    held = (part, doc_id, text, fp)
                yield _batch(rows)
        if held is not None:
            part, doc_id, text, fp = held
            yield _batch([(LAST, part, doc_id, len(text), None, fp, None, None, text)])

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for b in batches:
            if len(b):
                yield _batch([_finished(None, *row, known) for row in zip(*[c.to_pylist() for c in b.columns])])

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("no")]
    rows = id_text(docs, id_col, text_col).withColumn("no", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text", F.spark_partition_id())
    done = materialize(rows.mapInArrow(ranges, _ROW), "simhash-ranges")
    first = done.where(F.col("kind") == FIRST).select(F.col("part").alias("follows"), F.col("text").alias("next_text"), F.col("fp").alias("next_fp"))
    parts = done.where(F.col("kind") == FIRST).select("part")
    by_part = Window.orderBy("part")  # one number for each range
    start = F.min("part").over(Window.partitionBy())
    parts = parts.select("part", F.coalesce(F.lead("part").over(by_part), start).alias("follows"))
    last = done.where(F.col("kind") == LAST).select("part", "doc_id", "text", "fp").join(parts, "part").join(first, "follows")
    last = last.select("doc_id", "text", "fp", "next_text", "next_fp").mapInArrow(edges, _ROW)
    columns = ["doc_id", "n_chars", "edited_sha256", "fp", "edited_fp", "next_fp"]
    return done.where(F.col("kind") == DONE).select(*columns).unionByName(last.select(*columns))


@register("op1_simhash")
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Besides the contract's columns n_within: for ids divisible by 100 the number of documents (itself included) whose
    fingerprint is within the radius, else null."""
    rows = materialize(edited_fingerprints(table(spark, sf_dir, "documents")), "simhash-documents")
    asked = F.coalesce(F.col("doc_id") % 100 == 0, F.lit(False))
    found = within_radius(rows.where(asked).select("fp"), rows.select("fp")).groupBy(F.col("q").alias("asked_fp")).agg(F.sum("n").alias("n_within"))
    answered = rows.where(asked).join(found, F.col("fp") == F.col("asked_fp"), "left").drop("asked_fp")
    # The others have no key to join on; a null key would bring them all to one task.
    out = answered.unionByName(rows.where(~asked).withColumn("n_within", F.lit(None).cast("bigint")))

    def text_of(c: str):
        return F.lower(F.lpad(F.hex(c), 16, "0"))

    def likeness(c: str):
        return 1 - F.bit_count(F.col("fp").bitwiseXOR(F.col(c))) / F.lit(float(BITS))

    return out.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        text_of("fp").alias("fingerprint"),
        text_of("edited_fp").alias("edited_fingerprint"),
        likeness("edited_fp").alias("near_edited"),
        likeness("next_fp").alias("near_next"),
        "n_within",
    )
