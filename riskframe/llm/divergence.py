"""Source divergence audit: how far the word use of each source lies from the other sources of its language.

**Counting by a pointer sort.** A task takes the text column's Arrow buffer in slices of whole documents and builds one
pointer for each word start. The pointers, never copies of the words, are sorted by a multikey quicksort: the next eight
bytes of each suffix, up to its word's end, are its key; a slice is split in three by a pivot key, the middle part goes on
eight bytes deeper, and parts of ``SMALL`` pointers or fewer are put in order at once. Both splits keep the pointers'
order, so in a run of equal words they rise with the documents: one pass over the runs gives each word's occurrences and
documents by (language, source). Spark adds these up over slices, before and after the shuffle; a window over one row for
each source of a term, then, finds the terms that stay.

**Audit.** A language keeps the terms in at least ``least`` of its documents. With V kept terms, N occurrences of them in a
group (a language and a source, or a whole language) and n of one term, p = 1 + floor(10^9 (n + 2) / (N + 2 V)), and two
groups differ on a term by floor((p - q)^2 / (p + q)). Two parts are returned: ``pair``, for each group every other source
of the language with the sum over all kept terms; ``term``, for each group the ``top`` terms that it uses and uses more
than its language does.

**Pairs of sources in blocks.** A pair's sum needs every kept term, also those that neither source has. Sources are dealt
into tiles of about ``TILE``, terms into blocks of about ``ROWS`` counts; a work unit is a block of two tiles, held as a
matrix, and returns one partial sum for each pair. So what a unit holds is bounded whatever the numbers of terms and
sources are, and no pair is written once for each term. Terms that a unit doesn't meet count by their closed form: each
pair starts from V times the difference of two zero counts, and a unit adds what its terms change.

All numbers are whole: p is computed in decimals, differences and sums fit 64 bits.

Defined results: null text, language and source are ''; a term is a run of A-Z, a-z and non-ASCII characters with A-Z in
lower case; a group without kept terms has N = 0 and still takes part; in a language without kept terms all pairs differ by
0; repeated rows count as often as they occur, each as a document; equal values rank by the bytes of their items; a text
longer than a slice is a slice of its own; an empty table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import sized, table
from riskframe.llm.registry import register
from riskframe.session import materialize

#: Bytes of text that are sorted together, pointers that are put in order at once.
SLICE, SMALL = 16 << 20, 2048
#: Sources of a tile and counts of a block: what one unit of the pair sums holds, about.
TILE, ROWS = 128, 200_000
LEAST, TOP = 10, 10

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 0x41) & (_BYTES <= 0x5A)
_LETTER = _UPPER | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
_LOWER = np.where(_UPPER, _BYTES + 32, _BYTES).astype(np.uint8)
#: Of an eight-byte key, the bytes that lie in a word with so many bytes left.
_INSIDE = np.array([0] + [(0xFFFFFFFFFFFFFFFF << (64 - 8 * i)) & 0xFFFFFFFFFFFFFFFF for i in range(1, 9)], dtype=np.uint64)


class Words:
    """The words of a slice of documents: ``low`` (bytes in lower case), ``start``, ``length``, ``doc`` of each word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.low = np.concatenate([_LOWER[data], np.zeros(8, np.uint8)])
        inside = _LETTER[data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(data))]
        first[cuts], last[cuts - 1] = inside[cuts], inside[cuts - 1]  # no word runs over a document's border
        self.start = np.flatnonzero(first)
        self.length = np.flatnonzero(last) + 1 - self.start
        self.doc = np.searchsorted(offsets, self.start, "right") - 1
        self._eight = np.ndarray((len(data) + 1,), ">u8", self.low.tobytes(), strides=(1,))

    def keys(self, at: np.ndarray, depth: int) -> np.ndarray:
        """Eight bytes of the words ``at`` from ``depth`` on, zeros after their end; zero only where nothing is left."""
        left = np.clip(self.length[at] - depth, 0, 8)
        where = np.minimum(self.start[at] + depth, len(self._eight) - 1)
        return self._eight[where].astype(np.uint64) & _INSIDE[left]


def pointer_sort(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The word pointers in the order of their words, equal ones in their own order, and the places where a run of equal
    words starts."""
    n = len(words.start)
    order, first = np.arange(n), np.zeros(n, dtype=bool)
    key = words.keys(order, 0)
    todo = [(0, n, 0)] if n else []

    def deeper(lo: int, hi: int, depth: int) -> None:
        key[lo:hi] = words.keys(order[lo:hi], depth)
        todo.append((lo, hi, depth))

    while todo:
        lo, hi, depth = todo.pop()
        k, o = key[lo:hi], order[lo:hi]
        if hi - lo <= SMALL:
            by = np.argsort(k, kind="stable")
            k[:], o[:] = k[by], o[by]
            heads = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            first[lo + heads] = True
            ends = np.append(heads[1:], hi - lo)
            on = (ends - heads > 1) & ((k[heads] & np.uint64(0xFF)) != 0)  # eight bytes alike, and there may be more
            for a, b in zip(heads[on], ends[on]):
                if words.length[o[a:b]].max() > depth + 8:
                    deeper(lo + a, lo + b, depth + 8)
            continue
        some = np.sort(k[:: max(1, len(k) // 33)])
        pivot = some[len(some) // 2]
        below, same = k < pivot, k == pivot
        parts = np.flatnonzero(below), np.flatnonzero(same), np.flatnonzero(~(below | same))
        a, b = lo + len(parts[0]), lo + len(parts[0]) + len(parts[1])
        by = np.concatenate(parts)
        k[:], o[:] = k[by], o[by]
        first[a] = True
        if b - a > 1 and pivot & np.uint64(0xFF):
            deeper(a, b, depth + 8)
        if a > lo:
            todo.append((lo, a, depth))
        if hi > b:
            todo.append((b, hi, depth))
    return order, np.flatnonzero(first)


def counted(data: np.ndarray, offsets: np.ndarray, group: np.ndarray, groups: int):
    """Of one slice: words (list of bytes), and for each word and group that meet: word, group, occurrences, documents."""
    words = Words(data, offsets)
    order, heads = pointer_sort(words)
    run = np.zeros(len(order), np.int64)
    run[heads[1:]] = 1
    run = np.cumsum(run)
    doc = words.doc[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (run[1:] != run[:-1]) | (doc[1:] != doc[:-1])
    cell = run * groups + group[doc]
    cells, n = np.unique(cell, return_counts=True)
    docs = np.unique(cell[new], return_counts=True)[1]
    at, size = words.start[order[heads]], words.length[order[heads]]
    raw = words.low.tobytes()
    return [raw[a : a + s] for a, s in zip(at.tolist(), size.tolist())], cells // groups, cells % groups, n, docs


def occurrences(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents that have it), one row for each that occurs."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            codes, groups = pd.factorize(pd.MultiIndex.from_arrays([b.column(0).to_pandas(), b.column(1).to_pandas()]))
            langs, sources = pa.array([g[0] for g in groups], pa.string()), pa.array([g[1] for g in groups], pa.string())
            text = b.column(2).cast(pa.large_string())
            ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
            data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
            lo = 0
            while lo < len(text):
                hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + SLICE, "right")) - 1)
                terms, word, group, n, held = counted(data[ends[lo] : ends[hi]], ends[lo : hi + 1] - ends[lo], codes[lo:hi], len(groups))
                if terms:
                    term = pa.array(terms, pa.binary()).cast(pa.string()).take(pa.array(word))
                    where = pa.array(group)
                    yield pa.RecordBatch.from_arrays(
                        [langs.take(where), sources.take(where), term, pa.array(n, pa.int64()), pa.array(held, pa.int64())],
                        ["lang", "source", "term", "n", "docs"],
                    )
                lo = hi

    cols = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))]
    parts = docs.select(*cols).mapInArrow(task, "lang string, source string, term string, n bigint, docs bigint")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (n + 2) / (total + 2 terms)), exactly; null without terms."""
    above = (n + 2).cast("decimal(20,0)") * F.lit(1_000_000_000).cast("decimal(10,0)")
    return F.lit(1).cast("bigint") + F.call_function("div", above, F.nullif((total + terms * 2).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)")))


def difference(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // np.maximum(p + q, 1)


def unit_sums(rows: pd.DataFrame) -> pd.DataFrame:
    """One unit's part of the sums, for every pair of a source of one tile and one of the other."""
    sources, names = pd.factorize(rows["source"])
    zero, tile = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
    zero[sources], tile[sources] = rows["zero"], rows["tile"]
    terms = rows["term"].notna().to_numpy()
    code, s, p = pd.factorize(rows["term"][terms])[0], sources[terms], rows["p"].to_numpy()[terms].astype(np.int64)
    by = np.argsort(code, kind="stable")
    code, s, p = code[by], s[by], p[by]
    base = apart(zero[:, None], zero[None, :])
    total = base * (int(rows["v"].iat[0]) if rows["block"].iat[0] == 0 else 0)
    for lo in range(0, int(code[-1]) + 1 if len(code) else 0, 2048):
        a, b = np.searchsorted(code, (lo, lo + 2048))
        m = np.tile(zero, (int(code[b - 1]) + 1 - lo, 1))
        m[code[a:b] - lo, s[a:b]] = p[a:b]
        for i in range(len(names)):
            total[i] += apart(m[:, i : i + 1], m).sum(0) - base[i] * len(m)
    x, y = int(rows["a"].iat[0]), int(rows["b"].iat[0])
    i, j = np.nonzero(((tile[:, None] == x) & (tile == y)) | ((tile[:, None] == y) & (tile == x)))
    i, j = i[i != j], j[i != j]
    return pd.DataFrame({"lang": rows["lang"].iat[0], "source": names[i], "item": names[j], "value": total[i, j]})


def pair_sums(kept: DataFrame, groups: DataFrame, tile: int = TILE, rows: int = ROWS) -> DataFrame:
    """lang, source, item, value for all sources of a language. ``kept`` are lang, source, term, p; ``groups`` lang, source,
    total, v."""
    tiles = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
    groups = groups.join(sized(tiles, "divergence-tiles"), "lang").withColumns(
        {"tile": F.pmod(F.xxhash64("source"), "tiles").cast("int"), "zero": F.coalesce(share(F.lit(0), F.col("total"), F.col("v")), F.lit(0))}
    )
    groups = sized(groups.select("lang", "source", "tile", "tiles", "zero", "v"), "divergence-groups")
    blocks = max(1, -(-kept.count() // rows))
    block = F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int")
    counts = kept.select("lang", "source", "term", "p", block.alias("block")).join(groups, ["lang", "source"])
    # Every source meets every block, with or without a count in it.
    none = groups.withColumns({"term": F.lit(None).cast("string"), "p": F.lit(0).cast("bigint"), "block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))})
    both = counts.unionByName(none).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    both = both.withColumns({"a": F.least("tile", "other"), "b": F.greatest("tile", "other")}).drop("other", "tiles")
    sums = both.groupBy("lang", "block", "a", "b").applyInPandas(unit_sums, "lang string, source string, item string, value bigint")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(
    docs: DataFrame,
    least: int = LEAST,
    top: int = TOP,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    tile: int = TILE,
    rows: int = ROWS,
) -> DataFrame:
    """lang, source, part, item, value, rank: both parts of the audit, for every group that occurs."""
    names = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"))]
    per_term = Window.partitionBy("lang", "term")
    found = occurrences(docs, text_col, lang_col, source_col)
    found = found.withColumns({"lang_n": F.sum("n").over(per_term), "held": F.sum("docs").over(per_term)}).where(F.col("held") >= least)
    kept = materialize(found.select("lang", "source", "term", "n", "lang_n"), "divergence-kept")
    whole = kept.select("lang", "term", "lang_n").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    groups = docs.select(*names).distinct().join(kept.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
    groups = groups.join(sized(whole, "divergence-langs"), "lang", "left").na.fill(0, ["total", "v", "lang_total"])
    groups = sized(groups, "divergence-groups")

    p, q = share(F.col("n"), F.col("total"), F.col("v")), share(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    shares = kept.join(groups, ["lang", "source"]).select("lang", "source", "term", p.alias("p"), q.alias("q"))
    order = [F.col("value").desc(), F.col("item")]
    over = Window.partitionBy("lang", "source").orderBy(*order)
    used = shares.where(F.col("p") > F.col("q")).select("lang", "source", F.col("term").alias("item"), difference(F.col("p"), F.col("q")).alias("value"))
    used = used.withColumn("rank", F.row_number().over(over)).where(F.col("rank") <= top)
    pairs = pair_sums(shares.drop("q"), groups.select("lang", "source", "total", "v"), tile, rows).withColumn("rank", F.row_number().over(over))
    out = [df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank") for df, part in ((pairs, "pair"), (used, "term"))]
    return out[0].unionByName(out[1])


@register(
    "op12_source_divergence",
    r"""
    WITH d AS (
      SELECT row_number() OVER () AS no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
    w AS (SELECT no, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
    k AS (SELECT lang, term, count(*)::HUGEINT AS n FROM w GROUP BY lang, term HAVING count(DISTINCT no) >= 10),
    v AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM k GROUP BY lang),
    g AS (SELECT DISTINCT lang, source FROM d),
    c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY ALL),
    s AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
    p AS (
      SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (s.n + 2 * v.v) AS p,
             1 + (1000000000::HUGEINT * (k.n + 2)) // (v.n + 2 * v.v) AS q
      FROM s JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
    a AS (
      SELECT g.lang, g.source, 'pair' AS part, o.source AS item, coalesce(sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)), 0)::BIGINT AS value
      FROM g JOIN g o ON g.lang = o.lang AND g.source <> o.source
      LEFT JOIN p x ON x.lang = g.lang AND x.source = g.source
      LEFT JOIN p y ON y.lang = o.lang AND y.source = o.source AND y.term = x.term
      GROUP BY ALL
      UNION ALL
      SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q)
    SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
    FROM a QUALIFY part = 'pair' OR rank <= 10
    """,
)
def op12_source_divergence(spark, sf_dir) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))
