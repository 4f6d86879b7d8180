"""Byte-level BPE encoding and decoding by recursive DuckDB queries, one database per Python worker.

Every task cuts its texts into the pieces of the public pattern and gives the pieces that it hasn't met to
DuckDB as token-position rows, one row for each byte. The recursive query joins neighbouring tokens with the merge table
(every pair of tokens whose concatenation is a token), takes each word's pair of minimum rank, the leftmost of equals,
contracts it, and goes on with the words that changed, until no word has a pair left. Pieces of more than ``LONG`` bytes
go through a second query that contracts all occurrences of the word's minimum-rank pair, from left to right, in one
round, so a piece of n bytes doesn't take n rounds. A piece that is a token itself needs no row. Decoding joins the ids
with the vocabulary and concatenates by an ordered aggregation.

Memory is bounded: texts pass in slices of about a million characters, pieces in lots of 20,000, the ids that a task
keeps are limited in number. No shuffle.

Defined results: null text is empty (no ids); null or repeated ids pass through as they are; an empty table gives an
empty result; special tokens' strings are ordinary text; other columns aren't read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import id_text, table
from riskframe.llm.registry import register
from riskframe.llm.words import PartCoder, slices

#: Bytes of a piece from which the second query encodes it; pieces of a query.
LONG, LOT = 64, 20_000
#: Characters of a slice, parts and pieces that a task keeps.
CHARS, PARTS, PIECES = 1_000_000, 300_000, 250_000

ENCODE = """
WITH RECURSIVE t(k, tok, done) AS (
  SELECT k, tok, false FROM pieces
  UNION ALL
  SELECT CASE WHEN t.k > c.k THEN t.k - 1 ELSE t.k END, CASE WHEN t.k = c.k THEN c.id ELSE t.tok END, c.w IS NULL
  FROM t LEFT JOIN (
    SELECT w, (best & 1099511627775) | (w << 40) AS k, (best >> 40)::INT AS id FROM (
      SELECT a.k >> 40 AS w, min((m.id::BIGINT << 40) | (a.k & 1099511627775)) AS best
      FROM t a JOIN t b ON b.k = a.k + 1 JOIN merges m ON m.pair = (a.tok::BIGINT << 20) | b.tok
      WHERE NOT a.done AND NOT b.done GROUP BY 1)
  ) c ON t.k >> 40 = c.w
  WHERE NOT t.done AND (c.w IS NULL OR t.k <> c.k + 1))
SELECT k >> 40 AS w, list(tok ORDER BY k) AS ids FROM t WHERE done GROUP BY 1 ORDER BY 1
"""

ENCODE_LONG = """
WITH RECURSIVE t(w, pos, tok, done) AS (
  SELECT k >> 40, k & 1099511627775, tok, false FROM pieces
  UNION ALL
  SELECT w, row_number() OVER (PARTITION BY w ORDER BY pos), CASE WHEN take THEN best ELSE tok END, best IS NULL
  FROM (
    SELECT *, coalesce(lag(take) OVER (PARTITION BY w ORDER BY pos), false) AS gone
    FROM (
      SELECT *, hit AND row_number() OVER (PARTITION BY w, hit, run ORDER BY pos) % 2 = 1 AS take
      FROM (
        SELECT *, pos - row_number() OVER (PARTITION BY w, hit ORDER BY pos) AS run
        FROM (
          SELECT *, id IS NOT NULL AND id = best AS hit
          FROM (
            SELECT a.w, a.pos, a.tok, m.id, min(m.id) OVER (PARTITION BY a.w) AS best
            FROM (SELECT w, pos, tok, lead(tok) OVER (PARTITION BY w ORDER BY pos) AS nxt FROM t WHERE NOT done) a
            LEFT JOIN merges m ON m.pair = (a.tok::BIGINT << 20) | a.nxt)))))
  WHERE NOT gone)
SELECT w, list(tok ORDER BY pos) AS ids FROM t WHERE done GROUP BY w ORDER BY w
"""

DECODE = """
SELECT d, string_agg(v.txt, '' ORDER BY pos) AS txt
FROM ids JOIN vocabulary v USING (tok) GROUP BY d
"""


class Codec:
    """The merge table and vocabulary of one file of ranks in a DuckDB of one thread, for one Python worker."""

    def __init__(self, path: str, pattern: str):
        import duckdb

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "300MB"})
        self.con.execute("SET preserve_insertion_order = false")
        pairs, ids = [], []
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    pairs.append(a << 20 | b)
                    ids.append(rank)
        # Byte b is the character b of the decoded text, byte 0 the character 256 (no NUL within SQL text).
        text = [t.decode("latin-1").replace("\0", "Ā") for t in self.ranks]
        self.load("merges", pair=pa.array(pairs, pa.int64()), id=pa.array(ids, pa.int32()))
        self.load("vocabulary", tok=pa.array(self.ranks.values(), pa.int32()), txt=pa.array(text, pa.string()))
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.encode = PartCoder(pattern, self.pieces, PARTS, PIECES)

    def load(self, name: str, **columns: pa.Array) -> None:
        self.con.register("arriving", pa.table(columns))
        self.con.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM arriving")
        self.con.unregister("arriving")

    def pieces(self, pieces: list[str]) -> list[bytes]:
        raw = [p.encode() for p in pieces]
        out = [r.to_bytes(4, "little") if (r := self.ranks.get(b)) is not None else b"" for b in raw]
        todo = [i for i, b in enumerate(raw) if b and not out[i]]
        for query, some in ((ENCODE, [i for i in todo if len(raw[i]) <= LONG]), (ENCODE_LONG, [i for i in todo if len(raw[i]) > LONG])):
            for s in range(0, len(some), LOT):
                lot = some[s : s + LOT]
                for i, ids in zip(lot, self.merged([raw[i] for i in lot], query), strict=True):
                    out[i] = ids
        return out

    def merged(self, raw: list[bytes], query: str) -> list[bytes]:
        size = np.array([len(b) for b in raw])
        within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        k = np.repeat(np.arange(len(raw)), size) << 40 | within
        self.load("pieces", k=pa.array(k), tok=pa.array(self.byte[np.frombuffer(b"".join(raw), np.uint8)]))
        lists = self.con.sql(query).to_arrow_table().column("ids").combine_chunks()
        flat, ends = lists.flatten().to_numpy().astype("<u4").tobytes(), lists.offsets.to_numpy() * 4
        ends = ends - ends[0]
        return [flat[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]

    def decode(self, ids: list[bytes]) -> list[bytes]:
        size = np.array([len(b) // 4 for b in ids], dtype=np.int64)
        if not size.sum():
            return [b""] * len(ids)
        flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
        self.con.register("ids", pa.table({"d": np.repeat(np.arange(len(ids)), size), "pos": np.arange(len(flat)), "tok": flat}))
        got = self.con.sql(DECODE).to_arrow_table()
        self.con.unregister("ids")
        out = [b""] * len(ids)
        for d, txt in zip(got.column("d").to_pylist(), got.column("txt").to_pylist()):
            out[d] = txt.encode("latin-1") if "Ā" not in txt else txt.replace("Ā", "\0").encode("latin-1")
        return out


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def public_ranks(name: str = "byte_bpe_50k.tiktoken") -> tuple[str, str]:
    import public_tokenizers as P

    return P.path(name), P.PATTERN


def _coded(docs: DataFrame, ranks: tuple[str, str], schema: str, row, id_col: str, text_col: str) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(*ranks)
        try:
            for b in batches:
                ids, texts = b.column(0), b.column(1).to_pylist()
                for i, j in slices(texts, CHARS):
                    yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), *row(c, texts[i:j])], names)
        finally:
            c.encode.forget()

    names = [x.split()[0] for x in schema.split(", ")]
    return id_text(docs, id_col, text_col).mapInArrow(task, schema)


def encode(docs: DataFrame, ranks: tuple[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids: the token ids of every text."""

    def row(c: Codec, texts: list[str]) -> list[pa.Array]:
        coded = c.encode(texts)
        ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in coded])]).astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(coded), "<u4").astype(np.int32)))]

    return _coded(docs, ranks or public_ranks(), "doc_id bigint, ids array<int>", row, id_col, text_col)


def decode(tokens: DataFrame, ranks: tuple[str, str] | None = None) -> DataFrame:
    """doc_id, bytes: what the column ``ids`` of ``encode`` stands for (null: no ids)."""
    path, pattern = ranks or public_ranks()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for b in batches:
            for i in range(0, len(b), 1000):
                ids = [np.array(x or [], "<u4").tobytes() for x in b.column(1).slice(i, 1000).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, 1000), pa.array(c.decode(ids), pa.binary())], ["doc_id", "bytes"])

    return tokens.select(F.col("doc_id").cast("bigint"), F.col("ids").cast("array<int>")).mapInArrow(task, "doc_id bigint, bytes binary")


def round_trip(docs: DataFrame, ranks: tuple[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row: encoded, then decoded from the ids."""

    def row(c: Codec, texts: list[str]) -> list[pa.Array]:
        coded = c.encode(texts)
        decoded = c.decode(coded)
        return [
            pa.array([len(x) // 4 for x in coded], pa.int64()),
            pa.array([hashlib.sha256(x).hexdigest() for x in coded]),
            pa.array([hashlib.sha256(x).hexdigest() for x in decoded]),
        ]

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _coded(docs, ranks or public_ranks(), schema, row, id_col, text_col)


@register("op5_byte_bpe")
def op5_byte_bpe(spark, sf_dir) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
