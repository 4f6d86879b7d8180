"""Token-id files: fixed-size id blocks, transposed into planes, each plane compressed with zstandard, with an index.

**Format** (little-endian). ``IDPLANE1``; the blocks; the footer; its length (u64); ``IDPLANE1``. A block holds ``BLOCK``
ids (the last one fewer) as 32-bit integers, transposed into 4 byte planes (byte 0 of all ids, byte 1, ..) or 32 bit
planes (bit 0 of all ids, eight to a byte, ..), each compressed for itself. The footer is zstandard-compressed: bits of a
plane (u32), block size (u32), numbers of blocks, documents and ids (u64 each), then the chunk index -- offset (u64) and
compressed plane lengths (u32 each) of every block -- and the document table: ids (i64), null flags (u8), lengths (u64).
Any id range is read from the footer and the blocks that it touches.

**Jobs.** Documents are range-partitioned by id and each task encodes its range in order and streams it to one file in
the shared folder, under a name of its own that is moved into place when complete; the manifest, a small Parquet table,
lists the files of the tasks that succeeded, so a repeated or lost task leaves no trace. A file's base is the sum of the
ids in the files before it. Reading goes by file, block after block; memory holds one block.

**Encoding.** Texts are cut where the library's pieces surely end; a task gives the library each different part once (up to
``PARTS`` are kept), those that begin with a blank a thousand at a time as one text.

Defined results: null text is empty (only the end id); documents in ascending id, null ids first, equal ids by text hash;
an empty table gives no file and an empty result; other columns aren't read. The query reads the strings of the file's
added tokens in a text as these tokens, like the library's plain call; ``write_tokens`` does so with ``added``.
"""

from __future__ import annotations

import gc
import os
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate, chain
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.llm.common import id_text, table
from riskframe.llm.registry import register
from riskframe.llm.words import PartCoder, slices
from riskframe.session import materialize, scratch_path

MAGIC = b"IDPLANE1"
BLOCK, LEVEL, END = 65_536, 3, 0
#: Characters of a slice, parts and pieces that a task keeps, parts that the library takes at once.
CHARS, PARTS, PIECES, JOINED = 4_000_000, 400_000, 300_000, 1000


def planes(ids: np.ndarray, bits: int) -> list[bytes]:
    """The planes of a block of 32-bit ids: 4 of bytes (``bits`` 8) or 32 of bits (``bits`` 1)."""
    by_byte = ids.astype("<u4").view(np.uint8).reshape(-1, 4).T
    if bits == 8:
        return [row.tobytes() for row in by_byte]
    return [row.tobytes() for row in np.packbits(np.unpackbits(by_byte[:, :, None], axis=2, bitorder="little").transpose(0, 2, 1).reshape(32, -1), axis=1)]


def unplaned(rows: list[bytes], n: int, bits: int) -> np.ndarray:
    """The ids back from their planes."""
    got = np.frombuffer(b"".join(rows), np.uint8)
    if bits == 1:
        flat = np.unpackbits(got.reshape(32, -1), axis=1)[:, :n]
        got = np.packbits(flat.reshape(4, 8, n).transpose(0, 2, 1), axis=2, bitorder="little")
    return np.ascontiguousarray(got.reshape(4, n).T).view("<u4").reshape(-1)


def filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else path.replace("file:/", "file:///", 1))


class IdWriter:
    """Writes one file; a stream of documents' ids as bytes (little-endian unsigned 32-bit)."""

    def __init__(self, path: str, bits: int = 8, block: int = BLOCK, level: int = LEVEL):
        self.fs, self.path = filesystem(path)
        self.temporary = f"{self.path}.{uuid.uuid4().hex}.part"
        self.out = self.fs.open_output_stream(self.temporary)
        self.out.write(MAGIC)
        self.bits, self.block, self.zstd = bits, block, zstandard.ZstdCompressor(level=level)
        self.at, self.waiting, self.n_waiting = len(MAGIC), [], 0
        self.index: list[bytes] = []
        self.docs: list[int | None] = []
        self.lengths: list[int] = []
        self.n_ids = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append(doc_id)
        self.lengths.append(len(ids) // 4)
        self.n_ids += len(ids) // 4
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= 4 * self.block:
            self.flush(last=False)

    def flush(self, last: bool) -> None:
        flat = np.frombuffer(b"".join(self.waiting), "<u4")
        end = len(flat) if last else len(flat) // self.block * self.block
        for i in range(0, end, self.block):
            packed = [self.zstd.compress(p) for p in planes(flat[i : min(end, i + self.block)], self.bits)]
            self.index.append(struct.pack(f"<Q{len(packed)}I", self.at, *map(len, packed)))
            for p in packed:
                self.out.write(p)
                self.at += len(p)
        self.waiting = [flat[end:].tobytes()]
        self.n_waiting = len(self.waiting[0])

    def close(self) -> int:
        """Completes the file and moves it into place; its size in bytes."""
        self.flush(last=True)
        head = struct.pack("<IIQQQ", self.bits, self.block, len(self.index), len(self.docs), self.n_ids)
        ids = np.array([d or 0 for d in self.docs], "<i8").tobytes()
        nulls = np.array([d is None for d in self.docs], np.uint8).tobytes()
        footer = self.zstd.compress(head + b"".join(self.index) + ids + nulls + np.array(self.lengths, "<u8").tobytes())
        self.out.write(footer + struct.pack("<Q", len(footer)) + MAGIC)
        self.out.close()
        self.fs.move(self.temporary, self.path)
        return self.at + len(footer) + 8 + len(MAGIC)


class IdReader:
    """Reads one file by its index."""

    def __init__(self, path: str):
        self.fs, where = filesystem(path)
        self.file = self.fs.open_input_file(where)
        size = self.file.size()
        tail = self.file.read_at(16, size - 16)
        if tail[8:] != MAGIC or self.file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"not a token-id file: {path}")
        n = struct.unpack("<Q", tail[:8])[0]
        raw = zstandard.ZstdDecompressor().decompress(self.file.read_at(n, size - 16 - n))
        self.bits, self.block, blocks, docs, self.n_ids = struct.unpack_from("<IIQQQ", raw)
        at, count = 32, 32 // self.bits
        self.index = np.frombuffer(raw, np.dtype([("at", "<u8"), ("size", "<u4", (count,))]), blocks, at)
        at += self.index.nbytes
        self.docs = np.frombuffer(raw, "<i8", docs, at)
        self.nulls = np.frombuffer(raw, np.uint8, docs, at + 8 * docs)
        self.lengths = np.frombuffer(raw, "<u8", docs, at + 9 * docs).astype(np.int64)

    def read_block(self, i: int) -> np.ndarray:
        at, sizes = int(self.index["at"][i]), self.index["size"][i].tolist()
        raw, out, z = self.file.read_at(sum(sizes), at), [], zstandard.ZstdDecompressor()
        for n in sizes:
            out.append(z.decompress(raw[:n]))
            raw = raw[n:]
        return unplaned(out, min(self.block, self.n_ids - i * self.block), self.bits)

    def read(self, start: int, n: int) -> np.ndarray:
        """The ids from ``start`` on, ``n`` of them, by the blocks that hold them."""
        blocks = range(start // self.block, -(-(start + n) // self.block) if n else start // self.block)
        got = [self.read_block(i) for i in blocks]
        flat = np.concatenate(got) if got else np.zeros(0, "<u4")
        return flat[start - blocks.start * self.block :][:n]

    def pieces(self) -> Iterator[tuple[int, np.ndarray, bool]]:
        """(number of the document, some of its ids, whether they are its last), block after block."""
        i, got, at = -1, np.zeros(0, "<u4"), 0
        for d, left in enumerate(self.lengths.tolist()):
            while left or d < 0:
                if at == len(got):
                    i, at = i + 1, 0
                    got = self.read_block(i)
                some = got[at : at + left]
                at += len(some)
                left -= len(some)
                yield d, some, not left

    def close(self) -> None:
        self.file.close()


def _bytes(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


#: Bytes of ASCII letters; of signs and digits, but for the apostrophe of "don't"; that surely are, or end, no white space.
_LETTER = _bytes((0x41, 0x5A), (0x61, 0x7A))
_SIGN = _bytes((0x21, 0x26), (0x28, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
_INK = _bytes((0x21, 0x7E), (0x80, 0xFF))


def cuts(raw: np.ndarray) -> np.ndarray:
    """Places of UTF-8 bytes before which a byte-level pattern surely ends a piece: between an ASCII letter and a sign or
    digit, and before a blank between two characters that aren't white space. White space beyond ASCII begins with C2,
    E1 9A, E2 80, E2 81 or E3 80; beside characters that do so, also others, there is no cut."""
    if len(raw) < 2:
        return np.zeros(0, np.int64)
    signs = np.flatnonzero(_LETTER[raw[:-1]] & _SIGN[raw[1:]]) + 1
    at = np.flatnonzero(raw == 0x20)
    at = at[(at > 0) & (at < len(raw) - 1)]
    at = at[_INK[raw[at - 1]] & _INK[raw[at + 1]]]
    doubtful = np.zeros(len(at), bool)
    wide = np.flatnonzero((raw[at - 1] >= 0x80) | (raw[at + 1] >= 0x80))
    near = at[wide]
    two = lambda a, b: (a == 0xE2) & ((b == 0x80) | (b == 0x81)) | (a == 0xE3) & (b == 0x80) | (a == 0xE1) & (b == 0x9A)
    byte = lambda i: np.where((i >= 0) & (i < len(raw)), raw[np.clip(i, 0, len(raw) - 1)], 0)
    doubtful[wide] = (byte(near - 2) == 0xC2) | two(byte(near - 3), byte(near - 2)) | (byte(near + 1) == 0xC2) | two(byte(near + 1), byte(near + 2))
    return np.concatenate([signs, at[~doubtful]])


class JoinedCoder:
    """Ids of texts as little-endian unsigned 32-bit integers. Texts are cut where the library's pieces end (``cuts``); Arrow
    finds the different parts and puts the ids together. ``joined``: ids of parts that begin with their only blank, ``encode``
    of any. Up to ``most`` parts are kept."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], joined: Callable[[list[str]], list[bytes]], most: int):
        self.encode, self.joined, self.most = encode, joined, most
        self.known: dict[str, bytes] = {}

    def forget(self) -> None:
        self.known = {}

    def learn(self, parts: list[str]) -> None:
        if len(self.known) > self.most:
            self.known = {}
        blank, other = [], []
        for p in parts:
            if p not in self.known:
                (blank if p[0] == " " and len(p) > 1 and " " not in p[1:] and not p[1].isspace() and not p[-1].isspace() else other).append(p)
        self.known.update(zip(blank, self.joined(blank), strict=True))
        self.known.update(zip(other, self.encode(other), strict=True))

    def __call__(self, texts: list[str]) -> list[bytes]:
        gc.disable()  # many small objects, none in a cycle
        try:
            return self.coded(texts)
        finally:
            gc.enable()

    def coded(self, texts: list[str]) -> list[bytes]:
        whole = pa.array(texts, pa.large_string())
        edge = np.frombuffer(whole.buffers()[1], np.int64)[: len(texts) + 1]
        raw = np.frombuffer(whole.buffers()[2] or b"", np.uint8)[: edge[-1]]
        begins = np.zeros(len(raw) + 1, bool)
        begins[cuts(raw)] = begins[edge] = True
        starts = np.flatnonzero(begins)  # the last one is the end of all
        parts = pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts), whole.buffers()[2] or pa.py_buffer(b""))
        met = parts.dictionary_encode()
        different = met.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.learn(different)
        laid = pa.array(list(map(self.known.__getitem__, different)), pa.large_binary()).take(met.indices)
        _, ends, ids = laid.buffers()
        at = np.frombuffer(ends, np.int64)[np.searchsorted(starts, edge)].tolist() if len(laid) else [0] * len(edge)
        out = memoryview(ids or b"")
        return [bytes(out[a:b]) for a, b in zip(at, at[1:])]


@lru_cache(maxsize=2)
def tokenizer(path: str, pattern: str, added: bool = False) -> Callable[[list[str]], list[bytes]]:
    """Ids of texts as the library gives them. ``added``: strings of the file's added tokens in a text are these tokens,
    as in the library's plain call; else special tokens' strings are ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = not added

    def encode(pieces: list[str]) -> list[bytes]:
        out = []
        for i in range(0, len(pieces), 10_000):
            ids = [e.ids for e in t.encode_batch_fast(pieces[i : i + 10_000], add_special_tokens=False)]
            raw = np.fromiter(chain.from_iterable(ids), "<u4").tobytes()
            ends = [0, *accumulate([4 * len(x) for x in ids])]
            out += [raw[a:b] for a, b in zip(ends, ends[1:])]
        return out

    # Parts that begin with their only blank make one text for the library: as its pieces end before such a blank, the
    # tokens that begin with a blank tell where the next part begins.
    known, vocabulary = t.get_added_tokens_decoder(), t.get_vocab()
    blank = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
    blank[[i for x, i in vocabulary.items() if x.startswith("\u0120") and i not in known]] = True

    def joined(parts: list[str]) -> list[bytes]:
        out = []
        for i in range(0, len(parts), JOINED):
            some = parts[i : i + JOINED]
            ids = np.array(t.encode_batch_fast(["".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = [*(4 * np.flatnonzero(blank[ids])).tolist(), ids.nbytes]
            if len(ends) == len(some) + 1 and ends[0] == 0:
                raw = ids.tobytes()
                out += [raw[a:b] for a, b in zip(ends, ends[1:])]
            else:
                out += encode(some)
        return out

    # Tokens that take in blanks or depend on their neighbours leave no cut that is sure.
    sure = pattern == public_tokenizer()[1] and t.normalizer is None and not any(x.lstrip or x.rstrip or x.single_word or " " in x.content for x in known.values())
    coder = JoinedCoder(encode, joined, PARTS) if sure else PartCoder(pattern, encode, PARTS, PIECES)
    tokens = {x.content: (i, x) for i, x in known.items()} if added else {}
    if not tokens:
        return coder
    # The library cuts a text at its added tokens first, the longest where several start, and each stretch between them
    # is a text of its own. Tokens that take in blanks or depend on their neighbours are left to the library.
    plain = t.normalizer is None and not any(x.lstrip or x.rstrip or x.single_word for _, x in tokens.values())
    cut = re.compile("(" + "|".join(map(re.escape, sorted(tokens, key=len, reverse=True))) + ")")
    ids = {x: struct.pack("<I", i) for x, (i, _) in tokens.items()}

    def coded(texts: list[str]) -> list[bytes]:
        if not plain:
            return encode(texts)
        odd = {i for i, x in enumerate(texts) if any(map(x.__contains__, ids))}
        if not odd:
            return coder(texts)
        split = [cut.split(x) if i in odd else [x] for i, x in enumerate(texts)]
        between = iter(coder([x for s in split for x in s[::2]]))
        return [b"".join([ids[x] if n % 2 else next(between) for n, x in enumerate(s)]) for s in split]

    coded.forget = coder.forget
    return coded


def public_tokenizer(name: str = "byte_bpe_50k.json") -> tuple[str, str]:
    import public_tokenizers as P

    return P.path(name), P.PATTERN


def write_tokens(docs: DataFrame, path: str, vocabulary: tuple[str, str] | None = None, bits: int = 8, id_col: str = "doc_id", text_col: str = "text", added: bool = False) -> DataFrame:
    """Writes the token ids of all documents below ``path``; returns the manifest: file, path, n_docs, n_ids, base.
    ``added``: as for ``tokenizer``."""
    where, pattern = vocabulary or public_tokenizer()
    if "://" not in path and not path.startswith("/"):
        path = path.replace("file:/", "file:///", 1)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, out, no, n = tokenizer(where, pattern, added), None, 0, 0
        end = struct.pack("<I", END)
        try:
            for b in batches:
                if not len(b):
                    continue
                if out is None:
                    no = b.column(2)[0].as_py()
                    name = f"{path}/ids-{no:06d}-{uuid.uuid4().hex[:8]}.bin"
                    out = IdWriter(name, bits)
                ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
                for i, j in slices(texts, CHARS):
                    for doc_id, coded in zip(ids[i:j], coder(texts[i:j]), strict=True):
                        out.add(doc_id, coded + end)
                n += len(b)
        finally:
            coder.forget()
        if out is not None:
            out.close()
            columns = {"file": [no], "path": [name], "n_docs": [n], "n_ids": [out.n_ids]}
            yield pa.RecordBatch.from_pydict(columns, pa.schema([("file", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    make_folder(docs.sparkSession, path)
    # Rows equal in id and text may be cut anywhere: a running number spreads them over several ranges.
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("no")]
    rows = id_text(docs, id_col, text_col).withColumn("no", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text", F.spark_partition_id().alias("file"))
    written = materialize(rows.mapInArrow(task, "file int, path string, n_docs bigint, n_ids bigint"), "token-files")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # one row for each file
    return written.withColumn("base", F.sum("n_ids").over(before) - F.col("n_ids"))


def make_folder(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(where)


def read_tokens(manifest: DataFrame) -> DataFrame:
    """doc_id, start, ids of every document, from the files."""
    return _read(manifest, "doc_id bigint, start bigint, ids array<bigint>", digest=False)


def read_digests(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    return _read(manifest, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint", digest=True)


def _read(manifest: DataFrame, schema: str, digest: bool) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                r = IdReader(path)
                starts = base + np.cumsum(r.lengths) - r.lengths
                value, out, rows = 0, [], []
                for d, some, done in r.pieces():
                    if digest:
                        value = zlib.crc32(some.tobytes(), value)
                    else:
                        out.append(some)
                    if done:
                        ident = None if r.nulls[d] else int(r.docs[d])
                        got = (int(r.lengths[d]), value) if digest else (np.concatenate(out).astype(np.int64),)
                        rows.append((ident, int(starts[d]), *got))
                        value, out = 0, []
                        if len(rows) == 2000:
                            yield batch(rows)
                            rows = []
                if rows:
                    yield batch(rows)
                r.close()

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        kinds = [pa.int64()] * 4 if digest else [pa.int64(), pa.int64(), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    names = [x.split()[0] for x in schema.split(", ")]
    files = max(1, manifest.count())
    return manifest.select("path", "base").repartition(files).mapInArrow(task, schema)


@register("op9_token_files")
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_digests(write_tokens(table(spark, sf_dir, "documents"), scratch_path(spark, "token-ids"), added=True))
