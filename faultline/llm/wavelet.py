"""Token-ID output: one wavelet matrix per shard.

A shard file holds the ids of some thousand whole documents. Plane by plane, from the
highest bit of an id to the lowest, the ids' bits are stored in their current order, and
the ids are then dealt stably into zeros first, ones after. Planes are cut into blocks of
``BLOCK_BITS`` bits, each compressed on its own, with the number of ones before it in a
directory, so ``access``, ``rank``, ``count`` and ``select`` touch a few blocks of the one
compressed file and never unpack it whole.

Spark writes the files: a table in the shared folder, one row a shard, its ``file`` column
the bytes of one shard file. So task commits, retries and any Hadoop store work as usual,
and one shard can be fetched by ``part`` and ``seq`` alone.

Cases: a null text is empty (one id, the end id); a document is never cut, so a very long one is a shard of its
own; repeated rows and equal doc_ids each keep their own entry (ties are ordered by text); null doc_ids come
first; empty tables give empty results; other columns are ignored.
"""
from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.llm.common import as_bytes, written
from faultline.llm.encode import encoder, slices

MAGIC = b"WVM1"
BLOCK_BITS = 1 << 15
SHARD_TOKENS = 1 << 20
#: distinct pieces whose ids a Python worker keeps here, where nothing else takes its memory
CACHE_PIECES = 1_400_000
_HEAD = struct.Struct("<4sIQII")  # magic, bits, ids, documents, first byte of the planes


def build_shard(doc_ids: list, lengths: np.ndarray, ids: np.ndarray, bits: int) -> bytes:
    """The bytes of one shard file. ``lengths``: ids of each document, in order."""
    pack = zstandard.ZstdCompressor(level=1).compress
    docs = pack(np.array([x is not None for x in doc_ids], "u1").tobytes()
                + np.array([x or 0 for x in doc_ids], "<i8").tobytes() + lengths.astype("<u8").tobytes())
    blocks_n = -(-len(ids) // BLOCK_BITS)
    directory, blocks, at = [], [], 0
    for shift in range(bits - 1, -1, -1):
        ones = (ids & np.array(1 << shift, ids.dtype)).astype(bool)
        packed = np.packbits(ones)
        before = 0
        for b in range(blocks_n):
            raw = packed[b * BLOCK_BITS // 8:(b + 1) * BLOCK_BITS // 8]
            small = pack(raw.tobytes())
            small = small if len(small) < len(raw) else raw.tobytes()
            directory.append((before, at, len(small)))
            blocks.append(small)
            at += len(small)
            before += int(np.count_nonzero(ones[b * BLOCK_BITS:(b + 1) * BLOCK_BITS]))
        directory.append((before, at, 0))
        ids = np.concatenate((ids.take(np.flatnonzero(~ones)), ids.take(np.flatnonzero(ones))))
    table = np.array(directory, "<u8").tobytes()
    head = struct.pack("<Q", len(docs)) + docs + table
    return _HEAD.pack(MAGIC, bits, len(ids), len(lengths), _HEAD.size + len(head)) + head + b"".join(blocks)


class Shard:
    """Reads one shard file. Positions count from 0."""

    def __init__(self, data: bytes):
        magic, self.bits, self.n, self.n_docs, self._planes = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a wavelet shard")
        (size,) = struct.unpack_from("<Q", data, _HEAD.size)
        at = _HEAD.size + 8
        self._unpack = zstandard.ZstdDecompressor().decompress
        docs = self._unpack(data[at:at + size])
        here = np.frombuffer(docs, "u1", self.n_docs)
        doc_ids = np.frombuffer(docs, "<i8", self.n_docs, self.n_docs)
        self.doc_ids = [int(x) if h else None for x, h in zip(doc_ids, here)]
        self.lengths = np.frombuffer(docs, "<u8", self.n_docs, 9 * self.n_docs).astype(np.int64)
        per_plane = -(-self.n // BLOCK_BITS) + 1
        self._directory = np.frombuffer(data, "<u8", 3 * per_plane * self.bits, at + size).reshape(self.bits, per_plane, 3)
        self._data = data
        self.zeros = [self.n - int(d[-1, 0]) for d in self._directory]

    def _block(self, plane: int, b: int) -> np.ndarray:
        _, at, size = (int(x) for x in self._directory[plane, b])
        raw = self._data[self._planes + at:self._planes + at + size]
        bits = min(BLOCK_BITS, self.n - b * BLOCK_BITS)
        raw = raw if size == -(-bits // 8) else self._unpack(raw)
        return np.unpackbits(np.frombuffer(raw, "u1"), count=bits)

    def _ones(self, plane: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        b, rest = divmod(i, BLOCK_BITS)
        before = int(self._directory[plane, b, 0])
        return before + int(self._block(plane, b)[:rest].sum()) if rest else before

    def _bit(self, symbol: int, plane: int) -> int:
        return symbol >> (self.bits - 1 - plane) & 1

    def access(self, i: int) -> int:
        """The id at position i."""
        symbol = 0
        for p in range(self.bits):
            bit = int(self._block(p, i // BLOCK_BITS)[i % BLOCK_BITS])
            ones = self._ones(p, i)
            i = self.zeros[p] + ones if bit else i - ones
            symbol = symbol << 1 | bit
        return symbol

    def _range(self, symbol: int, end: int) -> tuple:
        lo, hi = 0, end
        for p in range(self.bits):
            a, b = self._ones(p, lo), self._ones(p, hi)
            lo, hi = (self.zeros[p] + a, self.zeros[p] + b) if self._bit(symbol, p) else (lo - a, hi - b)
        return lo, hi

    def rank(self, symbol: int, end: int) -> int:
        """How often the id occurs before position ``end``."""
        if symbol >> self.bits:
            return 0
        lo, hi = self._range(symbol, end)
        return hi - lo

    def count(self, symbol: int) -> int:
        return self.rank(symbol, self.n)

    def select(self, symbol: int, k: int) -> int:
        """The position of the id's occurrence number k (from 0)."""
        if symbol >> self.bits:
            raise IndexError(k)
        lo, hi = self._range(symbol, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        i = lo + k
        for p in range(self.bits - 1, -1, -1):
            i = self._find(p, i - self.zeros[p], 1) if self._bit(symbol, p) else self._find(p, i, 0)
        return i

    def _find(self, plane: int, k: int, bit: int) -> int:
        """The place of a plane's set (or clear) bit number k."""
        ones = self._directory[plane, :, 0].astype(np.int64)
        before = ones if bit else np.minimum(np.arange(len(ones)) * BLOCK_BITS, self.n) - ones
        b = int(np.searchsorted(before, k, side="right")) - 1
        return b * BLOCK_BITS + int(np.flatnonzero(self._block(plane, b) == bit)[k - int(before[b])])

    def ids(self) -> np.ndarray:
        """All ids: from the last plane up, each deal is undone."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        out = np.zeros(self.n, kind)
        for p in range(self.bits - 1, -1, -1):
            parts = [self._block(p, b) for b in range(self._directory.shape[1] - 1)]
            ones = np.concatenate(parts).view(bool) if parts else np.zeros(0, bool)
            back = np.empty_like(out)
            z = self.zeros[p]
            back[np.flatnonzero(~ones)] = out[:z]
            back[np.flatnonzero(ones)] = out[z:] | kind(1 << (self.bits - 1 - p))
            out = back
        return out


def write_shards(docs: DataFrame, tokenizer: str, end_id: int = 0, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write shards in ascending doc_id order. Returns the
    written table: part, seq (their order is the documents' order), n_docs, n_tokens, file."""

    def shards(batches):
        from pyspark import TaskContext
        part, seq = TaskContext.get().partitionId(), 0
        enc = encoder(tokenizer, keeps_space=True, most=CACHE_PIECES)
        bits = max(1, (max(enc.tokenizer.get_vocab_size(), end_id + 1) - 1).bit_length())
        kind = np.uint16 if bits <= 16 else np.uint32
        end = np.asarray([end_id], "<u4").tobytes()
        held, total = [], 0

        def flush():
            nonlocal seq, total
            ids = np.concatenate([x for _, x in held])
            lengths = np.array([len(x) for _, x in held])
            row = {"part": [part], "seq": [seq], "n_docs": [len(held)], "n_tokens": [total],
                   "file": [build_shard([d for d, _ in held], lengths, ids, bits)]}
            seq, total = seq + 1, 0
            held.clear()
            return pa.RecordBatch.from_pydict(row, schema=_SHARD)

        for batch in batches:
            doc_ids, texts = batch.column("doc_id").to_pylist(), as_bytes(batch.column("text"))
            for a, b in slices([len(x) for x in texts], 4 << 20):
                for doc, ids in zip(doc_ids[a:b], enc.encode([x.decode("utf-8", "replace") for x in texts[a:b]])):
                    held.append((doc, np.frombuffer(ids + end, "<u4").astype(kind)))
                    total += len(held[-1][1])
                    if total >= shard_tokens:
                        yield flush()
        if held:
            yield flush()

    thin = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ordered = thin.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return written(ordered.mapInArrow(shards, "part int, seq int, n_docs long, n_tokens long, file binary"), "wavelet")


_SHARD = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("file", pa.binary())])
_READ = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("place", pa.int32()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def read_documents(shards: DataFrame) -> DataFrame:
    """Every document of written shards: part, seq, place in the shard, doc_id, start (ids of
    all documents before it), n_tokens, ids_crc32. The files' own ids are unpacked for it."""

    def unpack(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard(batch.column("file")[i].as_py())
                ids = shard.ids().astype("<u4")
                ends = np.cumsum(shard.lengths)
                crc = [zlib.crc32(ids[e - n:e]) for e, n in zip(ends, shard.lengths)]
                m = shard.n_docs
                yield pa.RecordBatch.from_arrays([
                    pa.array([batch.column("part")[i].as_py()] * m, pa.int32()), pa.array([batch.column("seq")[i].as_py()] * m, pa.int32()),
                    pa.array(range(m), pa.int32()), pa.array(shard.doc_ids, pa.int64()), pa.array(ends - shard.lengths, pa.int64()),
                    pa.array(shard.lengths, pa.int64()), pa.array(crc, pa.int64())], schema=_READ)

    docs = shards.select("part", "seq", "file").mapInArrow(unpack, "part int, seq int, place int, doc_id long, at long, n_tokens long, ids_crc32 long")
    # ids before each shard: totals of the parts first (one row a writing task), then within each part
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("ids"))
    parts = parts.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("before_part"))
    within = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_tokens")
    starts = shards.select("part", "seq", within.alias("in_part")).join(parts, "part")
    return docs.join(starts, ["part", "seq"]).select(
        "part", "seq", "place", "doc_id", (F.col("before_part") + F.col("in_part") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
