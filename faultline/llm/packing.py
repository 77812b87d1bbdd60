"""Best-fit packing: hierarchical residual packing.

Each partition packs its own pieces best-fit (longest first, each into the fullest bin
that still takes it) and emits the nearly full bins. Underfull bins go on as items: the
next round deals them into fewer partitions, which best-fit whole bins into bins. The tree
ends with one partition, or as soon as a round saves under one bin in a hundred: what is left then
doesn't fit together (as when all pieces are longer than half a sequence), so a partition
never holds more than ``ROUND_BINS`` bins and no task grows with the corpus.

Cases: null text is empty (one id, the end id); pieces of exactly ``length`` ids are full
sequences at once; repeated rows are packed each; a null doc_id is kept; an empty table
gives no rows; other columns are ignored.
"""
from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import as_bytes, written
from faultline.llm.encode import encoder, slices

LENGTH = 2048
#: a bin with at most this share of free places is emitted
NEARLY_FULL = 1 / 256
FAN_IN = 8
ROUND_BINS = 200_000

_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
_PLACED = _PIECES.append(pa.field("offset", pa.int64()))
_MEMBER = "struct<doc_id:long,piece:int,start:long,length:long,ids_crc32:long,offset:long>"
_BINS = pa.schema([("sequence_id", pa.int64()), ("fill", pa.int64()), ("full", pa.bool_()), ("members", pa.list_(pa.struct(_PLACED)))])
_BINS_DDL = f"sequence_id long, fill long, full boolean, members array<{_MEMBER}>"


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, length: int = LENGTH) -> DataFrame:
    """Every document's pieces of at most ``length`` ids: doc_id, piece, start, length, ids_crc32."""

    def cut(batches):
        end = np.asarray([end_id], "<u4").tobytes()
        enc = encoder(tokenizer, keeps_space=False)
        for batch in batches:
            doc_ids, texts = batch.column("doc_id").to_pylist(), as_bytes(batch.column("text"))
            for a, b in slices([len(x) for x in texts], 4 << 20):
                rows = []
                for doc, ids in zip(doc_ids[a:b], enc.encode([x.decode("utf-8", "replace") for x in texts[a:b]])):
                    ids += end
                    rows += [(doc, i, i * length, len(part) // 4, zlib.crc32(part)) for i, part in
                             enumerate(ids[at:at + 4 * length] for at in range(0, len(ids), 4 * length))]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _PIECES.types)], schema=_PIECES)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(sizes: np.ndarray, length: int) -> list:
    """Best-fit decreasing; the bins as lists of indices. Open bins are kept by free places,
    with one bit for every number of places some bin has free."""
    by_free: list = [[] for _ in range(length + 1)]
    some, bins = 0, []
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = some >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            own = by_free[free].pop()
            if not by_free[free]:
                some &= ~(1 << free)
            own.append(i)
        else:
            free, own = length, [i]
            bins.append(own)
        left = free - size
        if left:
            by_free[left].append(own)
            some |= 1 << left
    return bins


def _merged(table: pa.Table, first: int, least: int, length: int):
    """Best-fit of the items (fill, members) of one table, as batches of bins."""
    sizes = table.column("fill").to_numpy()
    bins = best_fit(sizes, length)
    members = table.column("members").combine_chunks()
    starts, flat = members.offsets.to_numpy(), members.values
    for at in range(0, len(bins), 2000):
        own = bins[at:at + 2000]
        counts = np.array([sum(int(starts[i + 1] - starts[i]) for i in b) for b in own])
        taken = flat.take(pa.array(np.concatenate([np.arange(starts[i], starts[i + 1]) for b in own for i in b])))
        ends = np.cumsum(counts)
        lengths = taken.field("length").to_numpy()
        offset = np.cumsum(lengths) - lengths
        offset -= np.repeat(offset[ends - counts], counts)
        columns = [taken.field(i) for i in range(len(_PIECES))] + [pa.array(offset)]
        fills = np.array([int(sizes[b].sum()) for b in own])
        yield pa.RecordBatch.from_arrays([
            pa.array(range(first + at, first + at + len(own)), pa.int64()), pa.array(fills), pa.array(fills >= least),
            pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.StructArray.from_arrays(columns, fields=list(_PLACED)))], schema=_BINS)


def _pack(items: DataFrame, round_no: int, length: int, most: int) -> DataFrame:
    """Best-fit within each partition, at most ``most`` items at a time."""
    least = length - int(length * NEARLY_FULL)

    def pack_part(batches):
        from pyspark import TaskContext
        first = (round_no << 56) | (TaskContext.get().partitionId() << 32)
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= most:
                yield from _merged(pa.Table.from_batches(held), first, least, length)
                first, held, rows = first + rows, [], 0
        if rows:
            yield from _merged(pa.Table.from_batches(held), first, least, length)

    return items.select("fill", "members").mapInArrow(pack_part, _BINS_DDL)


def pack(pieces: DataFrame, length: int = LENGTH, round_bins: int = ROUND_BINS) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32) with sequence_id and offset."""
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    # whole sequences need no bin
    whole = pieces.where(F.col("length") >= length)
    member = F.struct(*columns, F.lit(0).cast("long").alias("offset"))
    items = pieces.where(F.col("length") < length).select(F.col("length").alias("fill"), F.array(member).alias("members"))
    tables = [written(_pack(items, 1, length, round_bins), "packed")]
    open_bins = F.count(F.when(~F.col("full"), 1))
    left, parts = tables[0].agg(open_bins, F.countDistinct(F.shiftright("sequence_id", 32))).first()
    for round_no in range(2, 60):
        parts = max(1, parts // FAN_IN, -(-left // round_bins))
        if not left:
            break
        again = tables[-1].where(~F.col("full")).repartition(parts)
        tables.append(written(_pack(again, round_no, length, round_bins), "packed"))
        made, now = tables[-1].agg(F.count("*"), open_bins).first()
        saved, left = left - made, now
        if parts == 1 or saved * 100 < left and parts == -(-left // round_bins):
            break
    # of every round but the last, the full bins stand; of the last one all
    done = tables[-1]
    for table in tables[:-1]:
        done = done.unionByName(table.where("full"))
    packed = done.select("sequence_id", F.explode("members").alias("m")).select(*[f"m.{c}" for c in columns], "sequence_id", "m.offset")
    return packed.unionByName(whole.select(*columns, F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset")))


def pack_documents(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """Encode, cut and pack ``docs``: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = written(cut_pieces(docs, tokenizer, length=length), "pieces")
    return pack(pieces, length)
