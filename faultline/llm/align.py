"""Alignment of two tokenizers' tokens over the same bytes, in Arrow inside the tasks.

A is a byte-level BPE over blank + text, B a piece BPE with byte fallback over text (it puts
the blank itself), so both cut the same bytes. A batch of documents is one list array of ids
a side: flattened, with parent indices, the ids' byte lengths are summed up along the
documents, and the ends of A and B meet in a hash join on (document, end). As a document's bytes
begin where the former's end, the running end within the batch is that key in one number.
Rows of the full outer join in order of their end are the links (each stretch between two
ends lies in one token of A and one of B), those with both sides the ends of groups.

Counts: every batch counts the documents of each id pair (``Table.group_by``), Spark sums these
partial counts over the corpus, takes each A id's highest, and hands every batch the counts of
its own pairs back. So what is shuffled are the distinct pairs of a batch, not those of a document,
and nothing is broadcast. Batches are written before they are used: a batch's
name is its task and place, and a lost executor can't change it.

Cases: null and empty texts, and texts whose joined bytes on either side differ from blank + text
(a U+2581 in it, say), have no tokens: zeros and an empty digest. The strings of special
tokens are plain text. Very long texts are one batch of their own, whole. Repeated rows are
counted each; a null doc_id is a document like any other; an empty table gives no rows; other
columns are ignored."""
from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.llm.common import written
from faultline.llm.encode import Encoder, slices

#: distinct pieces whose ids a Python worker keeps for each side
CACHE_PIECES = 600_000
#: bytes of text of one join, and of one batch of counts
JOIN_BYTES, BATCH_BYTES = 256 << 10, 16 << 20


class PlainBytes(Encoder):
    """A byte-level tokenizer that takes the strings of special tokens as plain text."""

    def __init__(self, path: str):
        super().__init__(path, keeps_space=True, most=CACHE_PIECES)
        self.tokenizer.encode_special_tokens = True
        self.added = []

    def token_bytes(self) -> list:
        """The bytes of every id: the entry's characters stand for one byte each."""
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in shown]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}
        out = [b""] * self.tokenizer.get_vocab_size()
        for entry, i in self.tokenizer.get_vocab().items():
            out[i] = bytes(byte[c] for c in entry) if all(c in byte for c in entry) else entry.encode()
        return out


class Pieces:
    """A piece tokenizer. No piece holds a blank after another character (checked on the
    file), so texts are cut before runs of blanks; where no piece joins a letter and another
    character either, also between those. Each distinct part is encoded once."""

    _LETTER = r"[^\W\d_²]"

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        m = self.model
        self.pieces = [m.id_to_piece(i) for i in range(m.get_piece_size())]
        plain = [p for i, p in enumerate(self.pieces) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i))]
        if any("▁" in p.lstrip("▁") for p in plain):
            self.cut = None
        elif any(re.search(f"{self._LETTER}(?!{self._LETTER})[^▁]|(?!{self._LETTER})[^▁]{self._LETTER}", p) for p in plain):
            self.cut = re.compile(" +[^ ]*|[^ ]+")
        else:
            self.cut = re.compile(f" *{self._LETTER}+| *(?:(?!{self._LETTER})[^ ])+| +")
        # an input opens with a blank of the model's own: a part that has none is read behind a newline
        self.lead = m.encode("\n")
        self.blank = m.piece_to_id("▁")
        self.known: dict[str, bytes] = {}

    def _learn(self, new: list) -> None:
        asked = [p[1:] if p[0] == " " else "\n" + p for p in new]
        for part, own, ids in zip(new, asked, self.model.encode(asked, num_threads=1)):
            ids = ids if part[0] == " " else ids[len(self.lead):]
            self.known[part] = np.asarray(ids if own else [self.blank], "<u4").tobytes()

    def encode(self, texts: list) -> list:
        """Ids of every text as little-endian uint32 bytes."""
        if self.cut is None:
            return [np.asarray(x, "<u4").tobytes() for x in self.model.encode(texts, num_threads=1)]
        if len(self.known) > CACHE_PIECES:
            self.known.clear()
        cut = [self.cut.findall(" " + x) if x else [] for x in texts]
        self._learn(list(set().union(*cut).difference(self.known)))
        get = self.known.__getitem__
        return [b"".join(map(get, parts)) for parts in cut]

    def token_bytes(self) -> list:
        m = self.model
        return [bytes([int(p[3:5], 16)]) if m.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(self.pieces)]


class Side:
    """Ids, their bytes and their decimal texts of one tokenizer."""

    def __init__(self, tokenizer, inner: str, last: str):
        self.tokenizer = tokenizer
        entries = tokenizer.token_bytes()
        self.size = len(entries)
        self.bytes = pa.array(entries, pa.binary())
        self.lengths = pa.array([len(x) for x in entries], pa.int64())
        self.texts = [f"{i}{inner}" for i in range(self.size)] + [f"{i}{last}" for i in range(self.size)]

    def lists(self, texts: list) -> pa.ListArray:
        """A list of ids for every text."""
        raw = self.tokenizer.encode(texts)
        ends = np.cumsum([0] + [len(x) >> 2 for x in raw])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(raw), "<u4").astype(np.int32)))

    def equal(self, ids: pa.ListArray, wanted: list) -> np.ndarray:
        """Whether each text's tokens give its bytes."""
        joined = pc.take(self.bytes, ids.flatten())
        data = memoryview(joined.buffers()[2] or b"")
        at = np.frombuffer(joined.buffers()[1], np.int32, len(joined) + 1)[ids.offsets.to_numpy()] if len(joined) else np.zeros(len(wanted) + 1, int)
        return np.fromiter((bytes(data[a:b]) == w for a, b, w in zip(at[:-1].tolist(), at[1:].tolist(), wanted)), bool, len(wanted))


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = Side(PlainBytes(path_a), ",", "|"), Side(Pieces(path_b), ",", ";")
        self.texts = pa.array(self.a.texts + self.b.texts, pa.binary())

    def align(self, texts: list) -> tuple:
        """(number of tokens of A, of B, groups, links: an array each; the group text of every
        document; a table of doc, pair, times) of some documents."""
        ids_a, ids_b = self.a.lists([" " + x if x else "" for x in texts]), self.b.lists(texts)
        wanted = [b" " + x.encode() if x else b"" for x in texts]
        right = self.a.equal(ids_a, wanted) & self.b.equal(ids_b, wanted)
        if not right.all():  # a text without tokens is an empty list
            ids_a, ids_b = (pc.if_else(pa.array(right), x, pa.scalar([], x.type)) for x in (ids_a, ids_b))
        flat_a, flat_b = pc.list_flatten(ids_a), pc.list_flatten(ids_b)
        doc = pc.list_parent_indices(ids_a).to_numpy()
        ends = [pc.cumulative_sum(pc.take(side.lengths, flat)) for side, flat in ((self.a, flat_a), (self.b, flat_b))]
        left = pa.table({"end": ends[0], "a": pa.array(np.arange(len(flat_a)))})
        right = pa.table({"end": ends[1], "b": pa.array(np.arange(len(flat_b)))})
        links = left.join(right, "end", join_type="full outer", use_threads=False).sort_by("end").combine_chunks()
        own_a, own_b = pc.is_valid(links["a"]).to_numpy(), pc.is_valid(links["b"]).to_numpy()
        at_a, at_b = (pc.fill_null_backward(links[c]).to_numpy() for c in "ab")
        both = own_a & own_b
        doc = doc[at_a] if len(at_a) else np.zeros(0, np.int64)
        n = len(texts)
        n_a, n_b = pc.list_value_length(ids_a).to_numpy(), pc.list_value_length(ids_b).to_numpy()
        pairs = pa.table({"doc": doc, "pair": flat_a.to_numpy().astype(np.int64)[at_a] * self.b.size + flat_b.to_numpy()[at_b]})
        pairs = pairs.group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
        return (n_a, n_b, np.bincount(doc[both], minlength=n), np.bincount(doc, minlength=n),
                self._groups(flat_a.to_numpy(), flat_b.to_numpy(), own_a, own_b, both, at_a[both], at_b[both], n_a + n_b), pairs)

    def _groups(self, flat_a, flat_b, own_a, own_b, both, last_a, last_b, sizes) -> list:
        """Each document's groups as text: a token's place is behind its own side's tokens
        and the other side's tokens of all earlier groups."""
        group = np.cumsum(both) - both
        before_b = np.concatenate(([0], last_b + 1))
        codes = np.empty(len(flat_a) + len(flat_b), np.int32)
        codes[np.arange(len(flat_a)) + before_b[group[own_a]]] = flat_a + self.a.size * both[own_a]
        codes[np.arange(len(flat_b)) + (last_a + 1)[group[own_b]]] = flat_b + 2 * self.a.size + self.b.size * both[own_b]
        shown = pc.take(self.texts, pa.array(codes))
        at = np.frombuffer(shown.buffers()[1], np.int32, len(codes) + 1)[np.cumsum(np.concatenate(([0], sizes)))] if len(codes) else np.zeros(len(sizes) + 1, int)
        data = memoryview(shown.buffers()[2] or b"")
        return [data[a:b - 1] if b > a else data[a:a] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


_ALIGNERS: dict = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One per Python worker and pair of files."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


_BATCH = pa.schema([("batch", pa.int64()), ("pairs", pa.list_(pa.int64())), ("holders", pa.list_(pa.int32())), ("ends", pa.binary()), ("places", pa.binary()), ("times", pa.binary()),
                    ("doc_id", pa.list_(pa.int64())), ("n_a", pa.list_(pa.int64())), ("n_b", pa.list_(pa.int64())), ("n_groups", pa.list_(pa.int64())),
                    ("n_links", pa.list_(pa.int64())), ("groups_sha256", pa.list_(pa.string())), ("groups", pa.list_(pa.string()))])
_BATCH_DDL = ("batch long, pairs array<long>, holders array<int>, ends binary, places binary, times binary, doc_id array<long>, n_a array<long>, n_b array<long>, "
              "n_groups array<long>, n_links array<long>, groups_sha256 array<string>, groups array<string>")
_DOC = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]


def _packed(x: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(x, np.int32).tobytes(), codec="lz4_raw", asbytes=True)


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(raw, 4 * n, codec="lz4_raw", asbytes=True), np.int32) if n else np.zeros(0, np.int32)


def batches_of(docs: DataFrame, path_a: str, path_b: str, with_groups: bool = False) -> DataFrame:
    """Written batches of aligned documents: each with its distinct id pairs, the number of
    its documents that hold each, and every document's pairs by their place among those."""

    def run(batches):
        from pyspark import TaskContext
        pa.set_cpu_count(1)
        tool = aligner(path_a, path_b)
        part, seq, size = TaskContext.get().partitionId(), 0, 0
        held: list = []

        def flush():
            nonlocal seq, size
            table = pa.concat_tables([x[-1] for x in held]).combine_chunks()
            coded = pc.dictionary_encode(table["pair"].combine_chunks())
            counts = pa.table({"place": coded.indices}).group_by("place", use_threads=False).aggregate([([], "count_all")])
            holders = np.zeros(len(coded.dictionary), np.int32)
            holders[counts["place"].to_numpy()] = counts["count_all"].to_numpy()
            order = np.argsort(table["doc"].to_numpy(), kind="stable")
            n_docs = sum(len(x[0]) for x in held)
            cols = {"batch": (part << 32) + seq, "pairs": coded.dictionary, "holders": holders,
                    "ends": _packed(np.cumsum(np.bincount(table["doc"].to_numpy(), minlength=n_docs))),
                    "places": _packed(coded.indices.to_numpy()[order]), "times": _packed(table["count_all"].to_numpy()[order])}
            for i, name in enumerate(("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups")):
                cols[name] = [y for x in held for y in x[i]]
            seq, size = seq + 1, 0
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) if f.name in ("batch", "ends", "places", "times") else
                                               pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v, f.type.value_type)) for f, v in zip(_BATCH, cols.values())], schema=_BATCH)

        for batch in batches:
            doc_ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            lengths = [x or 0 for x in pc.binary_length(texts).to_pylist()]
            for a, b in slices(lengths, JOIN_BYTES):
                n_a, n_b, groups, links, shown, pairs = tool.align([x or "" for x in texts.slice(a, b - a).to_pylist()])
                before = sum(len(x[0]) for x in held)
                pairs = pairs.set_column(pairs.column_names.index("doc"), "doc", pa.array(pairs["doc"].to_numpy() + before))
                held.append((doc_ids[a:b], n_a.tolist(), n_b.tolist(), groups.tolist(), links.tolist(), [hashlib.sha256(x).hexdigest() if len(x) else "" for x in shown],
                             [bytes(x).decode() for x in shown] if with_groups else [None] * len(shown), pairs))
                size += sum(lengths[a:b])
                if size >= BATCH_BYTES:
                    yield flush()
        if held:
            yield flush()

    thin = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return written(thin.mapInArrow(run, _BATCH_DDL), "align")


def pair_counts(batches: DataFrame, size_b: int) -> DataFrame:
    """pair, id_a, count (documents that hold it linked), best (none of its A id's is higher)."""
    counts = batches.select(F.explode(F.arrays_zip("pairs", "holders")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.holders").alias("count"))
    counts = counts.withColumn("id_a", F.expr(f"pair div {size_b}"))
    # at most size_b rows an A id, whatever the corpus
    return counts.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("id_a")))


def align(docs: DataFrame, path_a: str, path_b: str, with_groups: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256, and the groups themselves if asked for."""
    batches = batches_of(docs, path_a, path_b, with_groups)
    counts = pair_counts(batches, Pieces(path_b).model.get_piece_size())
    own = batches.select(F.col("batch").alias("of"), F.posexplode("pairs").alias("place", "pair")).join(counts, "pair").select("of", "place", "count", "best")

    def score(key, rows, found):
        place = found["place"].to_numpy()
        count, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        count[place], best[place] = found["count"].to_numpy(), found["best"].to_numpy().astype(np.int64)
        ends = _unpacked(rows["ends"][0].as_py(), len(rows["doc_id"][0]))
        n = int(ends[-1])
        places, times = _unpacked(rows["places"][0].as_py(), n), _unpacked(rows["times"][0].as_py(), n)
        sums = [np.concatenate(([0], np.cumsum(x[places] * times)))[np.concatenate(([0], ends))] for x in (best, count)]
        cols = {name: rows[name][0].values for name in _DOC if name not in ("n_best", "count_sum")}
        cols |= {"n_best": pa.array(np.diff(sums[0])), "count_sum": pa.array(np.diff(sums[1]))}
        return pa.table({name: cols[name] for name in _DOC})

    ddl = ", ".join(f"{x} {'string' if x.startswith('groups') else 'long'}" for x in _DOC)
    out = batches.drop("pairs", "holders").groupBy("batch").cogroup(own.groupBy("of")).applyInArrow(score, ddl)
    return out if with_groups else out.drop("groups")
