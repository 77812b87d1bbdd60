"""Substring dedup by prefix-partitioned suffix trees.

A word is removed when some window of ``LENGTH`` words that covers it also starts in a
document with a smaller doc_id. The windows are suffixes cut at LENGTH words; equal ones
end in one node at that depth of the corpus's suffix tree. The tree is never built whole:

1. Suffixes are dealt by a sampled prefix: of a window's ``LENGTH - SEED + 1`` seeds (runs
   of SEED words) the one of least hash is its anchor. Equal windows have equal anchors, so
   all suffixes below one node meet under one anchor. Neighbouring windows share an anchor,
   so a document gives one row for every run of windows, about two in LENGTH.
2. Runs of equal content are one class, represented by its smallest document; every other
   member is removed whole. Whole copies of a document are handled as copies at once.
3. Anchors with several classes get a subtree. Anchors with up to ``SUBTREE`` classes are
   put together to memory-sized groups; there the nodes of depth 1, 2, 4, ... and at last
   LENGTH are named from pairs of shallower nodes, and those of depth LENGTH with several documents are
   the repeats. Where an anchor has more classes, its prefix is lengthened to the whole window,
   and Spark's own aggregation finds each node's smallest document.
4. Removed windows are joined to spans of words and cut from the texts.

Cases: null text has no words; texts under LENGTH words keep all; rows of one doc_id never
remove each other; rows with a null doc_id remove nothing and keep all; equal rows get
equal results; an empty table gives no rows; other columns are ignored.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import as_bytes, discard, mix, signed, windows, word_hashes, written

LENGTH = 50
SEED = 8
#: classes of one anchor that a subtree takes; beyond, the prefix is lengthened
SUBTREE = 2000
#: classes of many anchors that one task builds together
TASK_CLASSES = 20_000

_BASE = np.uint64(0x9E3779B97F4A7C15)


def _hashes(words: list) -> np.ndarray:
    return mix(word_hashes(words))


def anchors(hashes: np.ndarray, length: int = LENGTH, seed: int = SEED) -> np.ndarray:
    """The place of the anchor of each window: the leftmost least seed hash in it."""
    seeds = windows(hashes, seed)
    span = length - seed + 1
    at = np.arange(len(seeds))
    have = 1
    while have * 2 <= span:
        left, right = at[:-have], at[have:]
        at = np.where(seeds[left] <= seeds[right], left, right)
        have *= 2
    if have < span:
        left, right = at[:len(at) - (span - have)], at[span - have:]
        at = np.where(seeds[left] <= seeds[right], left, right)
    return at


_POWERS = [np.ones(1, np.uint64)]
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(n: int) -> tuple:
    if len(_POWERS[0]) < n + 1:
        size = 1 << n.bit_length()
        ones = np.ones(1, np.uint64)
        _POWERS[:] = [np.concatenate((ones, np.cumprod(np.full(size, _BASE)))), np.concatenate((ones, np.cumprod(np.full(size, _INVERSE))))]
    return _POWERS


def runs(hashes: np.ndarray, length: int = LENGTH) -> tuple:
    """Runs of windows with one anchor: anchor hash, hash of the run's words, first and last window."""
    at = anchors(hashes, length)
    starts = np.concatenate(([0], np.flatnonzero(np.diff(at)) + 1))
    ends = np.concatenate((starts[1:] - 1, [len(at) - 1]))
    powers, inverse = _powers(len(hashes))[:2]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * powers[:len(hashes)])))
    content = mix((sums[ends + length] - sums[starts]) * inverse[starts])
    return windows(hashes, SEED)[at[starts]], content, starts, ends


_RUN = pa.struct([("anchor", pa.int64()), ("content", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])
_DOC = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("sha256", pa.string()), ("runs", pa.list_(_RUN))])


def _documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, sha256 of the words, runs."""

    def cut(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            n, sha, parts, offsets = [], [], [], [0]
            for doc, text in zip(ids, as_bytes(batch.column("text"))):
                words = text.split()  # on bytes: ASCII white space
                n.append(len(words))
                sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
                found = runs(_hashes(words)) if len(words) >= LENGTH and doc is not None else None
                if found:
                    parts.append(found)
                offsets.append(offsets[-1] + (len(found[0]) if found else 0))
            col = [np.concatenate([p[i] for p in parts]) if parts else np.empty(0, np.uint64) for i in range(4)]
            flat = pa.StructArray.from_arrays([pa.array(signed(col[0])), pa.array(signed(col[1])), pa.array(col[2], pa.int32()), pa.array(col[3], pa.int32())], fields=list(_RUN))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(sha), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)], schema=_DOC)

    return docs.mapInArrow(cut, "doc_id long, n_words long, sha256 string, runs array<struct<anchor:long,content:long,first:int,last:int>>")


_CONTEXT = pa.schema([("class", pa.int64()), ("doc_id", pa.int64()), ("offset", pa.int32()), ("w1", pa.int64()), ("w2", pa.int64()), ("anchor", pa.int64()), ("words", pa.binary())])


def _contexts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The words of the wanted runs: for subtrees one row a run with its word hashes, for
    lengthened prefixes one row a window. ``wanted``: doc_id, text_key, runs (class, anchor,
    first, last, long)."""

    def read(batches):
        for batch in batches:
            rows = []
            for doc, text, key, asked in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "text_key", "runs"))):
                words = text.encode().split()
                if hashlib.sha256(b" ".join(words)).hexdigest() != key:
                    continue  # another row of this doc_id
                hashes = _hashes(words)
                for r in asked:
                    own = hashes[r["first"]:r["last"] + LENGTH]
                    if r["long"]:
                        w1, w2 = signed(windows(own, LENGTH)), signed(windows(mix(own * _BASE), LENGTH))
                        rows += [(r["class"], doc, i, int(x), int(y), None, None) for i, (x, y) in enumerate(zip(w1, w2))]
                    else:
                        rows.append((r["class"], doc, 0, None, None, r["anchor"], own.tobytes()))
            columns = list(zip(*rows)) or [[]] * len(_CONTEXT)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _CONTEXT.types)], schema=_CONTEXT)

    joined = docs.join(wanted, "doc_id").select("doc_id", "text", "text_key", "runs")
    return joined.mapInArrow(read, "class long, doc_id long, offset int, w1 long, w2 long, anchor long, words binary")


def deep_nodes(words: np.ndarray, sizes: np.ndarray, length: int = LENGTH) -> tuple:
    """Suffix-tree nodes at depth ``length`` of several strings, given end to end: for every
    place whether a window starts there, and its node. Depth 2d is named from pairs at depth d."""
    ends = np.repeat(np.cumsum(sizes), sizes)
    place = np.arange(len(words))
    node = np.unique(words, return_inverse=True)[1].astype(np.int64)
    depth = 1
    while depth < length:
        step = min(depth, length - depth)
        mate = np.minimum(place + step, len(words) - 1)
        node = np.unique(node << 32 | node[mate], return_inverse=True)[1].astype(np.int64)
        depth += step
    return place + length <= ends, node


def _subtrees(contexts: DataFrame, groups: int) -> DataFrame:
    """class, offset of the windows of a class that also start in a smaller document."""

    def build(table):
        out = [np.empty(0, np.int64)], [np.empty(0, np.int32)]
        if table.num_rows:
            raw = table.column("words").to_pylist()
            sizes = np.array([len(x) // 8 for x in raw])
            starts = np.cumsum(sizes) - sizes
            valid, node = deep_nodes(np.frombuffer(b"".join(raw), np.uint64), sizes)
            owner = np.repeat(np.arange(len(raw)), sizes)
            docs = table.column("doc_id").to_numpy()[owner]
            least = np.full(int(node.max()) + 1, np.iinfo(np.int64).max)
            np.minimum.at(least, node[valid], docs[valid])
            again = np.flatnonzero(valid & (least[node] < docs))
            out = [table.column("class").to_numpy()[owner[again]]], [(again - starts[owner[again]]).astype(np.int32)]
        return pa.table({"class": pa.array(np.concatenate(out[0]), pa.int64()), "offset": pa.array(np.concatenate(out[1]), pa.int32())})

    group = F.pmod(F.xxhash64("anchor"), F.lit(groups)).alias("group")
    return contexts.where("words IS NOT NULL").select(group, "class", "doc_id", "words").groupBy("group").applyInArrow(build, "class long, offset int")


def repeated_spans(docs: DataFrame, documents: DataFrame) -> DataFrame:
    """doc_id, text_key, spans (array of [start, end) in words, may overlap) to remove.
    ``documents`` as ``_documents`` gives them; copies of whole documents have one span."""
    reps = documents.where("n_words >= 50 AND doc_id IS NOT NULL".replace("50", str(LENGTH))).groupBy("sha256").agg(F.min("doc_id").alias("doc_id"))
    own = documents.join(reps, ["sha256", "doc_id"], "left_semi").dropDuplicates(["sha256", "doc_id"])
    rows = written(own.select("doc_id", F.col("sha256").alias("text_key"), F.explode("runs").alias("r")).select("doc_id", "text_key", "r.*"), "runs")
    same = ["anchor", "content"]
    # a run's content has a length as well, but equal hashes of unequal runs don't happen in one anchor
    classes = rows.groupBy(*same).agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    classes = written(classes, "classes")
    per_anchor = classes.groupBy("anchor").agg(F.count("*").alias("classes"), F.min("least").alias("lo"), F.max("most").alias("hi")).where("lo < hi")
    found = written(rows.join(classes.join(per_anchor, "anchor").select(*same, "least", "classes"), same).select(
        F.xxhash64("anchor", "content").alias("class"), "anchor", "doc_id", "text_key", "first", "last", "least", "classes"), "found")
    # the smallest member of each class of an anchor with several goes into the trees
    heads = found.where("doc_id = least AND classes > 1")
    one = heads.groupBy("class", "anchor", "doc_id", "classes").agg(F.min(F.struct("text_key", "first", "last")).alias("x"))
    member = F.struct("class", "anchor", "x.first", "x.last", (F.col("classes") > SUBTREE).alias("long"))
    wanted = one.groupBy("doc_id", F.col("x.text_key").alias("text_key")).agg(F.collect_list(member).alias("runs"))
    contexts = written(_contexts(docs, wanted), "contexts")
    groups = 1 + contexts.where("words IS NOT NULL").count() // TASK_CLASSES
    long = contexts.where("words IS NULL").select("class", "doc_id", "offset", "w1", "w2")
    least = long.groupBy("w1", "w2").agg(F.min("doc_id").alias("least"))
    hot = long.join(least, ["w1", "w2"]).where("doc_id > least").select("class", "offset")
    windows_again = written(_subtrees(contexts, groups).unionByName(hot), "windows")
    discard(contexts)
    again = windows_again.groupBy("class").agg(F.collect_list("offset").alias("offsets"))
    span = lambda a, b: F.struct(a.cast("long").alias("start"), b.cast("long").alias("end"))
    whole = found.where("doc_id > least").select("doc_id", "text_key", F.array(span(F.col("first"), F.col("last") + LENGTH)).alias("spans"))
    part = found.where("doc_id = least AND classes > 1").join(again, "class").select(
        "doc_id", "text_key", F.transform("offsets", lambda o: span(F.col("first") + o, F.col("first") + o + LENGTH)).alias("spans"))
    return whole.unionByName(part).groupBy("doc_id", "text_key").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def keep_mask(n: int, spans: list) -> np.ndarray:
    """Which of n words lie in no span."""
    edge = np.zeros(n + 1, np.int64)
    for s in spans:
        edge[s["start"]] += 1
        edge[s["end"]] -= 1
    return np.cumsum(edge)[:n] == 0


_CUT = pa.schema([("doc_id", pa.int64()), ("text_key", pa.string()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())])


def cut_spans(docs: DataFrame, spans: DataFrame, with_text: bool = True) -> DataFrame:
    """doc_id, text_key, n_removed, kept_sha256, kept (the words that stay, by one space) of
    the documents that have spans."""

    def cut(batches):
        for batch in batches:
            rows = []
            for doc, text, key, own in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "text_key", "spans"))):
                words = text.encode().split()
                if hashlib.sha256(b" ".join(words)).hexdigest() == key:
                    keep = keep_mask(len(words), own)
                    kept = b" ".join(w for w, k in zip(words, keep) if k)
                    rows.append((doc, key, len(words) - int(keep.sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace") if with_text else None))
            columns = list(zip(*rows)) or [[]] * len(_CUT)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _CUT.types)], schema=_CUT)

    return docs.join(spans, "doc_id").select("doc_id", "text", "text_key", "spans").mapInArrow(
        cut, "doc_id long, text_key string, n_removed long, kept_sha256 string, kept string")


def dedup(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept of every row of ``docs`` (doc_id, text).
    kept is null where nothing is removed (the text stays as it is) and without ``with_text``."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    documents = written(_documents(docs), "documents")
    spans = written(repeated_spans(docs.where("text IS NOT NULL"), documents), "spans")
    cut = cut_spans(docs.where("text IS NOT NULL"), spans, with_text).dropDuplicates(["doc_id", "text_key"])
    first = documents.where(f"n_words >= {LENGTH} AND doc_id IS NOT NULL").groupBy("sha256").agg(F.min("doc_id").alias("first"))
    none = hashlib.sha256(b"").hexdigest()
    copy = F.col("doc_id") > F.col("first")
    base = documents.select("doc_id", "n_words", "sha256").join(first, "sha256", "left")
    cut = cut.withColumnRenamed("text_key", "sha256")
    return base.join(cut, ["doc_id", "sha256"], "left").select(
        "doc_id", "n_words", F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(none)).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
        F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept"))
