"""N-gram Jaccard join by a count-vector R-tree.

A document's distinct word shingles are hashed into groups; the counts per group are its
point. Two documents share at most the sum over the groups of the smaller count, so that
sum bounds their overlap; pairs whose bound reaches the threshold are verified on their
shingle sets.

The number of groups grows with the set, so that the bound tells long texts apart as well; of two
points the finer one is folded onto the coarser.

A tree over all points cannot prune on its own: points of equally long texts lie around
one centre, closer than the threshold along any single coordinate. So the points are dealt
first by their rarest shingles: of a set of n, the first n - ceil(0.8 n) + 1 in one global
order, of which two linked documents always share one. The order is by frequency, rarest
first, from a count sketch of fixed size (any order is exact, this one keeps buckets small).
Then, with equal sets collapsed into one representative:

1. in every bucket each document is tried against the bucket's smallest doc_id, which links large groups of
   near copies in one pass instead of pair by pair;
2. buckets whose documents are not all connected yet are cut into tree nodes of at most
   ``NODE`` points; nodes know their largest counts, their sizes and whether all their
   points are connected, and a pair of nodes is opened only if its bound can reach the
   threshold and the two are not one component. Surviving pairs of points are verified;
3. components are found over all links.

No bucket, partner or candidate is capped, and no link between different sets is lost:
after step 2 every pair that shares a bucket is linked, ruled out by the bound or the
exact test, or already in one component.

Cases: null text and texts without words have an empty set and no links; with fewer words
than a shingle has, the whole sequence is the one shingle; every row keeps its own set and gives a row, and
rows of one doc_id are one node, linked with whatever any of their texts is linked with; very long texts are hashed
whole; repeated rows and ties are copies of one set; null doc_ids are left out; an
empty table gives no rows; other columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import as_bytes, discard, mix, signed, windows, word_hashes, written
from faultline.llm.encode import slices

SHINGLE = 5
#: links need PERCENT * |union| <= 100 * |intersection|
PERCENT = 80
#: counters of the frequency sketch: its size never depends on the corpus
SKETCH = 1 << 20
SKETCH_CHUNKS = 64
#: points of a tree node
NODE = 512
#: groups of the smallest sets; larger ones have more, in proportion
GROUPS = 64
#: points of many small buckets that one search task takes together
TASK_POINTS = 40_000



def shingle_set(text: bytes, k: int = SHINGLE) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's k-word shingles."""
    words = text.lower().split()  # on bytes: A-Z only, and ASCII white space
    if not words:
        return np.empty(0, np.uint64)
    hashes = word_hashes(words)
    return np.unique(windows(hashes, min(k, len(words))) + np.uint64(max(0, k - len(words))))


def least_overlap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Shared shingles that two sets of these sizes need: 100 i >= P (a + b - i)."""
    return -(-(PERCENT * (a + b)) // (100 + PERCENT))


def grade(n: np.ndarray) -> np.ndarray:
    """log2 of the number of groups of sets of these sizes: one group for some 8 to 16 shingles, so that
    the counts tell long texts apart as well as short ones. Sets that can link differ by one grade at most."""
    return np.maximum(GROUPS.bit_length() - 1, np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64) - 3)


def point(s: np.ndarray) -> np.ndarray:
    """Counts per group of a set."""
    groups = 1 << int(grade(np.array([len(s)]))[0])
    return np.bincount(((s >> np.uint64(32)) & np.uint64(groups - 1)).astype(np.int64), minlength=groups).astype(np.uint32)


def folded(at: np.ndarray) -> np.ndarray:
    """Points of the next lower grade: two groups become one."""
    half = at.shape[1] // 2
    return at[:, :half] + at[:, half:]


def points(sets: list) -> np.ndarray:
    """Points of some sets, one row each, in the groups of the smallest."""
    rows = [point(s)[None, :] for s in sets]
    least = min((r.shape[1] for r in rows), default=GROUPS)
    for i in range(len(rows)):
        while rows[i].shape[1] > least:
            rows[i] = folded(rows[i])
    return np.concatenate(rows) if rows else np.zeros((0, GROUPS), np.uint32)


_SETS = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("chunk", pa.int32()), ("counts", pa.binary())])


def _digests(docs: DataFrame) -> DataFrame:
    """One pass over the texts: doc_id, n_shingles and a 128-bit digest of every set, and (in rows with a
    chunk) each task's own counts of how many documents the ``SKETCH`` shingle classes occur in."""
    size = SKETCH // SKETCH_CHUNKS

    def digest(batches):
        own = np.zeros(SKETCH, np.int64)
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), as_bytes(batch.column("text"))
            n, d1, d2 = [], [], []
            for a, b in slices([len(t) for t in texts], 8 << 20):
                sets = [shingle_set(t) for t in texts[a:b]]
                for s in sets:
                    n.append(len(s))
                    d1.append(int(signed(mix(s).sum(dtype=np.uint64).reshape(1))[0]) if len(s) else 0)
                    d2.append(int(signed(mix(s * np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64).reshape(1))[0]) if len(s) else 0)
                own += np.bincount((np.concatenate(sets) & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
            none = pa.nulls(len(ids))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                                              none.cast(pa.int32()), none.cast(pa.binary())], schema=_SETS)
        some = [c for c in range(SKETCH_CHUNKS) if own[c * size:(c + 1) * size].any()]
        none = pa.nulls(len(some)).cast(pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(some, pa.int32()),
                                          pa.array([own[c * size:(c + 1) * size].astype("<i8").tobytes() for c in some], pa.binary())], schema=_SETS)

    return docs.select("doc_id", "text").mapInArrow(digest, "doc_id long, n_shingles long, d1 long, d2 long, chunk int, counts binary")


def _sketch(parts: DataFrame) -> np.ndarray:
    """How many documents each shingle class occurs in, from the tasks' counts: what is shuffled
    and collected has a fixed size a task and in all."""
    size = SKETCH // SKETCH_CHUNKS

    def add(batches):
        total = np.zeros((SKETCH_CHUNKS, size), np.int64)
        for batch in batches:
            for chunk, c in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()):
                total[chunk] += np.frombuffer(c, "<i8")
        some = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([total[c].tobytes() for c in some], pa.binary())], names=["chunk", "counts"])

    ddl = "chunk int, counts binary"
    summed = parts.where("chunk IS NOT NULL").select("chunk", "counts").repartition(SKETCH_CHUNKS, "chunk").mapInArrow(add, ddl)
    out = np.zeros((SKETCH_CHUNKS, size), np.int64)
    for row in summed.collect():  # SKETCH counters
        out[row.chunk] = np.frombuffer(row.counts, "<i8")
    return np.minimum(out.reshape(-1), 2**31 - 1).astype(np.int32)


def _prefixes(docs: DataFrame, sketch: np.ndarray) -> DataFrame:
    """One row for every shingle in a representative's prefix: token, doc_id, n."""
    counts = docs.sparkSession.sparkContext.broadcast(sketch)

    def cut(batches):
        df = counts.value
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), as_bytes(batch.column("text"))
            for a, b in slices([len(t) for t in texts], 4 << 20):
                tokens, docs_, sizes = [], [], []
                for doc, t in zip(ids[a:b], texts[a:b]):
                    s = shingle_set(t)
                    n = len(s)
                    if n:
                        keep = n - -(-PERCENT * n // 100) + 1
                        order = np.lexsort((s, df[(s & np.uint64(SKETCH - 1)).astype(np.int64)]))[:keep]
                        tokens.append(s[order])
                        docs_.append(np.full(keep, doc))
                        sizes.append(np.full(keep, n))
                if tokens:
                    yield pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate(tokens))), pa.array(np.concatenate(docs_)), pa.array(np.concatenate(sizes))], names=["token", "doc_id", "n"])

    return docs.mapInArrow(cut, "token long, doc_id long, n long")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that reach the threshold, by their points first, then by their sets."""

    def verify(batches):
        for batch in batches:
            ta, tb = as_bytes(batch.column("text_a")), as_bytes(batch.column("text_b"))
            keep, last, last_set = [], None, None
            for x, y in zip(ta, tb):
                if y != last:
                    last, last_set = y, shingle_set(y)
                s = shingle_set(x)
                need = -(-(PERCENT * (len(s) + len(last_set))) // (100 + PERCENT))
                keep.append(len(np.intersect1d(s, last_set, assume_unique=True)) >= need)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))

    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(verify, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """node, label (the smallest node reachable) of every node with a link (a, b). Rounds of
    large-star and small-star: every node's neighbours are tied to their smallest, on both
    sides in turn, until the links are stars. Each round is written to the shared folder."""
    a, b = F.col("a"), F.col("b")
    edges = written(links.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "links")
    for _ in range(100):
        # large star: each larger neighbour is tied to the smallest of a node and its neighbours
        both = edges.unionByName(edges.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where(b > a).select(b.alias("a"), F.col("m").alias("b")).distinct()
        # small star: each smaller neighbour and the node itself are tied to the smallest
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(a, b)).alias("a"), F.col("m").alias("b")).where(a != b).distinct()
        now = written(small, "links")
        # done when no node is tied to two, and none that others are tied to is tied itself
        stars = now.groupBy("a").count().where("count > 1").isEmpty() and now.join(now.select(b.alias("a")).distinct(), "a", "left_semi").isEmpty()
        edges = now
        if stars:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
                edges.select(b.alias("node"), b.alias("label")).distinct())
    raise RuntimeError("components did not settle")


def _tree_pairs(buckets: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of one bucket and different components whose bounds reach the threshold.

    ``buckets``: token, doc_id, n, label, size (points of the bucket). A bucket becomes
    ceil(size / NODE) nodes; any two of them meet in one task, which builds their bounding
    counts and opens them only where the bound allows."""
    nodes = F.ceil(F.col("size") / F.lit(NODE)).cast("int")
    own = F.pmod(F.xxhash64("doc_id"), nodes).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("nodes") - 1)).alias("other")
    dealt = buckets.select("token", "doc_id", "n", "label", nodes.alias("nodes"), own.alias("node")).select(
        "token", "doc_id", "n", "label", "node", other).select(
        "token", F.least("node", "other").alias("u"), F.greatest("node", "other").alias("v"), "node", "doc_id", "n", "label")

    def pack(batches):
        for batch in batches:
            texts_ = as_bytes(batch.column("text"))
            for a, b in slices([len(t) for t in texts_], 4 << 20):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array([point(shingle_set(t)).tobytes() for t in texts_[a:b]], pa.binary())], names=["doc_id", "point"])

    vectors = written(texts.join(buckets.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", "text").mapInArrow(
        pack, "doc_id long, point binary"), "points")

    def search(table):
        token, u, v, node, ids, n, label = (table.column(c).to_numpy() for c in ("token", "u", "v", "node", "doc_id", "n", "label"))
        grades, packed = grade(n), table.column("point").to_pylist()

        def counts(some, g):
            return np.frombuffer(b"".join(packed[i] for i in some), np.uint32).reshape(len(some), 1 << g).astype(np.int32)

        order = np.lexsort((v, u, token))
        new = np.flatnonzero((np.diff(token[order]) != 0) | (np.diff(u[order]) != 0) | (np.diff(v[order]) != 0)) + 1
        found = []
        for rows in np.split(order, new):
            one, two = u[rows[0]], v[rows[0]]
            for g in np.unique(grades[rows]).tolist():  # within a grade, and with the next higher one
                same, above = rows[grades[rows] == g], rows[grades[rows] == g + 1]
                own = np.concatenate((same, above))
                at = counts(same, g)
                if len(above):
                    at = np.concatenate((at, folded(counts(above, g + 1))))
                first, second = node[own] == one, node[own] == two
                low = np.arange(len(own)) < len(same)
                ways = [(first & low, second & low if one != two else None)]
                if len(above):
                    ways += [(first & low, second & ~low)] + ([(second & low, first & ~low)] if one != two else [])
                for left, right in ways:
                    got = _open(np.flatnonzero(left), None if right is None else np.flatnonzero(right), at, n[own], label[own])
                    found += [(own[x], own[y]) for x, y in got]
        x = np.concatenate([np.empty(0, np.int64)] + [f[0] for f in found])
        y = np.concatenate([np.empty(0, np.int64)] + [f[1] for f in found])
        pairs = np.unique(np.stack((np.maximum(ids[x], ids[y]), np.minimum(ids[x], ids[y]))), axis=1)
        return pa.table({"a": pairs[0], "b": pairs[1]})

    dealt = written(dealt, "nodes")
    tasks = 1 + dealt.count() // TASK_POINTS
    group = F.pmod(F.xxhash64("token", "u", "v"), F.lit(tasks)).alias("group")
    return dealt.join(vectors, "doc_id").select(group, *dealt.columns, "point").groupBy("group").applyInArrow(search, "a long, b long").distinct()


def _open(left: np.ndarray, right: np.ndarray | None, at: np.ndarray, n: np.ndarray, label: np.ndarray, leaf: int = 32):
    """Descend two nodes at once (right None: the pairs within left). A node's children halve
    it along its widest coordinate; the largest counts of its points bound its overlaps."""
    if right is None:
        if len(left) <= leaf:
            yield from _leaf(left, left, at, n, label, own=True)
            return
        a, b = _halves(left, at)
        yield from _open(a, None, at, n, label, leaf)
        yield from _open(b, None, at, n, label, leaf)
        yield from _open(a, b, at, n, label, leaf)
        return
    if not len(left) or not len(right):
        return
    if label[left[0]] == label[right[0]] and (label[left] == label[left[0]]).all() and (label[right] == label[right[0]]).all():
        return
    bound = np.minimum(at[left].max(0), at[right].max(0)).sum()
    if bound < least_overlap(n[left].min(), n[right].min()):
        return
    if len(left) <= leaf and len(right) <= leaf:
        yield from _leaf(left, right, at, n, label, own=False)
        return
    if len(left) < len(right):
        left, right = right, left
    for half in _halves(left, at):
        yield from _open(half, right, at, n, label, leaf)


def _halves(rows: np.ndarray, at: np.ndarray) -> tuple:
    own = at[rows]
    wide = int(np.argmax(own.max(0) - own.min(0)))
    order = np.argsort(own[:, wide], kind="stable")
    return rows[order[:len(rows) // 2]], rows[order[len(rows) // 2:]]


def _leaf(left, right, at, n, label, own):
    for i, row in enumerate(left.tolist()):
        other = right[i + 1:] if own else right
        other = other[label[other] != label[row]]
        if len(other):
            near = other[np.minimum(at[row], at[other]).sum(1) >= least_overlap(n[row], n[other])]
            if len(near):
                yield np.full(len(near), row), near


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links, itself
    included) of every document of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("doc_id IS NOT NULL")
    found = written(_digests(docs), "sets")
    if found.where("chunk IS NULL").groupBy("doc_id").count().where("count > 1").isEmpty():
        return _classes(docs, found)
    # several rows a doc_id: the rows are joined under numbers of their own, then the doc_ids by their rows
    rows = written(docs.withColumn("row", F.monotonically_increasing_id()), "rows")
    numbered = rows.select(F.col("row").alias("doc_id"), "text")
    linked = _classes(numbered, written(_digests(numbered), "sets")).withColumnRenamed("doc_id", "row")
    linked = written(linked.join(rows.select("row", "doc_id"), "row"), "linked")
    first = linked.groupBy("component_id").agg(F.min("doc_id").alias("b"))
    ties = linked.select("component_id", F.col("doc_id").alias("a")).distinct().join(first, "component_id").select("a", "b")
    named = components(ties).withColumnRenamed("node", "doc_id")
    return linked.join(named, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("label", "doc_id").alias("component_id"))


def _classes(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``near_duplicates`` of rows whose doc_ids differ; ``found``: their digests."""
    sets = found.where("chunk IS NULL").drop("chunk", "counts")
    # copies: one representative a set, the smallest doc_id
    classes = sets.where("n_shingles > 0").groupBy("n_shingles", "d1", "d2").agg(F.min("doc_id").alias("rep"))
    classes = written(classes, "classes")
    sizes = classes.select(F.col("rep").alias("b"), F.col("n_shingles").alias("n_b"))
    texts = docs.join(sizes.select(F.col("b").alias("doc_id")), "doc_id", "left_semi")
    rows = written(_prefixes(texts, _sketch(found)), "prefixes")
    buckets = rows.groupBy("token").agg(F.count("*").alias("size"), F.min("doc_id").alias("first")).where("size > 1")
    shared = written(rows.join(buckets, "token"), "shared")
    discard(rows)
    # 1: everybody against the first of the bucket
    stars = shared.where("doc_id != first").select(F.col("doc_id").alias("a"), F.col("first").alias("b"), "n").distinct()
    stars = stars.join(sizes, "b").where(F.least("n", "n_b") * 100 >= F.greatest("n", "n_b") * PERCENT).select("a", "b")
    first_links = written(_verified(stars, texts), "links")
    known = components(first_links)
    # 2: buckets that still hold more than one component besides their first
    named = shared.where("size > 2 AND doc_id != first").select("token", "doc_id", "n", "size").join(
        known.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("token", "doc_id", "n", "size", F.coalesce("label", "doc_id").alias("label"))
    several = named.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi").select("token")
    near = _tree_pairs(written(named.join(several, "token"), "buckets"), texts)
    final = components(first_links.unionByName(_verified(near, texts)))
    # 3: back to all documents
    named = classes.join(final.withColumnRenamed("node", "rep"), "rep", "left").select("n_shingles", "d1", "d2", F.coalesce("label", "rep").alias("component_id"))
    return sets.join(named, ["n_shingles", "d1", "d2"], "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
