"""Second-order gradient boosting of many models at once.

A model is one (segment, spec): a segment is a value of a column (a zone, a node), a spec one set of
parameters, objective and held-out fold. Rows are binned once and packed into blocks of one segment
(one pass, no shuffle). Growing one tree level is one aggregation for all models: every task sums
gradients and Hessians by (model, tree node, feature, bin) over its blocks, the sums are merged
by model, and the best split of every node comes back. So the number of jobs is rounds x depth,
however many segments, quantiles, trials and folds there are, a hot segment is as many blocks as it
needs, and the driver holds trees only, never rows. Binned rows with equal bins, label, weight and fold are
one cell of their block: trees, scores, gradients and sums are worked out once a cell, only the draw of
``subsample`` is by row. Few features have few cells, at most bins ** features, however many rows there are; where
rows differ, the block keeps them as they are.

Objectives: ``squared``, ``logistic`` and ``pinball``. The pinball gradient is smoothed over a band that
narrows with the rounds and takes the band's constant curvature, so a leaf moves by a bounded step. A leaf's
value is -G / (H + l2) with G shrunk by l1; a split must leave ``child_weight`` of H on each side.
Held-out rows are scored after every round; ``halving`` stops the worse half of the trials.

A null feature always goes left; equal gains take the first feature and the lowest cut; a segment
without training rows has no model.
"""
from __future__ import annotations

from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.session import discard, landed

#: rows of a block; rows a task holds before it writes all it has
BLOCK_ROWS, HELD_ROWS = 16_384, 262_144
#: rows of a block whose rows fall into few cells
CELLED_ROWS = 131_072
#: rounds after which the blocks' scores are written anew
REWRITE = 5
LEAST_BAND = 0.25


@dataclass(frozen=True)
class Spec:
    """Parameters of one model per segment. ``fold``: its rows are held out (``expanding``: and
    those of later folds are not used either). ``trial`` groups specs that differ by fold only."""
    name: str
    objective: str = "squared"
    alpha: float = 0.5
    rounds: int = 100
    rate: float = 0.1
    depth: int = 3
    subsample: float = 1.0
    columns: float = 1.0
    child_weight: float = 1.0
    l1: float = 0.0
    l2: float = 1.0
    fold: int | None = None
    expanding: bool = False
    trial: int = 0
    only: tuple | None = None  # the features it may use
    seed: int = 42


@dataclass
class Tree:
    """A complete binary tree: feature (-1: everything goes left) and bin cut of each inner node, value of each leaf."""
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray


@dataclass
class Boosted:
    """Fitted models, the loss of every round on held-out rows, and split gains."""
    features: list
    edges: list
    specs: list
    base: dict = field(default_factory=dict)     # (segment, spec place) -> first score
    spread: dict = field(default_factory=dict)   # segment -> standard deviation of the label
    trees: dict = field(default_factory=dict)    # (segment, spec place) -> trees
    history: list = field(default_factory=list)  # (segment, spec, trial, fold, round, loss, rows)
    gains: dict = field(default_factory=dict)    # (segment, spec place) -> gain by feature

    def frame(self, spark) -> DataFrame:
        """The models as rows: segment, spec, objective, depth, base, trees."""
        rows = []
        for (segment, s), trees in self.trees.items():
            cuts = [[float(self.edges[f][c]) if f >= 0 else 0.0 for f, c in zip(t.feature, t.cut)] for t in trees]
            rows.append((segment, self.specs[s].name, self.specs[s].objective, self.specs[s].depth, float(self.base[segment, s]),
                         [(t.feature.tolist(), c, t.value.tolist()) for t, c in zip(trees, cuts)]))
        return spark.createDataFrame(rows, MODEL_DDL)

    def importances(self, spark) -> DataFrame:
        """K5: each feature's share of the gain of all splits of a model."""
        rows = [(seg, self.specs[s].name, f, float(g / max(gain.sum(), 1e-300))) for (seg, s), gain in self.gains.items() for f, g in zip(self.features, gain)]
        return spark.createDataFrame(rows, "segment string, spec string, feature string, importance double")

    def history_frame(self, spark) -> DataFrame:
        return spark.createDataFrame(self.history, "segment string, spec string, trial int, fold int, round int, loss double, n long")


MODEL_DDL = "segment string, spec string, objective string, depth int, base double, trees array<struct<feature:array<int>,cut:array<double>,value:array<double>>>"


def score(model: Column, x: Column) -> Column:
    """A model (a struct as a row of ``Boosted.frame``) at the feature array ``x``; the raw score (log odds for ``logistic``)."""
    def leaf(t):
        def down(i, _):
            return F.when(F.coalesce(F.get(x, F.get(t["feature"], i)) <= F.get(t["cut"], i), F.lit(True)), i * 2 + 1).otherwise(i * 2 + 2)
        at = F.aggregate(F.sequence(F.lit(1), model["depth"]), F.lit(0), down)
        return F.get(t["value"], at + 1 - F.pow(F.lit(2.0), model["depth"]).cast("int"))
    return F.aggregate(model["trees"], model["base"], lambda acc, t: acc + leaf(t))


def scored(models: list, x: Column) -> Column:
    """The array of several models' scores at one feature array."""
    return bound(x, lambda v: F.array(*[score(m, v) for m in models]))


def bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it: in lambdas no
    common expression is found."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def attach(df: DataFrame, models: DataFrame, segment: Column, prefix: str = "m_") -> DataFrame:
    """One column per spec with the model of each row's segment (null where it has none)."""
    fields = [c for c in models.columns if c not in ("segment", "spec")]
    names = sorted(r[0] for r in models.select("spec").distinct().collect())
    wide = models.groupBy("segment").agg(*[F.first(F.when(F.col("spec") == n, F.struct(*fields)), ignorenulls=True).alias(prefix + n) for n in names])
    return df.withColumn("_segment", segment).join(wide.withColumnRenamed("segment", "_segment"), "_segment", "left").drop("_segment")


def vector(features: list, values: dict | None = None) -> Column:
    """The feature array, from ``values`` (name -> Column), else from columns of these names."""
    return F.array(*[(F.col(f"`{c}`") if values is None else values[c]).cast("double") for c in features])


# -- in the tasks ------------------------------------------------------------------------

_BLOCK = pa.schema([("segment", pa.string()), ("block", pa.int64()), ("n", pa.int32()), ("bins", pa.binary()), ("y", pa.binary()), ("w", pa.binary()), ("fold", pa.binary()), ("scores", pa.binary()), ("cells", pa.binary())])
_BLOCK_DDL = "segment string, block long, n int, bins binary, y binary, w binary, fold binary, scores binary, cells binary"


def _leaves(bins: np.ndarray, tree_feature, tree_cut, depth: int) -> np.ndarray:
    """The node that each row reaches after ``depth`` levels, counted from 0 within its level."""
    n = bins.shape[1]
    node, rows, flat = np.zeros(n, np.int64), np.arange(n), bins.reshape(-1)
    row_of, cut = np.maximum(tree_feature, 0) * n, np.where(tree_feature >= 0, tree_cut, 255)
    for d in range(depth):
        at = node + ((1 << d) - 1)
        node = 2 * node + (flat[row_of[at] + rows] > cut[at])
    return node


def _band(spread: float, r: int) -> float:
    """Half the width over which the pinball loss is smoothed in round ``r``: wide at first, when residuals
    tell levels apart, then narrow, so that the fit ends near the quantile itself."""
    return max(LEAST_BAND, spread * max(0.25, 2 * 0.8 ** r))


def _gradients(spec: Spec, band: float, y, w, f):
    if spec.objective == "squared":
        return (f - y) * w, w
    if spec.objective == "logistic":
        p = 1 / (1 + np.exp(-np.clip(f, -30, 30)))
        return (p - y) * w, np.maximum(p * (1 - p), 1e-6) * w
    smooth = np.clip(0.5 + (f - y) / (2 * band), 0, 1) - spec.alpha
    return 2 * band * smooth * w, w


def _loss(spec: Spec, y, w, f):
    """What a trial is judged by: the absolute error, for ``logistic`` the log loss."""
    if spec.objective == "logistic":
        return (w * (np.logaddexp(0, f) - y * f)).sum()
    return (w * np.abs(y - f)).sum()


def _cells(bins: np.ndarray, y: np.ndarray, w: np.ndarray, fold: np.ndarray):
    """The first row of each cell and the cell of every row; None where cells are over half the rows. Rows are told
    apart by a hash, and each is then compared with the first of its cell."""
    code = np.zeros(len(y), np.uint64)
    columns = [*bins, y.view(np.uint32), w.view(np.uint32), fold.view(np.uint16)]
    for c in columns:
        code = (code ^ c.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        code ^= code >> np.uint64(29)
    _, first, cell = np.unique(code, return_index=True, return_inverse=True)
    if 2 * len(first) > len(y) or any((c[first[cell]] != c).any() for c in columns):
        return None
    return first, cell.astype(np.uint32)


class _Blocks:
    """Decodes block rows: per cell (or row) bins, label, weight, fold and scores, and the cell of each row or None."""

    def __init__(self, n_features: int, n_specs: int):
        self.shape = n_features, n_specs

    def __call__(self, batches):
        for batch in batches:
            columns = [batch.column(c) for c in batch.schema.names]
            for i in range(batch.num_rows):
                segment, block, n, bins, y, w, fold, scores, cells = (c[i].as_py() for c in columns)
                yield (segment, block, np.frombuffer(bins, np.uint8).reshape(self.shape[0], n), np.frombuffer(y, np.float32).astype(float),
                       np.frombuffer(w, np.float32).astype(float), np.frombuffer(fold, np.int16), np.frombuffer(scores, np.float32).reshape(self.shape[1], n),
                       np.frombuffer(cells, np.uint32) if cells else None)


def _trained(spec: Spec, fold: np.ndarray):
    if spec.fold is None:
        return None
    return fold < spec.fold if spec.expanding else fold != spec.fold


# -- jobs --------------------------------------------------------------------------------

def _edges(df: DataFrame, features: list, bins: int) -> list:
    """At most ``bins`` - 1 cuts per feature, from mergeable quantile sketches over all rows."""
    at = [i / bins for i in range(1, bins)]
    row = df.agg(*[F.percentile_approx(F.col(f"`{c}`"), F.lit(at), 2000).alias(f"e{i}") for i, c in enumerate(features)],
                 *[F.max(f"`{c}`").alias(f"m{i}") for i, c in enumerate(features)]).first()
    return [np.array(sorted({v for v in row[f"e{i}"] or [] if v < row[f"m{i}"]}) or [np.inf]) for i in range(len(features))]


def _packed(df: DataFrame, features: list, edges: list, base: dict, n_specs: int) -> DataFrame:
    """Rows (segment, features, y, w, fold) as binned blocks of one segment each."""

    def run(batches):
        from pyspark import TaskContext
        part, seq, held, total, few = TaskContext.get().partitionId(), 0, {}, 0, {}

        def size_of(segment):
            return CELLED_ROWS if few.get(segment) else BLOCK_ROWS

        def flush(segment):
            nonlocal seq, total
            parts = held.pop(segment)
            columns = [np.concatenate(x, axis=-1) for x in zip(*parts)]
            total -= len(columns[1])
            for a in range(0, len(columns[1]), size_of(segment)):
                own = [c[..., a:a + size_of(segment)] for c in columns]
                found = _cells(*own)
                bins, y, w, fold = own if found is None else [c[..., found[0]] for c in own]
                scores = np.repeat(np.array([base.get((segment, i), 0.0) for i in range(n_specs)], np.float32)[:, None], len(y), axis=1)
                row = [segment, (part << 32) + seq, len(y), *[np.ascontiguousarray(c).tobytes() for c in (bins, y, w, fold, scores)], b"" if found is None else found[1].tobytes()]
                seq += 1
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _BLOCK)], schema=_BLOCK)

        for batch in batches:
            codes = batch.column("segment").dictionary_encode()
            x = np.stack([np.searchsorted(e, np.nan_to_num(batch.column(f"f{i}").to_numpy(zero_copy_only=False), nan=-np.inf), side="left").astype(np.uint8) for i, e in enumerate(edges)])
            y, w, fold = (batch.column(c).to_numpy(zero_copy_only=False).astype(t) for c, t in (("y", np.float32), ("w", np.float32), ("fold", np.int16)))
            of = codes.indices.to_numpy()
            for c, segment in enumerate(codes.dictionary.to_pylist()):
                rows = np.flatnonzero(of == c)
                held.setdefault(segment, []).append((x[:, rows], y[rows], w[rows], fold[rows]))
                total += len(rows)
                n = sum(len(p[1]) for p in held[segment])
                if n >= BLOCK_ROWS and segment not in few:
                    few[segment] = _cells(*(np.concatenate(p, axis=-1) for p in zip(*held[segment]))) is not None
                if n >= size_of(segment):
                    yield from flush(segment)
            if total >= HELD_ROWS:
                for segment in list(held):
                    yield from flush(segment)
        for segment in list(held):
            yield from flush(segment)

    thin = df.select(F.col("segment").cast("string"), *[F.col(f"`{c}`").alias(f"f{i}") for i, c in enumerate(features)],
                     F.col("y").cast("double"), F.col("w").cast("double"), F.col("fold").cast("int"))
    return thin.mapInArrow(run, _BLOCK_DDL)


def _best(sums: np.ndarray, spec: Spec, used: np.ndarray):
    """Best split of every node from [2, node, used feature, bin] sums: feature, cut, gain, and both
    children's values."""
    def value(g, h):
        return -np.sign(g) * np.maximum(np.abs(g) - spec.l1, 0) / (h + spec.l2 + 1e-12)

    def gain_of(g, h):
        return np.maximum(np.abs(g) - spec.l1, 0) ** 2 / (h + spec.l2 + 1e-12)

    g, h = sums.cumsum(axis=-1)
    all_g, all_h = g[:, :1, -1], h[:, :1, -1]
    right_g, right_h = all_g[..., None] - g, all_h[..., None] - h
    gain = gain_of(g, h) + gain_of(right_g, right_h) - gain_of(all_g, all_h)[..., None]
    gain[(h < spec.child_weight) | (right_h < spec.child_weight)] = 0
    flat = gain.reshape(len(gain), -1)
    at = flat.argmax(axis=1)
    nodes = np.arange(len(gain))
    f, c = np.divmod(at, gain.shape[-1])
    found = flat[nodes, at] > 1e-9
    left = np.where(found, value(g[nodes, f, c], h[nodes, f, c]), value(all_g[:, 0], all_h[:, 0]))
    right = np.where(found, value(right_g[nodes, f, c], right_h[nodes, f, c]), 0.0)
    return np.where(found, used[f], -1), np.where(found, c, 0), np.where(found, flat[nodes, at], 0.0), left, right


def fit(df: DataFrame, features: list, specs: list, label: str, segment: str | None = None, weight: str | None = None,
        fold: str | None = None, bins: int = 32, least: dict | None = None, halving: tuple = ()) -> Boosted:
    """Fit every spec for every segment. ``least``: segment prefix -> rows a segment of that prefix needs.
    ``halving``: rounds at which the worse half of the trials of a segment stops."""
    rows = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in features], (F.col(segment) if segment else F.lit("all")).cast("string").alias("segment"),
                     F.col(label).cast("double").alias("y"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"),
                     (F.col(fold).cast("int") if fold else F.lit(0)).alias("fold")).where("y IS NOT NULL AND segment IS NOT NULL")
    rows = landed(rows, "boost-rows")
    out = Boosted(list(features), _edges(rows, features, bins), list(specs))
    alphas = sorted({s.alpha for s in specs})
    stats = rows.groupBy("segment").agg(F.count("*").alias("n"), F.avg("y").alias("mean"), F.coalesce(F.stddev_samp("y"), F.lit(0.0)).alias("sd"), F.percentile_approx("y", F.lit(alphas), 2000).alias("q"))
    for r in stats.collect():  # one row per segment, as many as there are models
        need = max([n for p, n in (least or {}).items() if r["segment"].startswith(p)], default=1)
        if r["n"] < need:
            continue
        out.spread[r["segment"]] = r["sd"]
        for i, s in enumerate(specs):
            p = min(max(r["mean"], 1e-6), 1 - 1e-6) if s.objective == "logistic" else 0.5
            out.base[r["segment"], i] = {"squared": r["mean"], "logistic": float(np.log(p / (1 - p)))}.get(s.objective, r["q"][alphas.index(s.alpha)])
            out.trees[r["segment"], i], out.gains[r["segment"], i] = [], np.zeros(len(features))
    # dealt evenly whatever partitions the rows came in: a block is a small row
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.sparkSession.sparkContext.defaultParallelism)
    blocks = landed(_packed(rows, features, out.edges, out.base, len(specs)).repartition(tasks, "block"), "boost-blocks")
    discard(rows)
    _grow(blocks, out, halving)
    return out


def _grow(blocks: DataFrame, out: Boosted, halving: tuple) -> None:
    n_features, n_bins = len(out.features), max(len(e) for e in out.edges) + 1
    live = set(out.trees)
    fresh: dict = {k: [] for k in live}  # trees that the written scores don't hold yet
    held = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    for r in range(max((s.rounds for s in out.specs), default=0)):
        live = {k for k in live if r < out.specs[k[1]].rounds}
        if not live:
            break
        used = {}
        for k in live:
            spec = out.specs[k[1]]
            own = np.array([i for i, f in enumerate(out.features) if spec.only is None or f in spec.only])
            used[k] = np.sort(np.random.default_rng((spec.seed, k[1], r)).permutation(own)[:max(1, round(spec.columns * len(own)))])
        depth = max(out.specs[k[1]].depth for k in live)
        growing = {k: Tree(np.full((1 << out.specs[k[1]].depth) - 1, -1), np.zeros((1 << out.specs[k[1]].depth) - 1, np.int64), np.zeros(1 << out.specs[k[1]].depth)) for k in live}
        for level in range(depth):
            part = {k: t for k, t in growing.items() if level < out.specs[k[1]].depth}
            found = _level(held, out, part, fresh, used, level, r, n_bins)
            for k, t in part.items():
                if k not in found:
                    continue
                f, c, gain, left, right, loss, n = found[k]
                at = slice((1 << level) - 1, (2 << level) - 1)
                t.feature[at], t.cut[at] = f, c
                np.add.at(out.gains[k], f[f >= 0], gain[f >= 0])
                if level == out.specs[k[1]].depth - 1:
                    t.value[0::2], t.value[1::2] = left, right
                if level == 0 and n > 0:
                    _note(out, k, r, loss / n, n)
        for k, t in growing.items():
            t.value *= out.specs[k[1]].rate
            out.trees[k].append(t)
            fresh[k].append(t)
        if r + 1 in halving:
            live = _better_half(out, live, r)
        if (r + 1) % REWRITE == 0 and live:
            new = landed(_rescored(held, out, fresh), "boost-blocks")
            held.unpersist()
            discard(blocks)
            blocks, held, fresh = new, new.persist(StorageLevel.MEMORY_AND_DISK), {k: [] for k in fresh}
    held.unpersist()
    discard(blocks)


def _note(out: Boosted, k: tuple, trees: int, loss: float, n: float) -> None:
    spec = out.specs[k[1]]
    out.history.append((k[0], spec.name, spec.trial, spec.fold if spec.fold is not None else -1, trees, float(loss), int(n)))


def _better_half(out: Boosted, live: set, r: int) -> set:
    """The live models without the worse half of each segment's trials, by their mean loss over the folds."""
    last: dict = {}
    for seg, _, trial, _, at, loss, _ in out.history:
        if at == r:
            last.setdefault(seg, {}).setdefault(trial, []).append(loss)
    keep = set()
    for seg, by in last.items():
        order = sorted(by, key=lambda t: (np.mean(by[t]), t))
        keep |= {(seg, t) for t in order[:max(1, (len(order) + 1) // 2)]}
    return {k for k in live if (k[0], out.specs[k[1]].trial) in keep or k[0] not in last}


def _current(out: Boosted, fresh: dict, k: tuple, bins, scores):
    f = scores[k[1]].astype(float)
    for t in fresh[k]:
        f = f + t.value[_leaves(bins, t.feature, t.cut, out.specs[k[1]].depth)]
    return f


_SUMS = pa.schema([("segment", pa.string()), ("spec", pa.int32()), ("sums", pa.binary()), ("loss", pa.float64()), ("n", pa.float64())])
_SUMS_DDL = "segment string, spec int, sums binary, loss double, n double"
_SPLIT = pa.schema([("segment", pa.string()), ("spec", pa.int32()), ("feature", pa.list_(pa.int64())), ("cut", pa.list_(pa.int64())), ("gain", pa.list_(pa.float64())),
                    ("left", pa.list_(pa.float64())), ("right", pa.list_(pa.float64())), ("loss", pa.float64()), ("n", pa.float64())])
_SPLIT_DDL = "segment string, spec int, feature array<long>, cut array<long>, gain array<double>, left array<double>, right array<double>, loss double, n double"


def _level(held: DataFrame, out: Boosted, part: dict, fresh: dict, used: dict, level: int, r: int, n_bins: int) -> dict:
    """The best splits of one level of all growing trees."""
    nodes = 1 << level
    specs, spread, n_specs, n_features = out.specs, out.spread, len(out.specs), len(out.features)
    by_segment: dict = {}
    for k in part:
        by_segment.setdefault(k[0], []).append(k)
    thin = Boosted(out.features, [], specs)

    def sums(batches):
        total, seen = {}, {}
        for segment, block, bins, y, w, fold, scores, cells in _Blocks(n_features, n_specs)(batches):
            whole = w if cells is None else w * np.bincount(cells, minlength=len(y))
            for k in by_segment.get(segment, ()):
                spec = specs[k[1]]
                rows = _trained(spec, fold)
                if level == 0 and rows is not None:
                    out = np.flatnonzero(fold == spec.fold)
                    loss, n = seen.get(k, (0.0, 0.0))
                    f = _current(thin, fresh, k, bins[:, out], scores[:, out])
                    seen[k] = loss + _loss(spec, y[out], whole[out], f), n + whole[out].sum()
                weight = whole
                if spec.subsample < 1:
                    drawn = np.random.default_rng((spec.seed, k[1], r, block)).random(len(y) if cells is None else len(cells), np.float32) < spec.subsample
                    if cells is not None:
                        times = np.bincount(cells[drawn], minlength=len(y))
                        weight, drawn = w * times, times > 0
                    rows = drawn if rows is None else rows & drawn
                x, yy, ww, old = bins, y, weight, scores
                if rows is not None:
                    rows = np.flatnonzero(rows)
                    x, yy, ww, old = bins[:, rows], y[rows], weight[rows], scores[:, rows]
                g, h = _gradients(spec, _band(spread[segment], r), yy, ww, _current(thin, fresh, k, x, old))
                at = _leaves(x, part[k].feature, part[k].cut, level) * n_bins
                if k not in total:
                    total[k] = np.zeros((2, nodes, len(used[k]), n_bins))
                for j, c in enumerate(used[k]):
                    place = at + x[c]
                    total[k][0, :, j] += np.bincount(place, g, nodes * n_bins).reshape(nodes, n_bins)
                    total[k][1, :, j] += np.bincount(place, h, nodes * n_bins).reshape(nodes, n_bins)
        for k, x in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((k[0], k[1], x.tobytes(), *seen.get(k, (0.0, 0.0))), _SUMS)], schema=_SUMS)

    def best(batches):
        total, seen = {}, {}
        for batch in batches:  # one running sum per model, however many tasks sent one
            for segment, s, x, loss, n in zip(*[batch.column(c).to_pylist() for c in ("segment", "spec", "sums", "loss", "n")]):
                k = segment, s
                total[k] = total.get(k, 0) + np.frombuffer(x).reshape(2, nodes, len(used[k]), n_bins)
                seen[k] = tuple(np.add(seen.get(k, (0.0, 0.0)), (loss, n)))
        for k, x in total.items():
            f, c, gain, left, right = _best(x, specs[k[1]], used[k])
            row = k[0], k[1], f.tolist(), c.tolist(), gain.tolist(), left.tolist(), right.tolist(), *seen[k]
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _SPLIT)], schema=_SPLIT)

    tasks = max(1, min(len(part), int(held.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    got = held.mapInArrow(sums, _SUMS_DDL).repartition(tasks, "segment", "spec").mapInArrow(best, _SPLIT_DDL)
    return {(x["segment"], x["spec"]): (np.array(x["feature"]), np.array(x["cut"]), np.array(x["gain"]), np.array(x["left"]), np.array(x["right"]), x["loss"], x["n"]) for x in got.collect()}


def _rescored(held: DataFrame, out: Boosted, fresh: dict) -> DataFrame:
    """Blocks with the trees grown since their scores were written."""
    n_specs, n_features, thin = len(out.specs), len(out.features), Boosted(out.features, [], out.specs)

    def run(batches):
        decode = _Blocks(n_features, n_specs)
        for batch in batches:
            scores = []
            for segment, _, bins, _, _, _, old, _ in decode([batch]):
                new = old.copy()
                for s in range(n_specs):
                    if fresh.get((segment, s)):
                        new[s] = _current(thin, fresh, (segment, s), bins, old)
                scores.append(new.tobytes())
            yield batch.set_column(batch.schema.get_field_index("scores"), "scores", pa.array(scores, pa.binary()))

    return held.mapInArrow(run, _BLOCK_DDL)


def trials(base: Spec, draws: list, folds: int, expanding: bool = False) -> list:
    """One spec for each drawn set of parameters and fold."""
    first = 1 if expanding else 0
    return [replace(base, name=f"t{i}f{k}", trial=i, fold=k, expanding=expanding, **d) for i, d in enumerate(draws) for k in range(first, first + folds)]


def draw(space: dict, n: int, seed: int = 42) -> list:
    """``n`` seeded draws from {name: (low, high, 'int' | 'float' | 'log')}."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        one = {}
        for name, (low, high, kind) in space.items():
            u = rng.random()
            one[name] = float(np.exp(np.log(low) + u * np.log(high / low))) if kind == "log" else low + u * (high - low) if kind == "float" else int(low + u * (high - low + 1))
        out.append(one)
    return out


def best_trials(out: Boosted) -> dict:
    """segment -> (trial, trees, loss): the least mean loss over the folds, of the trials that
    reached their end, and the round it was met."""
    by: dict = {}
    for seg, _, trial, _, at, loss, _ in out.history:
        by.setdefault((seg, trial, at), []).append(loss)
    found: dict = {}
    most = {}
    for (seg, trial, at), losses in by.items():
        most[seg] = max(most.get(seg, 0), len(losses))
    for (seg, trial, at), losses in sorted(by.items()):
        if len(losses) == most[seg] and (seg not in found or np.mean(losses) < found[seg][2]):
            found[seg] = trial, at, float(np.mean(losses))
    return found
