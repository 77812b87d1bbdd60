"""A Merkle manifest of a table by butterfly exchange, on built-in functions and one small
Python step per block.

Every row is a leaf, every group (source) a tree of fan-out 3 over its leaves in key order, and
the groups' roots, in order, are the leaves of one more tree. The leaves of a group are dealt
into blocks of 3**LEVELS places; a block is aligned with the tree, so it hashes its own subtree
alone. Then the blocks exchange: in round r the three blocks whose numbers differ in their r-th
base-3 digit alone swap the roots of the subtrees they stand in, and each hashes the common
ancestor for itself. After as many rounds as the number of blocks has base-3 digits, each block knows the
root and the siblings on its way up, and nothing is sent down. Numbers are filled up to a power
of three, so that at a ragged end each block still hears from at most three others; what is filled
up stands in for a subtree without leaves and adds nothing to a hash. Only digests are shuffled, never texts.

Places come from a range partitioning by (group, key, leaf) and the counts of each partition, so
a group with a third of all rows is spread over as many partitions and blocks as it needs.

Cases: a null group is a group of its own and comes first, a null key comes first in its group and is
the leaf of '-'; rows of one key are ordered by their leaf, equal rows get a place each; a null text differs from
an empty one; texts are hashed whole; a lone leaf is its own root; an empty table gives no rows; other columns are
ignored, so their names can't clash."""
from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.llm.common import written

FANOUT = 3
#: a block holds FANOUT ** LEVELS leaves
LEVELS = 6
#: rounds of the exchange in one plan
ROUNDS = 4
#: blocks that share one copy of their group's way to the root
SHARE = 1024


def leaf_of(*values: Column) -> Column:
    """The leaf digest: each value as its UTF-8 byte count, ':' and itself, a null as '-'."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _ladder(nodes: list, levels: int | None) -> tuple:
    """The root of ``nodes`` after ``levels`` rounds (None: until one is left), and for each
    node the (before, after) siblings of every level."""
    ways: list = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1 if levels is None else levels > 0:
        for leaf, i in enumerate(at):
            run = nodes[i - i % FANOUT:i - i % FANOUT + FANOUT]
            ways[leaf].append(("".join(run[:i % FANOUT]), "".join(run[i % FANOUT + 1:])))
        nodes = [_sha("".join(nodes[i:i + FANOUT])) for i in range(0, len(nodes), FANOUT)]
        at = [i // FANOUT for i in at]
        levels = None if levels is None else levels - 1
    return nodes[0], ways


def fold(leaf: str, way: list) -> str:
    """The root that a leaf and its siblings give."""
    for before, after in way:
        leaf = _sha(before + leaf + after)
    return leaf


def placed(leaves: DataFrame, order: list, levels: int) -> DataFrame:
    """``leaves`` (group, ...) with block and place, written in blocks: one row per block, its
    leaves in order. ``order``: what leaves of a group are ordered by."""
    dealt = written(leaves.repartitionByRange("group", *order).sortWithinPartitions("group", *order)
                    .select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")), "merkle-leaves")
    # one row for each partition and group in it: leaves of the group in earlier partitions
    runs = dealt.groupBy("group", "part").agg(F.count("*").alias("n"), F.min("row").alias("first"))
    by = Window.partitionBy("group")
    runs = runs.select("group", "part", (F.sum("n").over(by.orderBy("part")) - F.col("n") - F.col("first")).alias("shift"), F.sum("n").over(by).alias("leaves"))
    at = dealt.join(runs, ["group", "part"]).withColumn("place", F.col("row") + F.col("shift")).drop("part", "row", "shift")
    inner = [c for c in leaves.columns if c != "group"]
    at = at.withColumn("block", F.expr(f"place div {FANOUT ** levels}"))
    # at most FANOUT ** levels leaves each
    blocks = at.groupBy("group", "block").agg(F.first("leaves").alias("leaves"), F.array_sort(F.collect_list(F.struct("place", *inner))).alias("own"))
    return blocks


def _with_roots(blocks: DataFrame, levels: int) -> DataFrame:
    """Adds node: each block's subtree root, of ``levels`` levels, or of all its group has."""
    size = FANOUT ** levels

    def run(batches):
        for batch in batches:
            roots = []
            for own, n in zip(batch.column("leaf").to_pylist(), batch.column("leaves").to_pylist()):
                roots.append(_ladder(own, levels if n > size else None)[0])
            yield pa.RecordBatch.from_arrays([batch.column("group"), batch.column("block"), batch.column("leaves"), pa.array(roots, pa.string())],
                                             names=["group", "block", "leaves", "node"])

    return blocks.select("group", "block", "leaves", F.col("own.leaf").alias("leaf")).mapInArrow(run, "group string, block long, leaves long, node string")


def _digits(blocks: int) -> int:
    """Rounds that ``blocks`` blocks need."""
    rounds = 0
    while FANOUT ** rounds < blocks:
        rounds += 1
    return rounds


def exchanged(nodes: DataFrame, levels: int) -> DataFrame:
    """The rounds: from each block's (group, block, leaves, node) to group, block, root and way,
    the (before, after) siblings above the block."""
    size = FANOUT ** levels
    state = nodes.withColumn("blocks", F.expr(f"(leaves + {size - 1}) div {size}")).drop("leaves")
    most = state.agg(F.max("blocks")).first()[0] or 0
    rounds = F.lit(0)
    for r in range(_digits(most)):
        rounds = rounds + (F.col("blocks") > FANOUT ** r).cast("int")
    state = state.withColumn("rounds", rounds).withColumn("way", F.array().cast("array<struct<before:string,after:string>>"))
    # numbers up to the power of three: a number without a block has no node
    gap = state.where(F.col("block") == F.col("blocks") - 1).where("pow(3, rounds) > blocks")
    gap = gap.select("group", F.explode(F.expr("sequence(blocks, cast(pow(3, rounds) as bigint) - 1)")).alias("block"),
                     F.lit(None).cast("string").alias("node"), "blocks", "rounds", "way")
    state = state.unionByName(gap)
    for r in range(_digits(most)):
        step = FANOUT ** r
        digit = F.expr(f"(block div {step}) % {FANOUT}")
        others = F.array(*[F.col("block") + (F.lit(d) - F.col("digit")) * step for d in range(FANOUT)])
        said = state.withColumn("digit", digit).withColumn("to", F.explode(F.when(F.lit(r) < F.col("rounds"), others).otherwise(F.array("block"))))
        own = F.col("to") == F.col("block")
        heard = said.groupBy("group", F.col("to").alias("block")).agg(
            *[F.max(F.when(F.col("digit") == d, F.col("node"))).alias(f"n{d}") for d in range(FANOUT)],
            *[F.first(F.when(own, F.col(c)), ignorenulls=True).alias(c) for c in ("blocks", "rounds", "way", "digit")])
        both = F.concat_ws("", *[f"n{d}" for d in range(FANOUT)])
        own_node = F.coalesce(*[F.when(F.col("digit") == d, F.col(f"n{d}")) for d in range(FANOUT)])
        before = F.concat_ws("", *[F.when(F.lit(d) < F.col("digit"), F.col(f"n{d}")) for d in range(FANOUT)])
        after = F.concat_ws("", *[F.when(F.lit(d) > F.col("digit"), F.col(f"n{d}")) for d in range(FANOUT)])
        active = F.lit(r) < F.col("rounds")
        state = heard.select("group", "block", "blocks", "rounds",
                             F.when(~active, own_node).when(both != "", F.sha2(both, 256)).alias("node"),
                             F.when(active, F.concat("way", F.array(F.struct(before.alias("before"), after.alias("after"))))).otherwise(F.col("way")).alias("way"))
        if r % ROUNDS == ROUNDS - 1:
            state = written(state, "merkle-round")
    return state.where("block < blocks").select("group", "block", "blocks", F.col("node").alias("root"), "way")


def tree(leaves: DataFrame, order: list, levels: int) -> tuple:
    """The blocks of ``leaves`` (group, leaf, ...): group, block, leaves, own; and their way up:
    group, block, blocks, root, way. Both written."""
    blocks = written(placed(leaves, order, levels), "merkle-blocks")
    return blocks, written(exchanged(_with_roots(blocks, levels), levels), "merkle-ways")


def manifest(rows: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``rows``: key, group, leaf, claimed (a digest to be proved in the leaf's place). Gives per row
    key, leaf, subroot, root, proof_sha256, folded_root, verified."""
    label = F.coalesce(F.concat(F.lit("="), F.col("group").cast("string")), F.lit("-"))  # null sorts first
    leaves = rows.select(label.alias("group"), F.col("key").cast("long").alias("key"), "leaf", "claimed")
    blocks, ways = tree(leaves, ["key", "leaf", "claimed"], levels)
    # the groups' roots are the leaves of one more tree
    tops = ways.where("block = 0").select(F.lit("").alias("group"), F.col("group").alias("name"), F.col("root").alias("leaf"), "blocks")
    top_blocks, top_ways = tree(tops, ["name"], levels)
    top = top_blocks.join(top_ways, ["group", "block"])
    size = FANOUT ** levels

    def upper(batches):
        for batch in batches:
            for own, n, root, way in zip(*[batch.column(c).to_pylist() for c in ("own", "leaves", "root", "way")]):
                _, ways = _ladder([x["leaf"] for x in own], levels if n > size else None)
                over = [(w["before"], w["after"]) for w in way]
                yield pa.RecordBatch.from_pydict({"group": [x["name"] for x in own], "all": [x["blocks"] for x in own], "top": [root] * len(own),
                                                  "over": [[{"before": b, "after": a} for b, a in w + over] for w in ways]}, schema=_UPPER)

    names = top.mapInArrow(upper, "group string, all long, top string, over array<struct<before:string,after:string>>")
    # a group of many blocks takes its row in a copy for every SHARE of them, so none is hot
    names = names.select("group", F.explode(F.expr(f"sequence(0L, (all - 1) div {SHARE})")).alias("share"), "top", "over")
    ways = ways.withColumn("share", F.expr(f"block div {SHARE}")).join(names, ["group", "share"]).drop("share", "blocks")

    def prove(batches):
        for batch in batches:
            for own, n, subroot, way, root, over in zip(*[batch.column(c).to_pylist() for c in ("own", "leaves", "root", "way", "top", "over")]):
                _, ways = _ladder([x["leaf"] for x in own], levels if n > size else None)
                shared = [(w["before"], w["after"]) for w in way + over]
                tail = "".join(b + a for b, a in shared).encode()
                cols = {"key": [x["key"] for x in own], "leaf": [x["leaf"] for x in own], "subroot": [subroot] * len(own), "root": [root] * len(own),
                        "proof_sha256": [hashlib.sha256("".join(b + a for b, a in w).encode() + tail).hexdigest() for w in ways],
                        "folded_root": [fold(x["claimed"], w + shared) for x, w in zip(own, ways)]}
                cols["verified"] = [x == root for x in cols["folded_root"]]
                yield pa.RecordBatch.from_pydict(cols, schema=_PROOF)

    return blocks.join(ways, ["group", "block"]).select("own", "leaves", "root", "way", "top", "over").mapInArrow(
        prove, "key long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


_WAY = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
_UPPER = pa.schema([("group", pa.string()), ("all", pa.int64()), ("top", pa.string()), ("over", _WAY)])
_PROOF = pa.schema([("key", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()), ("proof_sha256", pa.string()),
                    ("folded_root", pa.string()), ("verified", pa.bool_())])


def document_leaves(docs: DataFrame) -> DataFrame:
    """Documents as ``manifest`` takes them. The claimed rows of every doc_id whose decimal
    text has an even crc32 have lost their text's newlines (a null doc_id has none)."""
    text = F.col("text").cast("string")
    tampered = F.when(F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string")) % 2, F.lit(1)) == 0, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)
    fields = [F.col("doc_id").cast("long"), F.col("source"), F.col("lang"), F.col("n_chars").cast("long")]
    return docs.select(F.col("doc_id").alias("key"), F.col("source").cast("string").alias("group"), leaf_of(*fields, text).alias("leaf"), leaf_of(*fields, tampered).alias("claimed"))
