"""Sharding on a consistent-hash ring with virtual nodes and bounded loads; built-in
functions only.

Every shard has ``VNODES`` places on a ring of 2**60 positions, every row a position by the
hash of its key. A row goes to the shard of the next place clockwise. No shard takes more
than its bound; with the law ``rows`` the bounds are the row count shared out evenly, one
apart at most. What overflows a full shard goes on clockwise, place by place, until one has
room. As the bounds add up to the row count, every shard ends exactly full.

Rows of one arc (between two places) take one way, so only their number matters: the
cascade is settled on the counts per arc (a table of shards x VNODES rows, whatever the
corpus), and each arc's rows are then dealt by their rank, first to the nearest shard. Ranks come from
bucket counts and a window in each bucket; the buckets grow in number with the rows, so
neither a window nor a counting task grows.

Cases: a null key is a key like any other, and a null text has no bytes; equal keys are spread
by their text's hash in one arc and dealt by rank, so repeated rows don't pile up on one shard; an empty table gives
no rows; with fewer rows than shards some shards are empty; other columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARDS = 16
VNODES = 64
RING_BITS = 60
#: equal parts of the ring for looking places up
STRETCHES = 1024
#: rows of a ranking bucket, about
BUCKET_ROWS = 4_000


def _hash(*columns):
    """60 bits of an MD5, also in the plain SQL of other engines."""
    text = F.concat_ws("/", *[F.coalesce(c.cast("string"), F.lit("~")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def places(shards: int, vnodes: int) -> list:
    """(position, shard) of every virtual node, clockwise."""
    import hashlib
    return sorted((int(hashlib.md5(f"shard {s} place {v}".encode()).hexdigest()[:15], 16), s) for s in range(shards) for v in range(vnodes))


def cascade(counts: list, owners: list, bounds: list) -> list:
    """Where each arc's rows go: for every arc a list of (shard, rows), nearest first.

    Step by step each arc offers what it has left to its next place clockwise; a shard takes
    from the arcs in ring order until it is full."""
    left, room = list(counts), list(bounds)
    ways: list = [[] for _ in counts]
    for step in range(len(owners)):
        if not any(left):
            break
        for arc, n in enumerate(left):
            shard = owners[(arc + step) % len(owners)]
            take = min(n, room[shard])
            if take:
                room[shard] -= take
                left[arc] -= take
                ways[arc].append((shard, take))
    return ways


def assign(docs: DataFrame, shards: int = SHARDS, vnodes: int = VNODES, key: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` (key, text) as key, size, text_crc32, shard, slot."""
    spark = docs.sparkSession
    ring = places(shards, vnodes)
    ends = [p for p, _ in ring]
    text = F.col("text").cast("string")
    rows = docs.select(F.col(key), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"), F.coalesce(F.crc32(text), F.lit(0)).alias("text_crc32"))
    rows = rows.withColumn("position", _hash(F.col(key))).withColumn("tie", F.xxhash64(F.col(key), "text_crc32"))
    # the arc: how many places lie before the position, looked up by the position's first bits
    # (STRETCHES rows) among the few places of that stretch; the last arc wraps around to the first place
    width = (1 << RING_BITS) // STRETCHES
    stretch = [(b, sum(e < b * width for e in ends), [e for e in ends if e // width == b]) for b in range(STRETCHES)]
    lookup = spark.createDataFrame(stretch, "stretch int, low int, own array<long>")
    rows = rows.withColumn("stretch", F.expr(f"cast(position div {width} AS int)"))
    arc = F.col("low") + F.size(F.filter("own", lambda e: e < F.col("position")))
    rows = rows.join(F.broadcast(lookup), "stretch").withColumn("arc", F.pmod(arc, F.lit(len(ends)))).drop("stretch", "low", "own")
    by_arc = dict(rows.groupBy("arc").count().collect())  # shards x vnodes rows
    total = sum(by_arc.values())
    buckets = spark.createDataFrame([(a, 1 + by_arc.get(a, 0) // BUCKET_ROWS) for a in range(len(ends))], "arc int, buckets int")
    rows = rows.join(F.broadcast(buckets), "arc").withColumn("bucket", F.pmod("tie", F.col("buckets")).cast("int")).drop("buckets")
    counts = rows.groupBy("arc", "bucket").agg(F.count("*").alias("n"))
    bounds = [total // shards + (s < total % shards) for s in range(shards)]
    ways = cascade([by_arc.get(a, 0) for a in range(len(ends))], [s for _, s in ring], bounds)
    # slots: a shard's stretches follow each other by arc
    stretches, used = [], [0] * shards
    for a, way in enumerate(ways):
        lo = 0
        for shard, n in way:
            stretches.append((a, shard, lo, lo + n, used[shard] - lo))
            used[shard] += n
            lo += n
    plan = spark.createDataFrame(stretches, "arc int, shard int, lo long, hi long, shift long")
    plan = plan.groupBy("arc").agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "shard", "shift"))).alias("way"))
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("arc").orderBy("bucket")) - F.col("n")).select("arc", "bucket", "before")
    ranked = rows.withColumn("own", F.row_number().over(Window.partitionBy("arc", "bucket").orderBy("position", "tie", "size")) - 1)
    ranked = ranked.join(before, ["arc", "bucket"]).join(F.broadcast(plan), "arc").withColumn("rank", F.col("before") + F.col("own"))
    to = F.filter("way", lambda w: (w["lo"] <= F.col("rank")) & (F.col("rank") < w["hi"]))[0]
    return ranked.withColumn("to", to).select(key, "size", "text_crc32", F.lit("rows").alias("law"), F.col("to.shard").alias("shard"),
                                              (F.col("rank") + F.col("to.shift")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "arc")
