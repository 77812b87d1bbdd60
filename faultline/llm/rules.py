"""Quality rules with adaptive thresholds.

Four shares are measured for every document. For each language and source their
distribution is kept as a quantile sketch: counts per logarithmic bucket (32 a doubling, so
a quantile is right to 1/32), which merge by adding. Partial sketches of any split of the
corpus give the same whole one, so the thresholds don't depend on partitions or retries. A
document is dropped when a share lies outside ``q25 - SPREADS * spread - slack`` ..
``q75 + SPREADS * spread + slack`` of its language and source (spread = q75 - q25, slack =
the share's own smallest notable step), or when it fails the base rules.

Cases: null text has no words and fails the base rules; null language and source are groups
of their own; a group whose only documents are base failures has no sketch, and nothing
else is asked of them; repeated rows are counted and judged each; an empty table gives no
rows; other columns are ignored by ``measure`` and kept by ``keep_documents``.
"""
from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.llm.common import as_bytes, windows, word_hashes, written

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SPREADS = 4
SUB_BUCKETS = 32
#: share -> (count column, per how many words, slack)
SHARES = {
    "chars_per_1000": ("word_chars", 1000, 1500),
    "symbols_per_1000": ("n_symbols", 1000, 100),
    "dup_lines_per_1000": ("n_dup_lines", 1000, 40),
    "echoes_per_1000": ("n_echo_words", 1000, 50),
}
_SYMBOLS = re.compile(rb"[#*$%&|<>]")
_CONTINUATION = bytes(range(0x80, 0xC0))
_MEASURES = pa.schema([(c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_echo_words")])
COUNTS = _MEASURES.names


def count_text(text: bytes) -> tuple:
    """The counts of one text, in the order of COUNTS."""
    words = text.split()
    n = len(words)
    if not n:
        return 0, 0, len(_SYMBOLS.findall(text)), 0, 0, 0
    joined = b"".join(words)
    chars = len(joined.translate(None, _CONTINUATION))
    lines = [x for x in text.split(b"\n") if x.strip()]  # on bytes: ASCII white space
    hashes = word_hashes(words)
    repeats = 0
    if n > WINDOW:
        w = windows(hashes, WINDOW)
        _, inverse, counts = np.unique(w, return_inverse=True, return_counts=True)
        twice = counts[inverse] > 1
        if twice.any():
            covered = np.zeros(n + 1, np.int64)
            starts = np.flatnonzero(twice)
            np.add.at(covered, starts, 1)
            np.add.at(covered, starts + WINDOW, -1)
            repeats = int((np.cumsum(covered) > 0).sum())
    echoes = int((hashes[1:] == hashes[:-1]).sum())
    return n, chars, len(_SYMBOLS.findall(text)), len(lines) - len(set(lines)), repeats, echoes


def measure(docs: DataFrame, keys: list) -> DataFrame:
    """``keys`` columns of docs with COUNTS of their text."""

    def count(batches):
        for batch in batches:
            rows = [count_text(t) for t in as_bytes(batch.column("text"))]
            counts = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * len(COUNTS)
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in keys] + counts, names=keys + COUNTS)

    source = docs.select(*keys, F.col("text").cast("string").alias("text"))
    kinds = dict(source.dtypes)
    return source.mapInArrow(count, ", ".join([f"`{k}` {kinds[k]}" for k in keys] + [f"{c} long" for c in COUNTS]))


def with_base(measured: DataFrame) -> DataFrame:
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return measured.withColumn("base_failed", failed)


def _share(name: str):
    column, per, _ = SHARES[name]
    return F.floor(F.col(column) * per / F.greatest("n_words", F.lit(1))).cast("long")


def sketches(measured: DataFrame) -> DataFrame:
    """lang, source, share, bucket (its lowest value), n: the mergeable sketches."""
    pairs = F.explode(F.array(*[F.struct(F.lit(s).alias("share"), _share(s).alias("value")) for s in SHARES])).alias("x")
    values = measured.where("NOT base_failed").select("lang", "source", pairs).select("lang", "source", "x.share", "x.value")
    # integer buckets: the leading bits of the value, 32 steps a doubling, exact below 64
    step = F.greatest(F.length(F.bin("value")) - 6, F.lit(0))
    bucket = F.expr("shiftleft(shiftright(value, step), step)")
    return values.withColumn("step", step).groupBy("lang", "source", "share", bucket.alias("bucket")).agg(F.count("*").alias("n"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """lang, source, share, low, high from the sketches (a few hundred buckets a group)."""
    own = Window.partitionBy("lang", "source", "share")
    ranked = sketch.withColumn("upto", F.sum("n").over(own.orderBy("bucket"))).withColumn("total", F.sum("n").over(own))
    at = lambda q: F.min(F.when(F.col("upto") * 100 >= F.col("total") * q, F.col("bucket")))
    slack = F.create_map(*[x for s, (_, _, k) in SHARES.items() for x in (F.lit(s), F.lit(k))])
    quartiles = ranked.groupBy("lang", "source", "share").agg(at(25).alias("q25"), at(75).alias("q75"))
    room = (F.col("q75") - F.col("q25")) * SPREADS + slack[F.col("share")]
    return quartiles.select("lang", "source", "share", (F.col("q25") - room).alias("low"), (F.col("q75") + room).alias("high"))


def judge(docs: DataFrame, keys: list) -> DataFrame:
    """keys, COUNTS, base_failed and kept for every row. ``docs`` needs text, lang, source;
    ``keys`` are carried along and must not be named like COUNTS."""
    extra = [k for k in ("lang", "source") if k not in keys]
    measured = written(with_base(measure(docs, keys + extra)), "measures")
    limits = thresholds(sketches(measured))
    wide = limits.groupBy("lang", "source").agg(F.map_from_entries(F.collect_list(F.struct("share", F.struct("low", "high")))).alias("limits"))
    wide = wide.select(F.col("lang").alias("l_lang"), F.col("source").alias("l_source"), "limits")
    # each language and source has one row of limits, so a hot source only repeats a short row
    judged = measured.join(wide, measured["lang"].eqNullSafe(wide["l_lang"]) & measured["source"].eqNullSafe(wide["l_source"]), "left")
    inside = F.lit(True)
    for s in SHARES:
        limit = F.col("limits")[s]
        inside = inside & F.coalesce(_share(s).between(limit["low"], limit["high"]), F.lit(True))
    return judged.select(*keys, *COUNTS, "base_failed", (~F.col("base_failed") & inside).alias("kept"))


def keep_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns."""
    # rows are told apart by doc_id and text, so that repeated ids are judged each
    key = [F.col("doc_id").alias("k_doc"), F.xxhash64("text").alias("k_text")]
    verdicts = judge(docs.select("text", "lang", "source", *key), ["k_doc", "k_text"]).where("kept").select("k_doc", "k_text").distinct()
    return docs.join(verdicts, docs["doc_id"].eqNullSafe(verdicts["k_doc"]) & (F.xxhash64(docs["text"]) == verdicts["k_text"]), "left_semi")
