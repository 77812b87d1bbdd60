"""Secret scan: fixed patterns, and by compression what no dictionary explains.

Patterns give the base spans. Beside them every run of key-like characters in a sensitive
context (a word such as token, auth or credential shortly before it, on its line) is a candidate. Its
novelty is what it adds to a zstandard frame: the compressed size of context and candidate
less that of the context alone, with a dictionary of the corpus's own identifiers as
prefix. Words, paths, repeated placeholders and names met elsewhere cost next to nothing; random keys cost
nearly their whole entropy. A candidate is reported if it costs ``COST`` of its length in bytes or more.

The dictionary is made of the identifiers of the whole corpus that most documents hold (a
map-side count, then Spark's aggregate), as many as fill some ``DICTIONARY`` bytes: the one thing collected, of
fixed size. The scan itself is one pass without a shuffle.

Cases: null and empty texts have no spans; very long texts are scanned whole; overlapping spans of
different kinds are all kept, but novel spans that overlap a base one are not added; equal starts are
ordered by kind; repeated rows are scanned each, a null doc_id is kept; an empty table gives no rows; other columns are ignored."""
from __future__ import annotations

import hashlib
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import written
from faultline.llm.encode import slices

#: base patterns, fixed by contract: kind, whole pattern, group that is measured, its least length
BASE = (("assign", re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 12),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
        ("hex", re.compile(r"[0-9a-f]+"), 0, 16))
#: what a text must hold for a kind to occur (for Arrow's regex kernel)
_MAY = {"assign": "(?i)password|passwd|secret|token|api_?key", "access": "AKIA[A-Z0-9]{14}", "hex": "[0-9a-f]{16}"}
#: equal to the pattern with its least length, but without a match for every shorter run
_LONG = {"access": re.compile(r"AKIA[A-Z0-9]{14,}"), "hex": re.compile(r"[0-9a-f]{16,}")}
KINDS = {"assign": 0, "access": 1, "hex": 2, "novel": 3}

#: words that make a context sensitive, and how far before the candidate on its line
_SENSITIVE = r"pass(?:word|wd|phrase|code)|\bpwd?\b|secret|token|credential|auth|bearer|api[_-]?key|access[_-]?key|private[_-]?key|signature|client[_-]?id"
CONTEXT = re.compile("(?ai)" + _SENSITIVE)
BEFORE = 64
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=~!@$%^&*.-]{10,}")
#: characters around a candidate that are its context
AROUND = 256
#: least share of its length that a candidate must cost
COST = 0.55
#: what parts identifiers. They are words without digits, so a key that copies of a document
#: repeat, which is no candidate without a digit, is never explained by the dictionary
IDENTIFIER = r"[^A-Za-z_]+"
LEAST = 5
#: bytes of text split at a time
SLICE = 4 << 20
#: bytes of the dictionary
DICTIONARY = 64 << 10


def identifiers(docs: DataFrame) -> DataFrame:
    """word, n: in how many rows every identifier of the texts occurs."""

    def count(batches):
        pa.set_cpu_count(1)
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            for a, b in slices(pc.binary_length(texts).to_pylist(), SLICE):
                words = pc.split_pattern_regex(texts.slice(a, b - a), IDENTIFIER)
                flat = pa.table({"row": pc.list_parent_indices(words), "word": pc.list_flatten(words)})
                flat = flat.filter(pc.greater_equal(pc.binary_length(flat["word"]), LEAST))
                once = flat.group_by(["row", "word"], use_threads=False).aggregate([])
                found = once.group_by("word", use_threads=False).aggregate([([], "count_all")])
                yield from found.rename_columns(["word", "n"]).cast(_COUNTS).to_batches()

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def dictionary(docs: DataFrame, size: int = DICTIONARY) -> bytes:
    """The identifiers of most documents, the commonest last (nearest to the text), in about ``size``
    bytes. A histogram of the counts tells which words fill it, so no more than those are collected:
    whole steps of the histogram, and of the last one a share by the words' hashes."""
    words = written(identifiers(docs).where("n > 1").withColumn("step", F.floor(F.log2("n") * 8).cast("int")), "identifiers")
    steps = words.groupBy("step").agg(F.sum(F.length("word") + 1).alias("bytes")).orderBy(F.desc("step")).collect()  # some 8 * 64 rows at most
    low, share, left = None, 0, size
    for row in steps:
        low = row["step"]
        share = 1024 if row["bytes"] <= left else 1024 * left // row["bytes"]
        left -= row["bytes"]
        if left <= 0:
            break
    if low is None:
        return b""
    last = (F.col("step") == low) & (F.pmod(F.xxhash64("word"), F.lit(1024)) < share)
    top = words.where((F.col("step") > low) | last).orderBy("n", F.desc("word")).select("word").collect()
    return " ".join(r["word"] for r in top).encode()


class Novelty:
    """Marginal compressed bytes against a dictionary."""

    def __init__(self, words: bytes):
        import zstandard
        shape = zstandard.ZstdCompressionParameters.from_level(9, write_content_size=False, write_checksum=False, write_dict_id=False)
        known = zstandard.ZstdCompressionDict(words, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(words) >= 8 else None
        self.compress = zstandard.ZstdCompressor(compression_params=shape, dict_data=known).compress

    def cost(self, context: str, candidate: str) -> int:
        base = context.encode("utf-8", "replace")
        return len(self.compress(base + candidate.encode())) - len(self.compress(base))


def base_spans(text: str, kinds=("assign", "access", "hex")) -> list:
    """(start, rank of the kind, end) of the base patterns."""
    out = []
    for kind, pattern, group, least in BASE:
        if kind in kinds:
            for m in _LONG.get(kind, pattern).finditer(text):
                if m.end(group) - m.start(group) >= least:
                    out.append((m.start(), KINDS[kind], m.end()))
    return sorted(out)


def novel_spans(text: str, taken: list, novelty: Novelty) -> list:
    """Candidates in a sensitive context that cost ``COST`` of their length and overlap no base span."""
    out, last = [], -1
    for word in CONTEXT.finditer(text):
        line = text.find("\n", word.end())
        stop = min(word.end() + BEFORE, line if line >= 0 else len(text))
        for m in CANDIDATE.finditer(text, word.end()):
            if m.start() >= stop:
                break
            if m.start() < last:
                continue
            last = m.end()
            found = m.group().rstrip(".")
            mixed = sum(any(c in x for c in found) for x in ("0123456789", _LOWER, _UPPER, "+/_=~!@$%^&*-"))
            if len(found) < 10 or mixed < 2 or not any(c.isdigit() for c in found):
                continue
            end = m.start() + len(found)
            if any(s < end and m.start() < e for s, _, e in taken):
                continue
            context = text[max(0, m.start() - AROUND):m.start()] + text[end:end + AROUND] + "\n"
            if novelty.cost(context, found) >= COST * len(found):
                out.append((m.start(), KINDS["novel"], end))
    return out


_COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])
_LOWER, _UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SCAN = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
                   ("base_sha256", pa.string()), ("spans", pa.string()), ("n_novel", pa.int64())])


def scan(docs: DataFrame, words: bytes | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_assign, n_access, n_hex, base_sha256, spans
    (kind:start:end in code points), n_novel."""
    words = dictionary(docs) if words is None else words
    names = list(KINDS)

    def shown(spans: list) -> str:
        return ",".join(f"{names[k]}:{a}:{b}" for a, k, b in spans)

    def run(batches):
        novelty = Novelty(words)
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            may = {kind: pc.match_substring_regex(texts, p).to_pylist() for kind, p in (_MAY | {"novel": "(?i)" + _SENSITIVE}).items()}
            rows = []
            for i, doc in enumerate(batch.column("doc_id").to_pylist()):
                kinds = [k for k in names if may[k][i]]
                text = texts[i].as_py() if kinds else ""
                base = base_spans(text, kinds)
                more = novel_spans(text, base, novelty) if may["novel"][i] else []
                n = [sum(k == j for _, k, _ in base) for j in range(3)]
                rows.append((doc, *n, hashlib.sha256(shown(base).encode()).hexdigest(), shown(sorted(base + more)), len(more)))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(_SCAN), _SCAN)], schema=_SCAN)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_novel long")
