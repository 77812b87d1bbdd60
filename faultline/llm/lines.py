"""Line dedup by content-defined line chunks; built-in functions only.

A text is cut at newlines. Over the hashes of its lines runs a rolling hash of the last
``WINDOW`` lines; where it is divisible by ``DIVISOR`` a chunk ends. So boundaries move
with the content: a passage that many documents share is cut alike inside, wherever it
stands. A chunk of several lines that occurs more than once in the corpus is kept only where it occurs
first (smallest doc_id, there the first place) and removed elsewhere, after the bytes of all
occurrences have been compared.

Cases: null texts stay null; an empty text is one empty line; chunks of one line or without a
word are never removed; rows of one doc_id count as one document, each keeping its first
occurrence; rows with a null doc_id are left as they are; chunks whose hashes are equal but whose bytes
differ stay all; a text whose every chunk goes becomes empty; an empty table gives no rows;
all other columns are kept, whatever their names.

Chunk boundaries depend on three lines, so most short repeated passages between other lines are in no chunk of
their own and stay (``dedup_lines``; the README has the recall). ``dedup_chunks`` finds all of them by chunks that share their
edge lines, so that every two neighbouring lines with a word lie in exactly one chunk. The rolling hash runs over such
pairs of lines, and where it is divisible by ``DIVISOR`` a chunk ends with the pair. Copies of a chunk go whole, as chunks. Of every
distinct chunk one place is opened into its pairs, and pairs that occur earlier extend the removal line by line to the
maximal repeated run, whatever the chunk's edges.

The rule, which no boundary enters: a line goes if it stands in a pair of neighbouring worded lines that occurs earlier
(smaller doc_id, there the first place; a pair that overlaps its own first place stays), so every maximal run of
two or more repeated lines goes whole and the first occurrence of each line stays. Lines without a word between
the two go with them. Rows of one doc_id are ordered by their texts' hashes, equal rows are treated alike; very long
texts are cut into more chunks, none longer than the text; the other cases are as above. ``dedup_runs`` gives the same
without chunks.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import discard, written

WINDOW = 3
DIVISOR = 4
MIN_LINES = 2
#: tasks over which the rows of one hash are spread
SALTS = 8
#: the rolling hash's factor and modulus (products stay far below 2**63)
FACTOR, MODULUS = 1_000_003, 2_147_483_647


def _hash(column):
    """60 bits of a string's MD5."""
    return F.conv(F.substring(F.md5(column), 1, 15), 16, 10).cast("long")


def chunked(text):
    """A column expression: the chunks of a text, array<struct<no, lines, hash, body>>."""
    lines = F.split(text, "\n")
    hashes = F.transform(lines, lambda x: F.pmod(_hash(x), F.lit(MODULUS)))
    both = F.struct(lines.alias("lines"), hashes.alias("hashes"))

    def rolling(hashes, i):
        total = F.lit(0).cast("long")
        for back in range(WINDOW - 1, -1, -1):
            h = F.when(i > back, F.element_at(hashes, F.greatest(i - back, F.lit(1)))).otherwise(F.lit(0).cast("long"))
            total = F.pmod(total * FACTOR + h, F.lit(MODULUS))
        return total

    def cut(x):
        n = F.size(x["lines"])
        ends = F.filter(F.sequence(F.lit(1), n), lambda i: (F.pmod(rolling(x["hashes"], i), F.lit(DIVISOR)) == 0) | (i == n))
        return F.transform(ends, lambda end, k: F.struct(
            k.alias("no"), F.when(k == 0, F.lit(0)).otherwise(F.element_at(ends, F.greatest(k, F.lit(1)))).alias("start"), end.alias("end"), x["lines"].alias("lines")))

    chunks = F.flatten(F.transform(F.array(both), cut))
    return F.transform(chunks, lambda c: F.struct(
        c["no"].alias("no"), (c["end"] - c["start"]).alias("lines"),
        F.array_join(F.slice(c["lines"], c["start"] + 1, c["end"] - c["start"]), "\n").alias("body")))


def chunk_table(docs: DataFrame) -> DataFrame:
    """doc_id, no, lines, hash, body of every chunk that may be removed."""
    found = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long"), F.explode(chunked(F.col("text"))).alias("c"))
    several = found.where((F.col("c.lines") >= MIN_LINES) & F.col("c.body").rlike(r"[^\x20\x09-\x0D]"))
    return several.select("doc_id", "c.no", "c.lines", _hash(F.col("c.body")).alias("hash"), "c.body")


def removals(chunks: DataFrame) -> DataFrame:
    """doc_id, gone (numbers of its chunks to remove) of documents that lose some."""
    thin = chunks.select("doc_id", "no", "hash")
    repeated = thin.groupBy("hash").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc")).where("n > 1").select("hash", "first_doc")
    # the bytes: all occurrences of a hash must be one string
    bodies = chunks.select("hash", "body").join(repeated, "hash", "left_semi").groupBy("hash", "body").agg(F.lit(1).alias("one"))
    same = bodies.groupBy("hash").agg(F.count("*").alias("bodies")).where("bodies = 1").select("hash")
    own_first = thin.groupBy("doc_id", "hash").agg(F.min("no").alias("own_first"), F.collect_set("no").alias("nos"))
    gone = own_first.join(repeated.join(same, "hash"), "hash").select("doc_id", F.when(F.col("doc_id") > F.col("first_doc"), F.col("nos")).otherwise(
        F.filter("nos", lambda x: x > F.col("own_first"))).alias("nos"))
    return gone.where(F.size("nos") > 0).groupBy("doc_id").agg(F.flatten(F.collect_list("nos")).alias("gone"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` (doc_id, text, ...) with the text that stays, and n_removed, the lines removed."""
    gone = removals(chunk_table(docs)).select(F.col("doc_id").alias("__gone_doc"), F.col("gone").alias("__gone"))
    joined = docs.join(gone, F.col("doc_id").cast("long") == F.col("__gone_doc"), "left")
    chunks = F.transform(chunked(F.col("text")), lambda c: F.struct(F.array_contains("__gone", c["no"]).alias("out"), c["lines"].alias("lines"), c["body"].alias("body")))
    kept = F.array_join(F.transform(F.filter(chunks, lambda c: ~c["out"]), lambda c: c["body"]), "\n")
    lost = F.aggregate(F.filter(chunks, lambda c: c["out"]), F.lit(0), lambda total, c: total + c["lines"])
    cut = F.col("__gone").isNotNull()
    return joined.select(*[F.when(cut, kept).otherwise(F.col("text")).alias("text") if c == "text" else docs[c] for c in docs.columns],
                         F.when(cut & F.col("text").isNotNull(), lost).otherwise(F.lit(0)).cast("long").alias("__n_removed"))


_WORDED = r"[^\x20\x09-\x0D]"
_KEY = ["doc_id", "row_hash"]


def _line_pairs(text):
    """A column expression: array<struct<a, b, hash, twin>> of a text's neighbouring worded lines: their numbers,
    the pair's hash and whether the two are equal."""
    numbered = F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("i"), x.alias("x")))

    def pair(w):
        n = F.greatest(F.size(w) - 1, F.lit(0))
        return F.zip_with(F.slice(w, F.lit(1), n), F.slice(w, F.lit(2), n), lambda a, b: F.struct(
            a["i"].alias("a"), b["i"].alias("b"), F.xxhash64(a["x"], b["x"]).alias("hash"), (a["x"] == b["x"]).alias("twin")))

    return F.flatten(F.transform(F.array(F.filter(numbered, lambda p: p["x"].rlike(_WORDED))), pair))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row_hash"), "text")


def repeated_pairs(docs: DataFrame) -> DataFrame:
    """doc_id, row_hash, a, b, hash, first_doc of every occurrence of the pairs of lines that occur more than once."""
    thin = _keyed(docs).select(*_KEY, F.explode(_line_pairs(F.col("text"))).alias("p")).select(*_KEY, "p.*")
    repeated = thin.groupBy("hash").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc")).where("n > 1").select("hash", "first_doc")
    return thin.join(repeated, "hash").select(*_KEY, "a", "b", "hash", "first_doc")


def run_removals(docs: DataFrame) -> DataFrame:
    """doc_id, row_hash, gone (numbers of the lines to remove) of rows that lose some."""
    pairs = written(repeated_pairs(docs), "line-pairs")
    first = pairs.where("doc_id = first_doc").groupBy("doc_id", "hash").agg(F.min(F.struct("row_hash", "a", "b")).alias("first"))
    later = F.col("first").isNull() | (F.col("row_hash") != F.col("first.row_hash")) | (F.col("a") > F.col("first.b"))
    again = pairs.join(first, ["doc_id", "hash"], "left").where(later).select(*_KEY, "a", "b", "hash")
    # the bytes: all occurrences of a hash must be the same two lines
    held = pairs.groupBy(*_KEY).agg(F.collect_set(F.struct("a", "b", "hash")).alias("pairs"))
    both = _keyed(docs).join(held, _KEY).select(F.explode(F.flatten(F.transform(F.array(F.struct(F.split("text", "\n").alias("lines"), "pairs")), lambda s: F.transform(
        s["pairs"], lambda p: F.struct(p["hash"].alias("hash"), s["lines"][p["a"]].alias("x"), s["lines"][p["b"]].alias("y")))))).alias("p"))
    unlike = both.select("p.*").groupBy("hash", "x", "y").agg(F.lit(1).alias("one")).groupBy("hash").count().where("count > 1").select("hash")
    unlike = written(unlike, "unlike")
    if not unlike.isEmpty():
        again = again.join(unlike, "hash", "left_anti")
    return again.groupBy(*_KEY).agg(F.array_distinct(F.flatten(F.collect_list(F.sequence("a", "b")))).alias("gone"))


def dedup_runs(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` (doc_id, text, ...) with the text that stays, and __n_removed, the lines removed."""
    return _without(docs, run_removals(docs))


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    gone = gone.select(F.col("doc_id").alias("__gone_doc"), F.col("row_hash").alias("__gone_row"), F.col("gone").alias("__gone"))
    joined = docs.join(gone, (F.col("doc_id").cast("long") == F.col("__gone_doc")) & (F.xxhash64("text") == F.col("__gone_row")), "left")
    both = F.array(F.struct(F.split("text", "\n").alias("lines"), F.col("__gone").alias("gone")))
    kept = F.array_join(F.flatten(F.transform(both, lambda s: F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(s["lines"]) - 1), s["gone"]), lambda i: s["lines"][i]))), "\n")
    cut = F.col("__gone").isNotNull()
    return joined.select(*[F.when(cut, kept).otherwise(F.col("text")).alias("text") if c == "text" else docs[c] for c in docs.columns],
                         F.when(cut, F.size("__gone")).otherwise(F.lit(0)).cast("long").alias("__n_removed"))


def _chunks(text):
    """A column expression: array<struct<a, b, hash, plain, pairs>>: the chunks of a text's pairs of lines, with their
    first and last line, and whether no pair is of two equal lines (such a pair may overlap its own first place)."""
    some = F.filter(F.array(F.struct(_line_pairs(text).alias("pairs"))), lambda s: F.size(s["pairs"]) > 0)
    ended = F.transform(some, lambda s: F.struct(s["pairs"].alias("pairs"), F.filter(
        F.sequence(F.lit(1), F.size(s["pairs"])),
        lambda i: (F.pmod(F.element_at(s["pairs"], i)["hash"], F.lit(DIVISOR)) == 0) | (i == F.size(s["pairs"]))).alias("ends")))

    def chunk(pairs, start, end):
        own = F.slice(pairs, start + 1, end - start)
        return F.struct(F.element_at(pairs, start + 1)["a"].alias("a"), F.element_at(pairs, end)["b"].alias("b"),
                        F.xxhash64(F.transform(own, lambda p: p["hash"])).alias("hash"),
                        (~F.exists(own, lambda p: p["twin"])).alias("plain"), own.alias("pairs"))

    return F.flatten(F.transform(ended, lambda s: F.transform(s["ends"], lambda end, k: chunk(
        s["pairs"], F.when(k == 0, F.lit(0)).otherwise(F.element_at(s["ends"], F.greatest(k, F.lit(1)))), end))))


def _with_first(rows: DataFrame, firsts: DataFrame, how: str) -> DataFrame:
    """``rows`` with the ``first`` place of their hash; the rows of a hot hash are spread over ``SALTS`` tasks."""
    spread = firsts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(spread, ["hash", "salt"], how).drop("salt")


def _firsts(rows: DataFrame) -> DataFrame:
    """hash, first (place of the first occurrence) of the hashes that occur more than once."""
    return rows.groupBy("hash").agg(F.count("*").alias("n"), F.min(F.struct(*_KEY, "a", "b")).alias("first")).where("n > 1").select("hash", "first")


def chunk_removals(docs: DataFrame) -> DataFrame:
    """doc_id, row_hash, gone (numbers of the lines to remove) of rows that lose some."""
    chunks = written(_keyed(docs).select(*_KEY, F.explode(_chunks(F.col("text"))).alias("c")).select(*_KEY, "c.*"), "line-chunks")
    # a null hash meets no first place: chunks with twin lines are always opened
    keyed = chunks.withColumn("hash", F.when(F.col("plain"), F.col("hash")))
    told = written(_with_first(keyed, _firsts(keyed.where("plain")), "left"), "told-chunks")
    discard(chunks)
    elsewhere = (F.col("doc_id") != F.col("first.doc_id")) | (F.col("row_hash") != F.col("first.row_hash"))
    copy = F.coalesce(elsewhere | (F.col("a") > F.col("first.a")), F.lit(False))
    opened = told.where(~copy).select(*_KEY, F.explode("pairs").alias("p")).select(*_KEY, "p.a", "p.b", "p.hash")
    pairs = written(_with_first(opened, _firsts(opened), "inner"), "line-pairs")
    span = [*_KEY, "a", "b", "hash"]
    again = told.where(copy).select(*span).unionByName(pairs.where(elsewhere | (F.col("a") > F.col("first.b"))).select(*span))
    # the bytes: all places of a hash must hold the same lines
    held = told.where("first IS NOT NULL").select(*span).unionByName(pairs.select(*span)).groupBy(*_KEY).agg(
        F.collect_set(F.struct("a", "b", "hash")).alias("spans"))
    bodies = F.transform(F.array(F.struct(F.split("text", "\n").alias("lines"), "spans")), lambda s: F.transform(s["spans"], lambda p: F.struct(
        p["hash"].alias("hash"), F.array_join(F.filter(F.slice(s["lines"], p["a"] + 1, p["b"] - p["a"] + 1), lambda x: x.rlike(_WORDED)), "\n").alias("body"))))
    places = _keyed(docs).join(held, _KEY).select(F.explode(F.flatten(bodies)).alias("p")).select("p.*")
    unlike = written(places.groupBy("hash", "body").agg(F.lit(1).alias("one")).groupBy("hash").count().where("count > 1").select("hash"), "unlike")
    if not unlike.isEmpty():
        again = again.join(unlike, "hash", "left_anti")
    return again.groupBy(*_KEY).agg(F.array_distinct(F.flatten(F.collect_list(F.sequence("a", "b")))).alias("gone"))


def dedup_chunks(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` (doc_id, text, ...) with the text that stays, and __n_removed, the lines removed."""
    return _without(docs, chunk_removals(docs))


#: DuckDB, over a table or view ``documents``: doc_id, n_removed lines and the text that stays
SQL = f"""
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM {{docs}}
), hashed AS (
  SELECT *, ('0x' || substr(md5(line), 1, 15))::BIGINT % {MODULUS} AS h FROM lines
), rolled AS (
  SELECT *, ((coalesce(lag(h, 2) OVER w, 0) * {FACTOR} + coalesce(lag(h, 1) OVER w, 0)) % {MODULUS} * {FACTOR} + h) % {MODULUS} AS r,
         max(i) OVER (PARTITION BY doc_id) AS n
  FROM hashed WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), marked AS (
  SELECT *, coalesce(sum(CASE WHEN r % {DIVISOR} = 0 OR i = n THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS no
  FROM rolled
), chunks AS (
  SELECT doc_id, no, count(*) AS lines, string_agg(line, chr(10) ORDER BY i) AS body FROM marked GROUP BY doc_id, no
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, no) AS place FROM chunks
), verdict AS (
  SELECT *, lines >= {MIN_LINES} AND regexp_matches(body, '[^\\x20\\x09-\\x0D]') AND place > 1 AS gone FROM ranked
), kept AS (
  SELECT doc_id, sum(CASE WHEN gone THEN lines ELSE 0 END)::BIGINT AS n_removed, coalesce(string_agg(body, chr(10) ORDER BY no) FILTER (NOT gone), '') AS body
  FROM verdict GROUP BY doc_id
)"""

#: the rule of ``dedup_chunks`` in DuckDB, over a table or view ``documents`` with one row a doc_id: doc_id, n_removed, body
RUNS_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM {docs}
), worded AS (
  SELECT doc_id, i, line, lead(i) OVER w AS j, lead(line) OVER w AS next FROM lines
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), placed AS (
  SELECT doc_id, i, j, first_value(doc_id) OVER p AS first_doc, first_value(j) OVER p AS first_j
  FROM worded WHERE j IS NOT NULL WINDOW p AS (PARTITION BY line, next ORDER BY doc_id, i)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, j + 1)) AS i FROM placed WHERE doc_id > first_doc OR i > first_j
), kept AS (
  SELECT l.doc_id, count(g.i)::BIGINT AS n_removed, coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (g.i IS NULL), '') AS body
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id
)"""
