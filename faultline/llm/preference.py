"""Preference formatting: one prompt and a pair of masked completions.

``chosen`` and ``rejected`` are turn tables (a pair's key, turn, role, text). Both sides of a
pair are ordered by turn; their longest common prefix of equal turns (role and text) is
rendered once as the prompt, what follows on each side as its completion. Every turn is

    <|im_start|>role\\ntext<|im_end|>\\n

and a completion's mask names the characters that training counts: the text and end mark of
its assistant turns, as "start-end" spans of code points, comma-separated.

Cases: null role and text are empty; rows with a null key are left out; turns of equal
number are ordered by role and text; pairs without either side are left out; equal sides
have empty completions; an empty side (no turns) can't occur; other columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAD, SEP, TAIL = "<|im_start|>", "\n", "<|im_end|>"


def _turns(table: DataFrame, key: str, name: str) -> DataFrame:
    """key and its turns in order, as an array of (role, text)."""
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    gathered = table.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("pair")).agg(F.array_sort(F.collect_list(turn)).alias("t"))
    return gathered.select("pair", F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias(name))


def _render(turns):
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(HEAD), t["role"], F.lit(SEP), t["text"], F.lit(TAIL + "\n"))), "")


def _mask(turns):
    """Spans of the assistant's texts and end marks in the rendered turns."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(total, t):
        start = total["at"] + len(HEAD) + F.length(t["role"]) + len(SEP)
        end = start + F.length(t["text"]) + len(TAIL)
        span = F.concat(start.cast("string"), F.lit("-"), end.cast("string"))
        return F.struct((end + 1).alias("at"), F.when(t["role"] == "assistant", F.concat(total["spans"], F.array(span))).otherwise(total["spans"]).alias("spans"))

    return F.array_join(F.aggregate(turns, zero, step)["spans"], ",")


def _formatted(pairs: DataFrame) -> DataFrame:
    least = F.least(F.size("chosen"), F.size("rejected"))
    differs = F.filter(F.sequence(F.lit(1), least), lambda i: F.element_at("chosen", i) != F.element_at("rejected", i))
    common = pairs.withColumn("n_common", F.when(F.size(differs) > 0, differs[0] - 1).otherwise(least))
    rest = lambda c: F.slice(c, F.col("n_common") + 1, F.size(c))
    return common.select(
        "pair", F.col("n_common").cast("long").alias("n_common"), _render(F.slice("chosen", 1, F.col("n_common"))).alias("prompt"),
        _render(rest("chosen")).alias("chosen"), _mask(rest("chosen")).alias("chosen_mask"),
        _render(rest("rejected")).alias("rejected"), _mask(rest("rejected")).alias("rejected_mask"))


def format_pairs(chosen: DataFrame, rejected: DataFrame, key: str) -> DataFrame:
    """pair, n_common, prompt, chosen, chosen_mask, rejected, rejected_mask of every pair."""
    return _formatted(_turns(chosen, key, "chosen").join(_turns(rejected, key, "rejected"), "pair"))


def format_conversations(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """Pairs made of single conversations: chosen is the conversation up to its last assistant
    turn; rejected has, in that turn's place, what was said right before it by the same
    side, else the turn before it (a stale answer, or an echo). Conversations without an
    assistant turn that follows another turn give no pair."""
    own = _turns(turns, key, "all")
    last = F.array_max(F.transform("all", lambda t, i: F.when(t["role"] == "assistant", i).otherwise(-1)))
    cut = own.withColumn("last", last).where("last > 0").withColumn("before", F.expr("slice(all, 1, last)"))
    stale = F.filter("before", lambda t: t["role"] == "assistant")
    text = F.when(F.size(stale) > 0, F.element_at(stale, -1)["text"]).otherwise(F.element_at("before", -1)["text"])
    reply = F.struct(F.lit("assistant").alias("role"), text.alias("text"))
    return _formatted(cut.select("pair", F.expr("slice(all, 1, last + 1)").alias("chosen"), F.concat("before", F.array(reply)).alias("rejected")))


#: DuckDB, for format_conversations over ``conversations``
SQL = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), last AS (
  SELECT conv_id, max(i) FILTER (role = 'assistant') AS l FROM turns GROUP BY conv_id
), kept AS (
  SELECT t.*, l FROM turns t JOIN last USING (conv_id) WHERE l > 1 AND i <= l
), stale AS (
  SELECT conv_id, coalesce(arg_max(text, i) FILTER (role = 'assistant'), arg_max(text, i)) AS reply FROM kept WHERE i < l GROUP BY conv_id
), sides AS (
  SELECT k.conv_id, i, l, role, text, CASE WHEN i = l THEN reply ELSE text END AS other FROM kept k JOIN stale USING (conv_id)
), common AS (
  SELECT *, min(CASE WHEN text <> other THEN i END) OVER (PARTITION BY conv_id) AS d,
         '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS a, '<|im_start|>' || role || chr(10) || other || '<|im_end|>' || chr(10) AS b,
         13 + length(role) AS s
  FROM sides
)
SELECT conv_id AS pair, coalesce(min(d) - 1, max(l))::BIGINT AS n_common, coalesce(string_agg(a, '' ORDER BY i) FILTER (d IS NULL OR i < d), '') AS prompt,
       coalesce(string_agg(a, '' ORDER BY i) FILTER (i >= d), '') AS chosen, coalesce(string_agg(s || '-' || (s + length(text) + 10), ',') FILTER (i >= d), '') AS chosen_mask,
       coalesce(string_agg(b, '' ORDER BY i) FILTER (i >= d), '') AS rejected, coalesce(string_agg(s || '-' || (s + length(other) + 10), ',') FILTER (i >= d), '') AS rejected_mask
FROM common GROUP BY conv_id"""
