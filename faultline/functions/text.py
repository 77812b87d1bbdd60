"""String expressions: month translation, fault type, node/zone labels, folding."""
from __future__ import annotations

import functools

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from faultline import config as C

__all__ = ["translate_month_es", "month_found", "replace_month", "fault_type", "node_label", "zone_label", "fold_accents",
           "normalise_node", "short_label", "sanitize_name", "as_col"]


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def translate_month_es(c) -> Column:
    """Lower-case; the first Spanish month (in map order) found is replaced
    everywhere by its English abbreviation; later months are not looked at.
    The month is found by a chain of cheap ``instr`` tests (codegen-friendly) and
    a single ``replace`` is applied."""
    low = F.lower(as_col(c))
    return replace_month(low, month_found(low))


def month_found(low) -> Column:
    """The first Spanish month (in map order) in a lower-case text, else NULL."""
    hit = F
    for es in C.MONTHS_ES_TO_EN:
        hit = hit.when(F.instr(as_col(low), es) > 0, F.lit(es))
    return hit


def replace_month(low, hit) -> Column:
    """``low`` with the month ``hit`` in English; unchanged where no month was found."""
    to_en = F.create_map(*[F.lit(x) for kv in C.MONTHS_ES_TO_EN.items() for x in kv])
    return F.coalesce(F.replace(as_col(low), as_col(hit), F.try_element_at(to_en, as_col(hit))), as_col(low))


def fault_type(summary) -> Column:
    """Last '/'-separated part, trimmed, upper-cased, first 30 characters.
    A missing summary gives DESCONOCIDO (decision Q2)."""
    last = F.element_at(F.split(as_col(summary), "/"), -1)
    return F.coalesce(F.substring(F.upper(F.trim(last)), 1, 30), F.lit(C.UNKNOWN))


def node_label(c, upper: bool = True, strip: bool = False) -> Column:
    """NULL -> DESCONOCIDO, then upper-case (tickets) or strip (heat map)."""
    x = F.coalesce(as_col(c), F.lit(C.UNKNOWN))
    if strip:
        x = F.trim(x)
    return F.upper(x) if upper else x


def zone_label(c=None) -> Column:
    """NULL zone -> DESCONOCIDO; no zone column at all -> GLOBAL. Trimmed (Q3)."""
    if c is None:
        return F.lit(C.GLOBAL_ZONE)
    return F.trim(F.coalesce(as_col(c), F.lit(C.UNKNOWN)))


def fold_accents(c, fold_enye: bool = True) -> Column:
    """Lower, fold ó ü í á (and ñ, decision Q1), trim."""
    src, dst = C.ACCENT_FROM, C.ACCENT_TO
    if fold_enye:
        src, dst = src + "ñ", dst + "n"
    return F.trim(F.translate(F.lower(as_col(c)), src, dst))


def normalise_node(c, fold_enye: bool = True) -> Column:
    """Accent fold plus the spelling exceptions; no exception's result triggers a later
    one, so the ordered rules are one CASE over the folded name."""
    base = fold_accents(c, fold_enye)
    out = F
    for needles, repl in C.NODE_SPELLING_EXCEPTIONS:
        hits = functools.reduce(lambda a, b: a & b, [F.instr(base, n) > 0 for n in needles])
        out = out.when(hits, F.lit(repl))
    return out.otherwise(base)


def short_label(c, n: int = 15) -> Column:
    """Display name cut to n characters."""
    return F.substring(as_col(c), 1, n)


_SANITIZE = re.compile(r"\[|\]|<")


def sanitize_name(name: str) -> str:
    """P25: '[', ']' and '<' become '_' in column names."""
    return _SANITIZE.sub("_", name)
