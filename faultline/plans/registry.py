"""Query registry: name -> (Spark callable, optional DuckDB oracle SQL)."""
from __future__ import annotations

import functools
import json
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.session import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
ROUND_DIGITS = 6
_DOUBLES_FILE = os.path.join(os.path.dirname(__file__), "oracle_doubles.json")


def _double_columns() -> dict:
    try:
        with open(_DOUBLES_FILE) as fh:
            return json.load(fh)
    except FileNotFoundError:
        return {}


def wrapped_oracles() -> dict[str, str]:
    """Oracle SQL with every double output column rounded to 6 places (and -0.0
    folded to 0.0), mirroring ``finalize`` on the Spark side. The double column
    lists are taken from the Spark schemas (see tools/oracle_check.py)."""
    doubles = _double_columns()
    out = {}
    for name, sql in ORACLES.items():
        cols = doubles.get(name) or []
        if cols:
            rep = ", ".join(f'round("{c}", {ROUND_DIGITS}) + 0.0 AS "{c}"' for c in cols)
            out[name] = f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) AS oracle_q"
        else:
            out[name] = sql
    return out


def finalize(df: DataFrame) -> DataFrame:
    """Round doubles (and cast decimals) to 6 places so both engines hash alike."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            # same arithmetic as DuckDB's round(x, 6): round(x * 1e6) / 1e6
            scale = float(10 ** ROUND_DIGITS)
            c = F.round(c.cast("double") * F.lit(scale), 0) / F.lit(scale) + F.lit(0.0)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame``; its output is finalised."""
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return finalize(fn(Tables(spark, sf_dir)))
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


class Tables:
    """Lazy access to the driver tables of one scale-factor folder, plus the
    proxy contract tables derived from them (built once per query)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.sf_dir, name)
        return self._cache[name]

    def memo(self, key: str, build):
        if key not in self._cache:
            self._cache[key] = build()
        return self._cache[key]
