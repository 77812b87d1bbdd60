"""Helpers shared by the operators of this subpackage."""
from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

#: distinct words whose hashes a Python worker keeps (some 30 MB), for all operators together
WORD_CACHE = 200_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share (``spark.checkpoint.dir``). Only a local
    master may go without one: there the driver is the only executor."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    set_dir = spark.sparkContext.getCheckpointDir()
    if set_dir:
        return set_dir.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="faultline-llm-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: the lineage ends
    there, and a lost executor costs no recomputation of what lies before."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.faultline_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a table made by ``written`` that no later plan reads."""
    jvm = df.sparkSession.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(df.faultline_path)
    path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def as_bytes(column: pa.Array) -> list:
    """A string column's UTF-8 bytes, null as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


class WordHashes(dict):
    """word (bytes) -> its 64-bit hash as 8 bytes, remembered up to ``WORD_CACHE`` words."""

    def __missing__(self, word: bytes) -> bytes:
        found = xxhash.xxh3_64_digest(word)
        if len(word) <= 64:
            if len(self) >= WORD_CACHE:
                self.clear()
            self[word] = found
        return found

    def of(self, words: list) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, words)), np.uint64)


_WORDS = WordHashes()


def word_hashes(words: list) -> np.ndarray:
    """The hashes of some words, by the one cache that all operators of a worker share."""
    return _WORDS.of(words)


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: a bijection that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every run of k word hashes. Doubling: a run of length a+b is
    mixed from the runs of length a and b, so it takes log2(k) passes."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    runs, have, out, used = mix(hashes), 1, None, 0
    rest = k
    while rest:
        if rest & 1:
            part = runs[used:used + n] if out is not None else runs[:n]
            out = part.copy() if out is None else mix(out * np.uint64(0x9E3779B97F4A7C15) + part)
            used += have
        rest >>= 1
        if rest:
            runs = mix(runs[:-have] * np.uint64(0xD6E8FEB86659FD93) + runs[have:])
            have *= 2
    return out


def signed(x: np.ndarray) -> np.ndarray:
    """uint64 as Spark's long."""
    return x.view(np.int64)
