"""Helpers shared by the operators: table loading, spans, written tables, and
vectorised word hashing in numpy."""

from __future__ import annotations

import hashlib
import os
import zlib
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import fs_delete, scratch_dir

#: ASCII white space of the word definition ``[^\x20\x09-\x0D]+``.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``df.mapInArrow`` with this package on the Python workers' path (where it isn't installed or shipped)."""
    env = df.sparkSession.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH")) if x)
    return df.mapInArrow(fn, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder (cuts lineage and survives lost executors)."""
    spark = df.sparkSession
    path = scratch_dir(spark, tag)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``written`` returned; no frame that is still to run may read them."""
    for df in tables:
        fs_delete(df.sparkSession, df.scratch_path)


@contextmanager
def tidy_shuffles(spark: SparkSession):
    """Shuffle files of the queries that run inside go with their query, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def hash_sample(df: DataFrame, n_rows: int, rows: int, max_bytes: int, by: list[str], text: str) -> DataFrame:
    """At most ``rows`` distinct rows of ``df`` (of ``n_rows``), those with the smallest hash of ``by``, by that hash,
    while their texts have ``max_bytes`` together (the first one always).

    Only rows below a hash that about two times ``rows`` are below leave their
    tasks, so what moves doesn't grow with the rows or the partitions.
    """
    picked = df.withColumn("_h", F.xxhash64(*by))
    if n_rows > 2 * rows:
        picked = picked.where(F.col("_h") < int(-(2**63) + 2**64 * (2 * rows / n_rows)))
    picked = picked.groupBy("_h").agg(F.min(F.struct(*df.columns)).alias("_r")).orderBy("_h").limit(rows).select("_h", "_r.*")
    total = F.sum(F.coalesce(F.octet_length(text), F.lit(0))).over(Window.orderBy("_h"))  # over at most ``rows`` rows
    first = F.row_number().over(Window.orderBy("_h")) == 1
    return picked.withColumn("_b", total).withColumn("_f", first).where(F.col("_f") | (F.col("_b") <= max_bytes)).orderBy("_h").select(*df.columns)


def crc_mod(key, m: int) -> int:
    """crc32 of the key as text, modulo ``m`` (null: the crc of an empty text)."""
    return zlib.crc32(b"" if key is None else str(key).encode()) % m


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def span_string(spans: Iterable[tuple[int, int, int, str]]) -> str:
    """``kind:start:end`` joined by commas, by start, then by the kind's rank.

    ``spans`` are ``(start, rank, end, kind)``.
    """
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(spans))


# ------------------------------------------------------------ word hashing
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACES)] = True
_IS_LETTER = np.zeros(256, dtype=bool)
_IS_LETTER[97:123] = True
_IS_LETTER[65:91] = True
_IS_LETTER[128:] = True
_BYTE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_POW: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, ``n`` at least; kept for the worker's life up to 4M entries."""
    if len(_POW[0]) < n:
        size = max(n, 1 << 18)
        out = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        if size > 4_000_000:
            return out[0], out[1]
        _POW[:] = out
    return _POW[0], _POW[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit hashes."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    d = np.diff(mask.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)


class Hasher:
    """Polynomial hashes of any byte range of one buffer, by prefix sums."""

    def __init__(self, data: np.ndarray):
        power, self.inverse = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * power[: len(data)], out=self.sums[1:])

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        return mix(h + (ends - starts).astype(np.uint64))


def blocks(batches: Iterator, text_at: int, max_bytes: int = 1 << 20) -> Iterator[tuple[object, int, int, list[bytes]]]:
    """Sub-batches of at most ``max_bytes`` of text (a longer text alone): ``(batch, from, to, texts)``.

    Whole texts always; a null text is empty.  Memory is bounded by the
    sub-batch or the longest single text.
    """
    for b in batches:
        col = b.column(text_at)
        n, at = b.num_rows, 0
        while at < n:
            size, to, texts = 0, at, []
            while to < n:
                v = col[to].as_py()
                v = b"" if v is None else v.encode("utf-8", "surrogatepass")
                if texts and size + len(v) > max_bytes:
                    break
                texts.append(v)
                size += len(v)
                to += 1
            yield b, at, to, texts
            at = to


def words_of(texts: list[bytes], lower: bool = True, letters: bool = False):
    """Words of several texts at once.

    Returns ``(data, starts, ends, counts)``: the buffer, each word's byte
    range in it, and the number of words per text.  Words are runs of
    non-space bytes, or of letters (A-Z, a-z and all non-ASCII) if ``letters``.
    """
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    if lower:
        data = _LOWER[data]
    starts, ends = runs(_IS_LETTER[data] if letters else ~_IS_SPACE[data])
    size = np.array([len(t) + 1 for t in texts], np.int64)
    edges = np.cumsum(size)
    counts = np.diff(np.searchsorted(starts, edges), prepend=0)
    return data, starts, ends, counts
