"""Helpers shared by the training-data operators.

Conventions that hold for every operator here:

* input columns are selected first, so extra columns with clashing names
  never reach a join;
* a NULL ``doc_id`` sorts after every other id and comes back as NULL
  (``id_key`` / ``id_back``);
* NULL text counts as empty unless the operator says otherwise;
* words are the maximal runs outside ``[\\x20\\x09-\\x0D]``. Python's
  ``bytes.split()`` splits on exactly these six bytes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path

MAX_ID = (1 << 63) - 1
WORD = r"[^\x20\x09-\x0D]+"
_P1, _P2 = 2147483629, 2147483647  # primes
SPACES = " \t\n\x0b\x0c\r"


def one_row_per_id(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, text) with one row per id. Where rows repeat an id, the
    greatest text by code point stands; the usual table without repeats is
    returned as it is, so its texts are not shuffled."""
    n, ids = rows.agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
    return rows if n == ids else rows.groupBy("doc_id").agg(F.max("text").alias("text"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_key(col: str = "doc_id") -> Column:
    return F.coalesce(F.col(col).cast("long"), F.lit(MAX_ID))


def id_back(col: str = "doc_id") -> Column:
    return F.nullif(F.col(col), F.lit(MAX_ID)).alias(col)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back: a
    lineage cut that survives executor loss. The folder is removed when the
    driver's JVM exits."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return spark.read.schema(df.schema).parquet(path)


def exchanged(df: DataFrame) -> DataFrame:
    """``df`` as one side of a join whose two sides both grow with the input: it is exchanged by key, never sent to the
    driver to be broadcast. Spark would go by the bytes of packed Parquet files or by row sizes that it supposes, which
    know neither how long arrays are nor how many rows a join or an explode makes of one."""
    return df.hint("merge")


def share(spark: SparkSession, value):
    """Broadcast ``value`` (of proven size) to the tasks; the returned function gives it back there. Pickled by
    value, so its classes need not be importable on the workers."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: cloudpickle.loads(sent.value)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_count(spark: SparkSession, total_bytes: int, bytes_per_bucket: int = 4 << 20) -> int:
    """Buckets for the packed shuffles: several per shuffle partition, and
    enough that one bucket stays small whatever the partition count is."""
    return max(4 * partitions(spark), math.ceil((total_bytes or 0) / bytes_per_bucket), 1)


def home_column(doc_id: Column, homes: int) -> Column:
    """Home partition of a document id, the same as ``home_of``."""
    return F.pmod(F.pmod(doc_id, F.lit(_P1)) * 48271, F.lit(_P2)) % homes


def home_of(docs: np.ndarray, homes: int) -> np.ndarray:
    return docs % _P1 * 48271 % _P2 % homes


def pack_pairs(docs: np.ndarray, values: np.ndarray) -> bytes:
    """Packed (document, 64-bit value) pairs, sorted by document."""
    order = np.argsort(docs, kind="stable")
    return pack(values[order], 8) + pack(deltas(docs[order]), 8)


def unpack_pairs(blob: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(unpack(blob[8 * n:], n, 8, np.int64)), unpack(blob[:8 * n], n, 8)


def split_runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Start of every run of equal values, plus the end."""
    if not len(sorted_keys):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1, [len(sorted_keys)]])


def pairs_by_home(docs: np.ndarray, values: np.ndarray, homes: int):
    """(home, n, packed pairs) for every home among ``docs``."""
    home = home_of(docs, homes)
    order = np.argsort(home, kind="stable")
    home, docs, values = home[order], docs[order], values[order]
    runs = split_runs(home)
    for a, b in zip(runs[:-1], runs[1:]):
        yield int(home[a]), int(b - a), pack_pairs(docs[a:b], values[a:b])


def values_of(docs: np.ndarray, blobs: list[tuple[int, bytes]]) -> list[np.ndarray]:
    """For each document of ``docs`` its values among packed pairs."""
    if not blobs:
        return [np.empty(0, np.uint64)] * len(docs)
    parts = [unpack_pairs(b, n) for n, b in blobs]
    d, v = np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts])
    order = np.argsort(d, kind="stable")
    d, v = d[order], v[order]
    lo, hi = np.searchsorted(d, docs, "left"), np.searchsorted(d, docs, "right")
    return [v[a:b] for a, b in zip(lo, hi)]


def text_bytes(df: DataFrame, col: str = "text") -> int:
    return df.agg(F.sum(F.octet_length(col).cast("long"))).first()[0] or 0


def byte_rows(column: pa.Array | pa.ChunkedArray) -> list:
    """UTF-8 bytes (or None) of a string column."""
    return column.cast(pa.binary()).to_pylist()


def texts(batches, rows: int = 256, as_bytes: bool = True):
    """(first column, text of the second) of every row, a few rows of a record batch in memory at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield from zip(part.column(0).to_pylist(), byte_rows(part.column(1)) if as_bytes else part.column(1).to_pylist())


def pack(values: np.ndarray, width: int) -> bytes:
    """Byte planes of an integer array: little-endian, ``width`` bytes each,
    all lowest bytes first. Constant planes vanish in the shuffle's LZ4."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1)
    return np.ascontiguousarray(raw[:, :width].T).tobytes()


def unpack(blob: bytes, n: int, width: int, dtype=np.uint64) -> np.ndarray:
    full = np.zeros((n, 8), np.uint8)
    full[:, :width] = np.frombuffer(blob, np.uint8).reshape(width, n).T
    return full.view(np.uint64).reshape(n).astype(dtype, copy=False)


def deltas(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=values.dtype.type(0))


# ---------------------------------------------------------------- rolling hash
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads the polynomial's weak low bits over the word."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Rolling:
    """Rabin-Karp hashes of every ``width``-word window by prefix sums:
    with P(i) = sum of w(k) * B**k the window at i hashes to
    (P(i + width) - P(i)) * B**-i, all modulo 2**64."""

    def __init__(self, width: int):
        self.width = width
        self.pow = np.ones(1, np.uint64)
        self.inv = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.pow) < n:
            m = max(n, 2 * len(self.pow))
            with np.errstate(over="ignore"):
                self.pow = np.concatenate([[np.uint64(1)], np.cumprod(np.full(m, _BASE, np.uint64))])
                self.inv = np.concatenate([[np.uint64(1)], np.cumprod(np.full(m, _INV, np.uint64))])

    def __call__(self, words: np.ndarray) -> np.ndarray:
        """Hashes of the windows of one word-hash array (empty when it is
        shorter than a window)."""
        n, w = len(words), self.width
        if n < w:
            return np.empty(0, np.uint64)
        self._grow(n + 1)
        with np.errstate(over="ignore"):
            p = np.empty(n + 1, np.uint64)
            p[0] = 0
            np.cumsum(words * self.pow[:n], out=p[1:])
            return mix64((p[w:] - p[:-w]) * self.inv[:n - w + 1])
