"""Substring dedup: Rabin-Karp hashes of every fixed-length word window.

A window of ``width`` (13) consecutive words is removed from a document when
the same word sequence also starts in a document with a smaller ``doc_id``.
Windows are judged on the input. The words that removed windows cover merge
into maximal intervals.

1. Scan: each task hashes every window of every whole text with a rolling
   64-bit hash, block of documents by block. Inside a block a hash is settled
   for all documents but the smallest that holds it; only that one is shipped,
   so a window that a third of all documents share costs one entry a block.
   Entries travel as packed byte planes, keyed by the hash's range bucket.
2. Count: a reducer takes one hash range, finds the smallest document of each
   hash and reports (document, hash) pairs that start in a smaller one, packed
   by the documents' home partition.
3. Removal: reports meet the texts of their home (a home with an id that many rows
   repeat is split, its reports go to every part); the windows are hashed again,
   flagged by hash and merged. Reporting hashes instead of positions keeps rows
   that repeat an id with another text apart.

Hashes are 64 bits: among n windows about n**2 / 2**65 pairs collide by
chance, two pairs for the 8e9 windows of 30 GB; one removes at most 13 words.

Cases: NULL text has no words; texts shorter than a window keep all words;
repeated rows with one id never remove each other; NULL ids sort last (and
count as one id); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (Rolling, bucket_count, byte_rows, home_column, id_back, id_key, pack_pairs, pairs_by_home, split_runs,
                     text_bytes, texts, unpack_pairs, values_of)

BLOCK_WINDOWS = 1_000_000
# packed pairs: to be counted (home is NULL) or already settled for the documents of a home
_SHIPPED = "bucket long, home long, n long, pairs binary"
_SHIPPED_PA = pa.schema([("bucket", pa.int64()), ("home", pa.int64()), ("n", pa.int64()), ("pairs", pa.binary())])
_FLAGS = "home long, n long, pairs binary"
_FLAGS_PA = pa.schema([("home", pa.int64()), ("n", pa.int64()), ("pairs", pa.binary())])


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """Range bucket of a hash by its top 32 bits."""
    return ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _block(ids: list[int], arrays: list[np.ndarray], buckets: int, homes: int) -> pa.RecordBatch:
    doc = np.repeat(np.array(ids, np.int64), [len(a) for a in arrays])
    h = np.concatenate(arrays)
    order = np.argsort(h, kind="stable")
    hs, ds = h[order], doc[order]
    starts = split_runs(hs)
    first = np.minimum.reduceat(ds, starts[:-1])
    settled = ds > np.repeat(first, np.diff(starts))
    # one shipped entry a hash: its smallest document
    uh = hs[starts[:-1]]
    b = bucket_of(uh, buckets)
    cuts = split_runs(b)  # hashes are sorted, so buckets are runs
    rows = [(int(b[x]), None, int(y - x), pack_pairs(first[x:y], uh[x:y])) for x, y in zip(cuts[:-1], cuts[1:])]
    rows += [(home % buckets, home, n, p) for home, n, p in pairs_by_home(ds[settled], hs[settled], homes)]
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _SHIPPED_PA)], schema=_SHIPPED_PA)


def _scan(width: int, buckets: int, homes: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll, ids, arrays, held = Rolling(width), [], [], 0
        for d, t in texts(batches):
            words = (t or b"").split()
            if len(words) < width:
                continue
            a = roll(word_hashes(words))
            ids.append(d)
            arrays.append(a)
            held += len(a)
            if held >= block:
                yield _block(ids, arrays, buckets, homes)
                ids, arrays, held = [], [], 0
        if held:
            yield _block(ids, arrays, buckets, homes)
    return run


def _reduce(homes: int):
    def run(t: pa.Table) -> pa.Table:
        rows, parts = [], []
        for home, n, p in zip(*(t.column(c).to_pylist() for c in ("home", "n", "pairs"))):
            if home is None:
                parts.append(unpack_pairs(p, n))
            else:
                rows.append((home, n, p))
        if parts:
            d, h = np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts])
            del parts
            order = np.argsort(h, kind="stable")
            h, d = h[order], d[order]
            starts = split_runs(h)
            late = d > np.repeat(np.minimum.reduceat(d, starts[:-1]), np.diff(starts))
            rows += pairs_by_home(d[late], h[late], homes)
        cols = list(zip(*rows)) or [()] * 3
        return pa.Table.from_arrays([pa.array(c, t.type) for c, t in zip(cols, _FLAGS_PA)], schema=_FLAGS_PA)
    return run


def repeated_windows(docs: DataFrame, buckets: int, homes: int, width: int = 13, block: int = BLOCK_WINDOWS) -> DataFrame:
    """home, n, pairs: packed (doc_id, 64-bit hash) of the windows that also start in a smaller document."""
    return (docs.mapInArrow(_scan(width, buckets, homes, block), _SHIPPED).groupBy("bucket")
            .applyInArrow(_reduce(homes), _FLAGS))


_OUT = "doc_id long, n_words long, n_removed long, kept string, removed array<struct<start:long,end:long>>"
_OUT_PA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()),
                     ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def intervals(flagged: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Maximal word intervals that the flagged window starts cover."""
    at = np.flatnonzero(flagged)
    if not len(at):
        return []
    gap = np.flatnonzero(at[1:] > at[:-1] + width) + 1
    lo = at[np.concatenate([[0], gap])]
    hi = at[np.concatenate([gap - 1, [len(at) - 1]])] + width
    return list(zip(lo.tolist(), hi.tolist()))


def _remove(width: int):
    def run(docs: pa.Table, flags: pa.Table) -> pa.Table:
        roll = Rolling(width)
        out: dict[str, list] = {k: [] for k in _OUT_PA.names}
        ids = docs.column("doc_id").to_numpy()
        known = values_of(ids, list(zip(flags.column("n").to_pylist(), flags.column("pairs").to_pylist())))
        for d, t, f in zip(ids.tolist(), byte_rows(docs.column("text")), known):
            words = (t or b"").split()
            spans, kept = [], words
            if len(f):
                spans = intervals(np.isin(roll(word_hashes(words)), f), width)
                kept, end = [], 0
                for a, b in spans:
                    kept += words[end:a]
                    end = b
                kept += words[end:]
            row = (d, len(words), len(words) - len(kept), b" ".join(kept).decode(), [{"start": a, "end": b} for a, b in spans])
            for k, v in zip(out, row):
                out[k].append(v)
        return pa.Table.from_pydict(out, schema=_OUT_PA)
    return run


def home_splits(rows: DataFrame, homes: int, home_bytes: int) -> DataFrame | None:
    """home, parts: homes that an id with more than ``home_bytes`` of text (in rows that repeat it) is dealt over. Fewer
    rows than the corpus has times ``home_bytes``. None when no id repeats."""
    n, ids = rows.agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
    if n == ids:
        return None
    size = rows.groupBy("doc_id").agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))).cast("long")).alias("bytes"), F.count(F.lit(1)).alias("n"))
    hot = size.where((F.col("bytes") + 64 * F.col("n") > home_bytes) & (F.col("n") > 1))
    parts = F.ceil((F.col("bytes") + 64 * F.col("n")) / home_bytes)
    return hot.select(home_column(F.col("doc_id"), homes).alias("home"), parts.alias("parts")).groupBy("home").agg(F.max("parts").alias("parts"))


def remove_repeats(docs: DataFrame, width: int = 13, block: int = BLOCK_WINDOWS, home_bytes: int = 16 << 20) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the kept words joined by one blank), removed (word intervals, end
    exclusive) of every row."""
    rows = docs.select(id_key().alias("doc_id"), "text")
    buckets = bucket_count(docs.sparkSession, text_bytes(rows))
    homes = -(-buckets // 4)   # about 16 MB of text each
    flags = repeated_windows(rows, buckets, homes, width, block)
    placed, keys = rows.withColumn("home", home_column(F.col("doc_id"), homes)), ["home"]
    splits = home_splits(rows, homes, home_bytes)
    if splits is not None:      # rows of a home are dealt over its parts, its flags go to each of them
        splits = F.broadcast(splits)
        parts = F.coalesce("parts", F.lit(1).cast("long"))
        placed = placed.join(splits, "home", "left").withColumn("part", F.pmod(F.monotonically_increasing_id(), parts)).drop("parts")
        flags = flags.join(splits, "home", "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("parts")
        keys = ["home", "part"]
    out = placed.groupBy(*keys).cogroup(flags.groupBy(*keys)).applyInArrow(_remove(width), _OUT)
    return out.select(id_back(), "n_words", "n_removed", "kept", "removed")
