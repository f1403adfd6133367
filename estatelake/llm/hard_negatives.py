"""Hard negatives for contrastive training, scored by Kronecker-packed products.

Vectors are quantised to integers, so a score is an exact integer inner
product. Components are shifted by the table's smallest one, which makes them
non-negative; the components of several candidates go into separated bit
fields of one wide integer, wide enough that a sum over all dimensions cannot
leave its field. One multiplication per anchor component then serves all
candidates of a word, and the fields are unpacked and shifted back to the exact
scores:

    sum((x - lo) * (a - lo)) = sum(x * a) - lo * (sum(x) + sum(a)) + dims * lo**2

* A double holds every integer up to 2**53, so when at least one field fits
  53 bits the wide integers are doubles (two 24-bit fields for 64 components
  of 9 bits) and the multiply-adds are one matrix product, exact because no
  partial sum exceeds 53 bits.
* Otherwise the wide integers are Python's, with a whole block of candidates in
  one of them. Both forms give the same scores; the range of the data decides.

Anchors against all rows are a grid: rows lie in parts, anchors in groups, both
bounded in bytes, and every (part, group) meets once and sends at most ``keep``
candidates per anchor on. Positives are only looked for among rows of the label's
own bucket (labels are spread over as many buckets as there are parts; a bucket of
any size is cut into parts, so a label that holds most rows is spread too). A second
pass looks for the negatives in the windows that the positives' scores set.

Sizes: broadcast is one row per bucket, that is per ``block_bytes`` of vectors.

Cases: rows with a NULL label, a NULL vector or a NULL or non-finite component
take no part; shorter vectors count as padded with zeros; rows that repeat a
vec_id are rows of their own (each can be the other's positive, ordered by label
and place in the table); NULL ids are never anchors and sort last among ties;
anchors without positives, and positives without negatives in their window,
give no row; scores saturate at +-2**62; an empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, partitions
from .sharding import number_rows

EXACT = 53               # bits of the integers that a double holds exactly
MOST = 1 << 62
LOW, HIGH = -MOST - 1, MOST + 1
CELLS = 1 << 22          # scores held at a time


class Packing:
    """How candidates share wide integers: fields of ``bits`` bits, ``fields`` of them in a double, or any number in a
    Python integer when not even one fits."""

    def __init__(self, lo: int, hi: int, dims: int):
        self.lo, self.dims = lo, dims
        self.bits = max(1, (dims * (hi - lo) ** 2).bit_length())
        exact = dims * max(abs(lo), abs(hi)) ** 2 < MOST
        self.fields = EXACT // self.bits if exact else 0

    def scores(self, rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
        """anchors x rows, exact. Both are integer matrices with ``dims`` columns."""
        return self._doubles(rows, anchors) if self.fields else self._wide(rows, anchors)

    def _doubles(self, rows, anchors):
        m = len(rows)
        words = -(-m // self.fields)
        packed = np.zeros((words, self.dims))
        for f in range(self.fields):
            part = rows[f * words:(f + 1) * words]
            packed[:len(part)] += (part - self.lo).astype(np.float64) * float(1 << (f * self.bits))
        product = ((anchors - self.lo).astype(np.float64) @ packed.T).astype(np.int64)
        out = np.empty((len(anchors), words * self.fields), np.int64)
        for f in range(self.fields):
            out[:, f * words:(f + 1) * words] = (product >> (f * self.bits)) & ((1 << self.bits) - 1)
        out = out[:, :m]
        out += self.lo * (rows.sum(1)[None, :] + anchors.sum(1)[:, None]) - self.dims * self.lo ** 2
        return out

    def _wide(self, rows, anchors):
        m, width = len(rows), -(-self.bits // 8)
        ints = rows.tolist()
        packed = [int.from_bytes(b"".join((x[d] - self.lo).to_bytes(width, "little") for x in ints), "little") for d in range(self.dims)]
        sums = [sum(x) for x in ints]
        out = np.empty((len(anchors), m), np.int64)
        for i, a in enumerate(anchors.tolist()):
            total = sum(p * (c - self.lo) for p, c in zip(packed, a)).to_bytes(width * m, "little")
            own = self.lo * sum(a) - self.dims * self.lo ** 2
            out[i] = [max(-MOST, min(MOST, int.from_bytes(total[j * width:(j + 1) * width], "little") + self.lo * s + own))
                      for j, s in enumerate(sums)]
        return out


class Best:
    """The best ``k`` candidates of each anchor in each of its score windows. Candidates come in the order that
    decides ties, so a later one has to score higher."""

    def __init__(self, least: np.ndarray, most: np.ndarray, k: int):
        self.least, self.most, self.k = least, most, k                     # anchors x windows, both inclusive
        self.score = np.full((*least.shape, k), LOW, np.int64)
        self.at = np.full((*least.shape, k), -1, np.int64)

    def add(self, scores: np.ndarray, base: int, fits) -> None:
        floor = np.maximum(self.score[:, :, -1], self.least - 1)
        a, c = np.nonzero((scores > floor.min(1)[:, None]) & (scores <= self.most.max(1)[:, None]))
        ok = fits(a, c)
        a, c = a[ok], c[ok]
        v = scores[a, c]
        for j in range(floor.shape[1]):
            m = (v > floor[a, j]) & (v <= self.most[a, j])
            if not m.any():
                continue
            hit = np.unique(a[m])
            old = self.at[hit, j] >= 0
            who = np.concatenate([np.repeat(hit, old.sum(1)), a[m]])
            score = np.concatenate([self.score[hit, j][old], v[m]])
            at = np.concatenate([self.at[hit, j][old], base + c[m]])
            order = np.lexsort((at, -score, who))
            who, score, at = who[order], score[order], at[order]
            start = np.concatenate([[True], who[1:] != who[:-1]])
            nth = np.arange(len(who)) - np.maximum.accumulate(np.where(start, np.arange(len(who)), 0))
            top = nth < self.k
            self.score[who[top], j, nth[top]] = score[top]
            self.at[who[top], j, nth[top]] = at[top]


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    lists = column.combine_chunks()
    n, flat = pc.list_value_length(lists).to_numpy(zero_copy_only=False), pc.list_flatten(lists).to_numpy(zero_copy_only=False)
    if (n == dims).all():
        return flat.reshape(len(n), dims)
    out = np.zeros((len(n), dims), np.int64)
    out[np.arange(dims)[None, :] < n[:, None]] = flat
    return out


def _search(packing: Packing, k: int, windows, same: bool):
    """Best candidates of one group of anchors in one part of the rows: (anchor number, window, place in the sorted
    part, score), and the part's sorted table."""
    def run(rows: pa.Table, anchors: pa.Table):
        rows = rows.sort_by("key")
        x, y = _matrix(rows["v"], packing.dims), _matrix(anchors["v"], packing.dims)
        key, akey = rows["key"].to_numpy(), anchors["key"].to_numpy()
        label, alabel = rows["label"].to_numpy(), anchors["label"].to_numpy()
        best, step = Best(*windows(anchors), k), max(64, CELLS // max(1, len(y)))
        for at in range(0, len(x), step):
            best.add(packing.scores(x[at:at + step], y), at,
                     lambda a, c: ((alabel[a] == label[at + c]) == same) & (akey[a] != key[at + c]))  # noqa: B023
        a, j, _ = found = np.nonzero(best.at >= 0)
        return rows, a, j, best.at[found], best.score[found]
    return run


_NEAR = "anchor long, anchor_id long, near long, near_id long, score long"


def _nearest(packing: Packing, k: int):
    def all_scores(anchors):
        return np.full((len(anchors), 1), LOW + 1), np.full((len(anchors), 1), HIGH - 1)

    search = _search(packing, k, all_scores, True)

    def run(rows, anchors):
        if not rows.num_rows or not anchors.num_rows:
            return pa.schema([(c.split()[0], pa.int64()) for c in _NEAR.split(", ")]).empty_table()
        rows, a, _, at, score = search(rows, anchors)
        return pa.table({"anchor": anchors["key"].take(a), "anchor_id": anchors["vec_id"].take(a), "near": rows["key"].take(at),
                         "near_id": rows["vec_id"].take(at), "score": score})
    return run


_HARD = ("anchor long, anchor_id long, nth long, positive_id long, positive_score long, negative long, negative_id long, "
         "negative_score long")


def _hard(packing: Packing, k: int, low: int, high: int):
    def in_percent(anchors):
        """low * p <= 100 * n <= high * p for each positive score p."""
        scores = anchors["positives"].to_pylist()
        width = max(len(s) for s in scores)
        least, most = np.full((len(scores), width), HIGH), np.full((len(scores), width), LOW)
        for i, s in enumerate(scores):
            for j, p in enumerate(s):
                least[i, j], most[i, j] = -(-low * p["score"] // 100), high * p["score"] // 100
        return least, most

    search = _search(packing, k, in_percent, False)

    def run(rows, anchors):
        names = [c.split()[0] for c in _HARD.split(", ")]
        if not rows.num_rows or not anchors.num_rows:
            return pa.schema([(c, pa.int64()) for c in names]).empty_table()
        positives = anchors["positives"].to_pylist()
        rows, a, j, at, score = search(rows, anchors)
        chosen = [positives[i][n] for i, n in zip(a, j)]
        cols = [anchors["key"].take(a), anchors["vec_id"].take(a), pa.array(j), pa.array([p["near_id"] for p in chosen], pa.int64()),
                pa.array([p["score"] for p in chosen], pa.int64()), rows["key"].take(at), rows["vec_id"].take(at), pa.array(score)]
        return pa.table(dict(zip(names, cols)))
    return run


def _grid(rows: DataFrame, anchors: DataFrame, buckets: int, rows_at: int, anchors_at: int):
    """Both sides with bucket, part and group: a row in its part for every group of anchors, an anchor in its group
    for every part. Buckets are those of the label; a single one holds all rows, and needs no join."""
    tasks = partitions(rows.sparkSession)
    anchors = anchors.toDF(*anchors.columns)      # columns of its own: anchors are rows of the same table
    # a small table is cut as far as there are tasks for it
    parts = lambda n: F.greatest(F.ceil(n / rows_at), F.least(F.lit(tasks), F.ceil(n / 4096)))
    if buckets == 1:
        n, m = rows.count(), anchors.count()
        sized = lambda df: df.withColumns({"bucket": F.lit(0).cast("long"), "parts": parts(F.lit(n)),
                                           "groups": F.lit(-(-m // anchors_at)).cast("long")}).where("parts > 0 AND groups > 0")
    else:
        bucket = F.pmod(F.xxhash64("label"), F.lit(buckets))
        sizes = (rows.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
                 .join(anchors.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("m")), "bucket"))
        sizes = F.broadcast(sizes.select("bucket", parts(F.col("n")).alias("parts"), F.ceil(F.col("m") / anchors_at).alias("groups")))
        sized = lambda df: df.withColumn("bucket", bucket).join(sizes, "bucket")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    some = lambda n, salt: F.pmod(F.xxhash64("key", F.lit(salt)), F.col(n))
    left = sized(rows).withColumns({"part": some("parts", 1), "group": every("groups")})
    right = sized(anchors).withColumns({"group": some("groups", 2), "part": every("parts")})
    keys = ["bucket", "part", "group"]
    return left.drop("parts", "groups").groupBy(*keys).cogroup(right.drop("parts", "groups").groupBy(*keys))


def quantised(rows: DataFrame, scale: int) -> DataFrame:
    """key, vec_id, label, v (integers) of the rows that take part. Keys follow vec_id, NULL last."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & sound).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"))
    n, ids = rows.agg(F.count(F.lit(1)), F.count_distinct("vec_id")).first()
    if n == ids:
        return materialize(rows.withColumn("key", F.col("vec_id")), "vectors")
    rows = rows.withColumn("place", F.monotonically_increasing_id())
    rows = number_rows(materialize(rows, "vector-places"), [F.col("vec_id").asc_nulls_last(), "label", "place"])
    return materialize(rows.select("vec_id", "label", "v", F.col("row_number").alias("key")), "vectors")


def mine(vectors: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         scale: int = 256, block_bytes: int = 64 << 20, anchor_bytes: int = 8 << 20) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor (vec_id divisible by
    ``every``) and each of its ``positives`` best rows of the same label the ``negatives`` best rows of other labels
    whose score is ``low`` to ``high`` percent of the positive's."""
    rows = quantised(vectors, scale)
    n, lo, hi, dims = rows.agg(F.count(F.lit(1)), F.min(F.array_min("v")), F.max(F.array_max("v")), F.max(F.size("v"))).first()
    # padding adds zeros, which the range has to hold
    packing = Packing(min(lo or 0, 0), max(hi or 0, 0), dims or 0)
    rows_at, anchors_at = (max(1, b // (8 * max(1, packing.dims))) for b in (block_bytes, anchor_bytes))
    anchors = rows.where(F.col("vec_id") % every == 0)
    buckets = max(1, -(-n // rows_at))
    near = _grid(rows, anchors, buckets, rows_at, anchors_at).applyInArrow(_nearest(packing, positives), _NEAR)
    first = Window.partitionBy("anchor").orderBy(F.desc("score"), "near")
    near = near.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= positives)
    near = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("nth", "near_id", "score"))).alias("positives"))
    found = materialize(anchors.join(near, F.col("key") == F.col("anchor")).drop("anchor"), "positives")
    hard = _grid(rows, found, 1, rows_at, anchors_at).applyInArrow(_hard(packing, negatives, low, high), _HARD)
    best = Window.partitionBy("anchor", "nth").orderBy(F.desc("negative_score"), "negative")
    return hard.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
