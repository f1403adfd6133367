"""M3: random forests over sparse features.

Spark's forest keeps and walks through a number per row and feature, so with one-hot categories its cost is rows times
features. ``SparseForest`` grows the forest of ``RandomForestRegressor`` (its parameters, its kinds of splits, bootstrap by
Poisson weights, a third of the features drawn anew for every node, variance, merging of equal leaves) from the
non-zero values alone, and returns Spark's own ``RandomForestRegressionModel``.

1. Rows are binned once and packed in blocks. A feature's bins lie between thresholds found as Spark finds them: halfway
   between neighbouring values, by quantiles of as many sampled rows if there are too many values.
2. A level is one pass: tasks sum weight, label and squared label by node and bin of the non-zero values; the bin that
   holds zero has what is left of its node. Only features drawn for a node are summed up and sent.
3. Reducers of up to ``SLICE`` nodes each choose the best split; the driver gets one row per node, as it does in Spark.

Draws are hashes of the seed, the tree, the node and the place of a row (``id``), so a retried task draws the same.
"""

from __future__ import annotations

import json
import math
import sys
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, shared_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # workers may not have this package on their path

BLOCK = 200_000     # rows
CELLS = 4_000_000   # rows of a block times the non-zero values of its fullest row
SLICE = 64          # nodes
TREES = 32          # trees that grow at the same time
_BLOCK_SQL = "n long, ids binary, labels binary, features binary, bins binary"
_SUMS_SQL = "tree int, slice int, block long, n long, keys binary, sums binary"
_SPLIT_SQL = ("tree int, slot int, feature int, cut int, gain double, w double, s double, q double, lw double, ls double, lq double, "
              "left_below binary, right_below binary")
_GOLD, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
#: Cumulative odds of the Poisson weights 0, 1, 2 ...
_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(20)])


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _key(*parts: int) -> int:
    h = 0
    for p in parts:
        h = int(mix(np.array([(h * 31 + p + _GOLD) & _MASK], np.uint64))[0])
    return h


def _hash(keys: np.ndarray, features: np.ndarray) -> np.ndarray:
    return mix(keys + (features.astype(np.uint64) + np.uint64(1)) * np.uint64(_GOLD))


def drawn_below(key: int, features: int, take: int) -> int:
    """A node draws the ``take`` features of the smallest hashes: the largest hash among them."""
    if take >= features:
        return _MASK
    h = _hash(np.uint64(key), np.arange(features, dtype=np.uint64))
    return int(np.partition(h, take - 1)[take - 1])


def weights(ids: np.ndarray, seed: int, tree: int, bootstrap: bool) -> np.ndarray:
    if not bootstrap:
        return np.ones(len(ids))
    u = (mix(ids.astype(np.uint64) * np.uint64(_GOLD) + np.uint64(_key(seed, tree, 7))) >> np.uint64(11)) / float(1 << 53)
    return np.searchsorted(_POISSON, u, "right").astype(np.float64)


def find_thresholds(values: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` thresholds between sorted distinct ``values``: all of them, or those nearest to every
    ``1 / (most + 1)`` of the counts."""
    between = (values[:-1] + values[1:]) / 2.0
    if len(between) <= most:
        return between
    stride, target, found = counts.sum() / (most + 1), counts.sum() / (most + 1), []
    upto = np.cumsum(counts)
    for i in range(1, len(values)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            found.append(between[i - 1])
            target += stride
    return np.array(found)


def entries(vectors: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature and value of the non-zero values of an Arrow array of vectors."""
    ix, v = vectors.field("indices"), vectors.field("values")
    count = np.diff(v.offsets.to_numpy())
    rows = np.repeat(np.arange(len(vectors)), count)
    values = v.flatten().to_numpy(zero_copy_only=False)
    features = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)    # of a dense vector
    features[np.repeat(vectors.field("type").to_numpy(zero_copy_only=False) == 0, count)] = ix.flatten().to_numpy(zero_copy_only=False)
    some = values != 0
    return rows[some], features[some], values[some]


@dataclass
class Bins:
    """Thresholds of the features that have any (``known``, sorted); all others are 0 or 1 with the threshold 0.5."""
    size: int
    known: np.ndarray
    thresholds: list[np.ndarray]
    zero: np.ndarray = field(init=False)      # bin of 0 of the known ones

    def __post_init__(self):
        self.zero = np.array([np.searchsorted(t, 0.0) for t in self.thresholds], np.int64)

    def of(self, features: np.ndarray, values: np.ndarray) -> np.ndarray:
        out = np.ones(len(features), np.int64)
        order = np.argsort(features, kind="stable")
        found, starts = np.unique(features[order], return_index=True)
        for f, own in zip(found, np.split(order, starts[1:])):
            if (t := self.cuts(int(f))) is not None:
                out[own] = np.searchsorted(t, values[own])      # values up to a threshold go left
        return out

    def cuts(self, feature: int) -> np.ndarray | None:
        at = int(np.searchsorted(self.known, feature))
        return self.thresholds[at] if at < len(self.known) and self.known[at] == feature else None

    def zero_of(self, features: np.ndarray) -> np.ndarray:
        out = np.zeros(len(features), np.int64)
        if len(self.known):
            at = np.minimum(np.searchsorted(self.known, features), len(self.known) - 1)
            own = self.known[at] == features
            out[own] = self.zero[at[own]]
        return out

    def threshold(self, feature: int, cut: int) -> float:
        t = self.cuts(feature)
        return 0.5 if t is None else float(t[cut])


@dataclass
class Tree:
    """Nodes in the order they came up. ``feature`` is -1 in a leaf; ``cut`` is the last bin that goes left."""
    keys: list[int]                                 # number of the node in a whole binary tree
    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [-1])
    zero: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    gain: list[float] = field(default_factory=lambda: [-1.0])
    sums: list[tuple] = field(default_factory=lambda: [(0.0, 0.0, 0.0)])
    slot: list[int] = field(default_factory=lambda: [0])    # among the open nodes, or -1
    below: list[int] = field(default_factory=lambda: [_MASK])

    def child(self, key: int, sums: tuple, below: int) -> int:
        for column, v in ((self.keys, key), (self.feature, -1), (self.cut, -1), (self.zero, 0), (self.left, -1), (self.right, -1),
                          (self.gain, -1.0), (self.sums, sums), (self.slot, -1), (self.below, below)):
            column.append(v)
        return len(self.keys) - 1


def _pack_rows(bins: Bins, mean: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(parts):
            ids, labels = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            starts = np.cumsum([0] + [len(p[0]) for p in parts[:-1]])
            rows = np.concatenate([p[2] + s for p, s in zip(parts, starts)])
            features, codes = np.concatenate([p[3] for p in parts]), np.concatenate([p[4] for p in parts])
            count = np.bincount(rows, minlength=len(ids))
            width = int(count.max()) if len(rows) else 0
            wide, narrow = np.full((len(ids), width), -1, np.int32), np.zeros((len(ids), width), np.int16)
            at = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)
            wide[rows, at], narrow[rows, at] = features, codes
            return pa.RecordBatch.from_pydict({"n": [len(ids)], "ids": [ids.tobytes()], "labels": [(labels - mean).tobytes()],
                                               "features": [wide.tobytes()], "bins": [narrow.tobytes()]})
        parts, held, width = [], 0, 0
        for whole in batches:
            step = min(1000, BLOCK)
            for b in (whole.slice(at, step) for at in range(0, whole.num_rows, step)):
                r, f, v = entries(pa.concat_arrays([b.column(2)]))
                code = bins.of(f, v)
                other = code != bins.zero_of(f)
                most = int(np.bincount(r[other], minlength=1).max())
                if held and (held + b.num_rows > BLOCK or (held + b.num_rows) * max(width, most) > CELLS):
                    yield block(parts)
                    parts, held, width = [], 0, 0
                parts.append((b.column(0).to_numpy(), b.column(1).to_numpy(zero_copy_only=False), r[other], f[other], code[other]))
                held, width = held + b.num_rows, max(width, most)
        if held:
            yield block(parts)
    return run


def slots_of(tree: Tree, wide: np.ndarray, narrow: np.ndarray) -> np.ndarray:
    """Slot of each row's node, -1 in a closed one."""
    feature, cut, zero = np.array(tree.feature), np.array(tree.cut), np.array(tree.zero)
    left, right, slot = np.array(tree.left), np.array(tree.right), np.array(tree.slot)
    node = np.zeros(len(wide), np.int64)
    rows = np.flatnonzero(feature[node] >= 0)
    while len(rows):
        at = node[rows]
        code = zero[at].copy()
        for j in range(wide.shape[1]):
            hit = wide[rows, j] == feature[at]
            code[hit] = narrow[rows[hit], j]
        node[rows] = np.where(code <= cut[at], left[at], right[at])
        rows = rows[feature[node[rows]] >= 0]
    return slot[node]


def _sums(given, seed: int, bootstrap: bool, width: int, size: int):
    """Key of a sum: (slot * (size + 1) + feature) * width + bin; feature ``size`` has the sums of the whole node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: dict[int, Tree] = given()
        for b in batches:
            for n, ids, labels, wide, narrow in zip(*(b.column(i).to_pylist() for i in range(5))):
                ids, y = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.float64)
                wide, narrow = np.frombuffer(wide, np.int32).reshape(n, -1), np.frombuffer(narrow, np.int16).reshape(n, -1)
                for t, tree in trees.items():
                    yield from _tree_sums(t, tree, ids, y, wide, narrow, weights(ids, seed, t, bootstrap), seed, width, size)
    return run


def _tree_sums(t, tree, ids, y, wide, narrow, w, seed, width, size) -> Iterator[pa.RecordBatch]:
    slot = slots_of(tree, wide, narrow)
    own = np.flatnonzero((slot >= 0) & (w > 0))
    if not len(own):
        return
    slot, w, y = slot[own], w[own], y[own]
    by_slot = {s: (k, b) for k, s, b in zip(tree.keys, tree.slot, tree.below) if s >= 0}
    keys = np.array([_key(seed, t, by_slot[s][0]) for s in range(len(by_slot))], np.uint64)
    below = np.array([by_slot[s][1] for s in range(len(by_slot))], np.uint64)
    row, at = np.nonzero(wide[own] >= 0)
    feature = wide[own[row], at]
    drawn = _hash(keys[slot[row]], feature) <= below[slot[row]]
    row, at, feature = row[drawn], at[drawn], feature[drawn].astype(np.int64)
    key = np.concatenate([(slot[row] * (size + 1) + feature) * width + narrow[own[row], at], (slot * (size + 1) + size) * width])
    row = np.concatenate([row, np.arange(len(own))])
    found, back = np.unique(key, return_inverse=True)
    sums = [np.bincount(back, x[row], len(found)) for x in (w, w * y, w * y * y)]
    part = found // ((size + 1) * width) // SLICE
    cuts = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]])
    out = [(t, int(part[a]), int(ids[0]), int(b - a), found[a:b].tobytes(), np.stack([x[a:b] for x in sums]).tobytes())
           for a, b in zip(cuts[:-1], cuts[1:])]
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                     names=["tree", "slice", "block", "n", "keys", "sums"])


def _variance(w, s, q):
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.maximum(q / w - (s / w) ** 2, 0.0)


def best_splits(keys: np.ndarray, sums: np.ndarray, bins: Bins, width: int, least: int, min_gain: float) -> list[tuple]:
    """Of every node among ``keys`` (sorted, with their sums of weight, label and square): slot, feature, cut, gain,
    node's sums, left sums. Feature -1: no split gains."""
    size = bins.size
    place, code = keys // width, keys % width
    slot, feature = place // (size + 1), place % (size + 1)
    whole = feature == size
    slots, total = slot[whole], sums[:, whole]
    where = np.searchsorted(slots, slot)
    known = np.isin(feature, bins.known)
    cands = []     # node, feature, cut, left sums

    one = ~whole & ~known
    cands.append((where[one], feature[one], np.zeros(one.sum(), np.int64), total[:, where[one]] - sums[:, one]))
    for f in np.intersect1d(bins.known, feature):
        if len(t := bins.cuts(int(f))):
            mine = feature == f
            table = np.zeros((3, len(slots), len(t) + 1))
            table[:, where[mine], code[mine]] = sums[:, mine]
            table[:, :, int(bins.zero_of(np.array([f]))[0])] = total - table.sum(2)
            left = table.cumsum(2)[:, :, :-1]
            node, cut = (x.ravel() for x in np.indices(left.shape[1:]))
            cands.append((node, np.full(len(node), f), cut, left.reshape(3, -1)))
    node, feat, cut = (np.concatenate([c[i] for c in cands]).astype(np.int64) for i in range(3))
    left = np.concatenate([c[3] for c in cands], axis=1)
    all_ = total[:, node]
    right = all_ - left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = _variance(*all_) - (left[0] * _variance(*left) + right[0] * _variance(*right)) / all_[0]
    rounding = 1e-14 * (total[2] / total[0])[node]
    fit = (left[0] > least - 0.5) & (right[0] > least - 0.5) & (gain > rounding) & (gain >= min_gain)     # weights are whole numbers
    order = np.lexsort((cut[fit], feat[fit], -gain[fit], node[fit]))
    best: dict[int, int] = {}
    for i in np.flatnonzero(fit)[order].tolist():
        best.setdefault(int(node[i]), i)
    out = []
    for j, s in enumerate(slots.tolist()):
        i = best.get(j)
        out.append((s, -1, -1, -1.0, total[:, j], total[:, j]) if i is None else
                   (s, int(feat[i]), int(cut[i]), float(gain[i]), total[:, j], left[:, i]))
    return out


def _choose(bins_given, given, seed: int, width: int, least: int, min_gain: float, take: int):
    def run(t: pa.Table) -> pa.Table:
        rows = sorted(zip(*(t.column(c).to_pylist() for c in ("block", "tree", "n", "keys", "sums"))), key=lambda r: r[0])
        bins, tree_no = bins_given(), rows[0][1]
        key = np.concatenate([np.frombuffer(k, np.int64) for *_, k, _ in rows])
        sums = np.concatenate([np.frombuffer(s, np.float64).reshape(3, n) for _, _, n, _, s in rows], axis=1)
        found, back = np.unique(key, return_inverse=True)
        sums = np.stack([np.bincount(back, x, len(found)) for x in sums])
        tree = given()[tree_no]
        number = {s: k for k, s in zip(tree.keys, tree.slot) if s >= 0}
        out = []
        for slot, f, cut, gain, al, le in best_splits(found, sums, bins, width, least, min_gain):
            below = [b"", b""] if f < 0 else [drawn_below(_key(seed, tree_no, 2 * number[slot] + side), bins.size, take)
                                              .to_bytes(8, "little") for side in (1, 2)]
            out.append((tree_no, slot, f, cut, gain, *al.tolist(), *le.tolist(), *below))
        kinds = [pa.int32()] * 4 + [pa.float64()] * 7 + [pa.binary()] * 2
        names = [c.split()[0] for c in _SPLIT_SQL.split(",")]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
    return run


def _grow(blocks: DataFrame, bins: Bins, numbers: list[int], take: int, seed: int, bootstrap: bool, depth: int, least: int,
          min_gain: float) -> list[Tree]:
    sc = blocks.sparkSession.sparkContext

    def shared(value):
        sent = sc.broadcast(cloudpickle.dumps(value))
        return sent, lambda: cloudpickle.loads(sent.value)

    width = max([2, *(len(t) + 1 for t in bins.thresholds)])
    trees = {t: Tree([0], below=[drawn_below(_key(seed, t, 0), bins.size, take)]) for t in numbers}
    bins_sent, bins_given = shared(bins)
    for level in range(depth + 1):
        grown = {t: x for t, x in trees.items() if max(x.slot) >= 0}
        if not grown:
            break
        sent, given = shared(grown)
        found = blocks.mapInArrow(_sums(given, seed, bootstrap, width, bins.size), _SUMS_SQL).groupBy("tree", "slice") \
            .applyInArrow(_choose(bins_given, given, seed, width, least, min_gain, take), _SPLIT_SQL).collect()   # a row a node
        by_node = {(r["tree"], r["slot"]): r for r in found}
        for t, x in grown.items():
            open_ = [i for i, s in enumerate(x.slot) if s >= 0]
            fresh = []
            for i in open_:
                r, s = by_node.get((t, x.slot[i])), x.slot[i]
                x.slot[i] = -1
                if r is None:       # no row was drawn
                    continue
                x.sums[i] = (r["w"], r["s"], r["q"])
                if r["feature"] < 0 or level == depth:
                    continue
                x.feature[i], x.cut[i], x.gain[i] = r["feature"], r["cut"], r["gain"]
                x.zero[i] = int(bins.zero_of(np.array([r["feature"]]))[0])
                left = (r["lw"], r["ls"], r["lq"])
                for side, sums, name in ((1, left, "left_below"), (2, tuple(a - b for a, b in zip(x.sums[i], left)), "right_below")):
                    j = x.child(2 * x.keys[i] + side, sums, int.from_bytes(r[name], "little"))
                    (x.left if side == 1 else x.right)[i] = j
                    if level + 1 < depth:
                        fresh.append(j)
            for s, j in enumerate(fresh):
                x.slot[j] = s
        sent.unpersist()
    bins_sent.unpersist()
    return [trees[t] for t in numbers]


def _mean(sums: tuple, mean: float) -> float:
    return mean + (sums[1] / sums[0] if sums[0] else 0.0)


def _node_rows(number: int, tree: Tree, bins: Bins, mean: float) -> list[tuple]:
    """Nodes as Spark stores them, in pre-order; two leaves of the same mean are one."""
    leaf = {}
    for i in reversed(range(len(tree.keys))):       # children come after their parents
        leaf[i] = tree.feature[i] < 0 or (leaf[tree.left[i]] and leaf[tree.right[i]]
                                          and _mean(tree.sums[tree.left[i]], mean) == _mean(tree.sums[tree.right[i]], mean))
    rows, todo = [], [(0, None, 0)]
    while todo:
        i, parent, side = todo.pop()
        w, s, q = tree.sums[i]
        spread = float(_variance(np.float64(w), np.float64(s), np.float64(q))) if w else 0.0
        stats = [w, s + mean * w, q + 2 * mean * s + mean * mean * w]
        at = len(rows)
        split = [-1, [], -1] if leaf[i] else [tree.feature[i], [bins.threshold(tree.feature[i], tree.cut[i])], -1]
        rows.append([at, _mean(tree.sums[i], mean), spread, stats, round(w), -1.0 if leaf[i] else tree.gain[i], -1, -1, split])
        if parent is not None:
            rows[parent][6 + side] = at
        if not leaf[i]:
            todo += [(tree.right[i], at, 1), (tree.left[i], at, 0)]
    return [(number, tuple(r[:8]) + (tuple(r[8]),)) for r in rows]


_NODE_SQL = ("treeID int, nodeData struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,rawCount:bigint,"
             "gain:double,leftChild:int,rightChild:int,split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,"
             "numCategories:int>>")


class SparseForest(RandomForestRegressor):
    """``RandomForestRegressor`` whose cost follows the non-zero values. Row weights, drawing rows without replacement, other
    strategies than "auto" and "all", and nominal features of more than two values are left to Spark's forest."""

    def _fit(self, dataset: DataFrame) -> RandomForestRegressionModel:
        column = self.getFeaturesCol()
        attrs = dataset.schema[column].metadata.get("ml_attr", {})
        strategy, trees = self.getFeatureSubsetStrategy(), self.getNumTrees()
        if self.isDefined("weightCol") and self.getWeightCol() or self.getSubsamplingRate() != 1.0 or self.getMinWeightFractionPerNode() \
                or attrs.get("attrs", {}).get("nominal") or strategy not in ("auto", "all"):
            return super()._fit(dataset)
        spark = dataset.sparkSession
        seed, bootstrap, most = self.getSeed(), self.getBootstrap(), self.getMaxBins()
        rows = dataset.select(F.monotonically_increasing_id().alias("id"), F.col(self.getLabelCol()).cast("double").alias("label"),
                              F.col(column).alias("features"))
        n, mean = rows.agg(F.count(F.lit(1)), F.avg("label")).first()
        if not n:
            return super()._fit(dataset)
        vector = F.unwrap_udt("features")
        size = attrs.get("num_attrs") or rows.select(F.coalesce(vector["size"], F.size(vector["values"]))).first()[0]
        binary = {a["idx"] for a in attrs.get("attrs", {}).get("binary", [])}
        bins = self._bins(rows, n, size, binary, most)
        blocks = cut_lineage(rows.mapInArrow(_pack_rows(bins, mean), _BLOCK_SQL))
        take = size if strategy == "all" or trees == 1 else math.ceil(size / 3.0)
        grown: list[Tree] = []
        for at in range(0, trees, TREES):
            grown += _grow(blocks, bins, list(range(at, min(trees, at + TREES))), take, seed, bootstrap, self.getMaxDepth(),
                           self.getMinInstancesPerNode(), self.getMinInfoGain())
        return self._model(spark, grown, bins, mean, size)

    def _bins(self, rows: DataFrame, n: int, size: int, binary: set[int], most: int) -> Bins:
        """Thresholds of all features that are not marked as 0 or 1, from all rows or as many sampled ones as Spark takes."""
        if len(binary) == size:
            return Bins(size, np.empty(0, np.int64), [])
        want = max(most * most, 10_000)
        some = rows if n <= want else rows.sample(want / n, self.getSeed())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            marked = np.fromiter(sorted(binary), np.int64, len(binary))
            for b in batches:
                _, f, v = entries(b.column(0))
                own = ~np.isin(f, marked)
                f = np.concatenate([f[own], [-1] * b.num_rows])
                yield pa.RecordBatch.from_arrays([pa.array(f, pa.int64()), pa.array(np.concatenate([v[own], np.zeros(b.num_rows)]))],
                                                 names=["feature", "value"])

        got = some.select("features").mapInArrow(run, "feature long, value double").groupBy("feature", "value").count().collect()
        sampled = sum(r["count"] for r in got if r["feature"] < 0)
        by: dict[int, dict[float, int]] = {f: {} for f in range(size) if f not in binary}
        for r in got:
            if r["feature"] >= 0:
                by[r["feature"]][r["value"]] = r["count"]
        thresholds = []
        for f in sorted(by):
            zeros = sampled - sum(by[f].values())
            if zeros:
                by[f][0.0] = zeros
            v = np.array(sorted(by[f]))
            thresholds.append(find_thresholds(v, np.array([by[f][x] for x in v]), min(most, n) - 1))
        return Bins(size, np.array(sorted(by), np.int64), thresholds)

    def _model(self, spark, grown: list[Tree], bins: Bins, mean: float, size: int) -> RandomForestRegressionModel:
        """Spark's own model, read from the files that it would have saved."""
        path = shared_path(spark, "forest")
        own = {"numTrees": len(grown), "maxDepth": self.getMaxDepth()}
        common = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "defaultParamMap": {"impurity": "variance"}}
        uid = f"RandomForestRegressor_{uuid.uuid4().hex[:12]}"
        meta = common | {"class": "org.apache.spark.ml.regression.RandomForestRegressionModel", "uid": uid, "paramMap": own,
                         "numFeatures": size, "numTrees": len(grown)}
        each = [(i, json.dumps(common | {"class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel",
                                         "uid": f"dtr_{uuid.uuid4().hex[:12]}", "paramMap": {"maxDepth": self.getMaxDepth()}}), 1.0)
                for i in range(len(grown))]
        nodes = [r for i, t in enumerate(grown) for r in _node_rows(i, t, bins, mean)]
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(f"{path}/metadata")
        spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
        spark.createDataFrame(nodes, _NODE_SQL).write.parquet(f"{path}/data")
        model = RandomForestRegressionModel.load(path)
        model._resetUid(self.uid)
        return self._copyValues(model)
