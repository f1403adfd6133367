"""Trie of conversation prefixes, screened by a count-min sketch.

Every conversation becomes the sequence of its prefixes; equal prefixes are
one node of the trie. Most prefixes of a large corpus occur once, so they are
screened before anything is grouped:

* A turn is a 128-bit digest of (role, text); texts travel no further. A
  prefix's digest is ``sum(t(i) * B**i)`` over its turns, modulo 2**64 in two
  lanes. Sums can be combined, so a conversation may span range partitions:
  each scans its own rows, one entry per partition carries the rest.
* A count-min sketch of all prefix digests is built where the rows are, as
  sparse cells that saturate at 2, and merged by blocks of cells. An estimate
  never falls short of the count, so an estimate of one proves a singleton.
* A singleton whose parent is one too has nothing to learn from other rows:
  such tails are emitted where they are. All other prefixes are grouped
  exactly by digest and depth. False alarms of the sketch are grouped too,
  so its size changes the work, never the result.

Subtree figures need no walk over levels. The smallest member of a node is its
owner; a conversation owns the lower end of its path, from depth ``own``
on. Leaves, children and saved tokens of a node are then sums over its
members of what each adds, and sums are combined before they are shuffled.

Sizes: the sketch has at most ``max_cells`` cells in each of its 3 rows and is
broadcast as bits (48 MB at the default bound); carried sums are one entry per
range partition. A very long conversation is joined in slices of ``SLICE``
turns; the ids that end at one node are sorted by range, packed into chunks
and hashed as a stream.

Cases: rows with NULL conv_id belong to no conversation; NULL role or text
counts as empty; NULL turns come first; turns that repeat a number are ordered
by their digest, and repeated rows each count as a turn; a conversation
without turns of its own after rebuilding ends at the root; an empty table
gives an empty result (no root). Columns other than the four are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, deltas, materialize, mix64, pack, partitions, share, split_runs, unpack
from .sharding import int_div

FAMILY = 20      # conversations that share the opening of the family's first one
SLICE = 1 << 16
DEPTH = 3        # rows of the sketch
_SEEDS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
_B = 0x9E3779B97F4A7C15
_INV = pow(_B, -1, 1 << 64)
NOBODY = hashlib.sha256(b"").hexdigest()


class Powers:
    """B**i modulo 2**64 for positions below 2**32, from two tables."""

    def __init__(self):
        def table(base):
            with np.errstate(over="ignore"):
                return np.concatenate([[np.uint64(1)], np.cumprod(np.full((1 << 16) - 1, base, np.uint64))])
        self.low, self.high = table(np.uint64(_B)), table(np.uint64(pow(_B, 1 << 16, 1 << 64)))

    def __call__(self, i: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return self.low[i & 0xFFFF] * self.high[i >> 16]


def _u64(column: pa.Array) -> np.ndarray:
    return np.array(column.to_numpy(zero_copy_only=False)).view(np.uint64)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def head_length(conv: Column) -> Column:
    """Turns that a conversation takes from its family's first one."""
    return F.crc32(conv.cast("string").cast("binary")) % 4


# ---------------------------------------------------------------- prefix sums
_LOCAL = ("part int, edge int, conv long, pos long, s1 long, s2 long, e1 long, e2 long, w long, words long")
_TURN = "conv long, pos long, s1 long, s2 long, e1 long, e2 long, w long, words long"


def turns(conversations: DataFrame) -> DataFrame:
    """conv, turn, digest, words, place of every turn that has a conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.substring(F.sha2(whole.cast("binary"), 256), 1, 32)).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"), F.monotonically_increasing_id().alias("place"))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefix sums within one sorted range partition. ``edge``: 1 for rows of the partition's first conversation,
    2 more for its last row."""
    part, power = TaskContext.get().partitionId(), Powers()
    first = last = held = None
    n, s, w = 0, np.zeros(2, np.uint64), 0
    for b in batches:
        if not b.num_rows:
            continue
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in held], names=_names(_LOCAL))
        conv = b.column(0).to_numpy()
        t = np.frombuffer(b"".join(b.column(1).to_pylist()), "<u8").reshape(-1, 2)
        words = b.column(2).to_numpy()
        if first is None:
            first = conv[0]
        at = np.arange(len(conv))
        begins = np.concatenate([[conv[0] != last], conv[1:] != conv[:-1]])
        start = np.maximum.accumulate(np.where(begins, at, 0))
        old = np.cumsum(begins) == 0           # go on with the last conversation of the batch before
        pos = at - start + np.where(old, n, 0)
        with np.errstate(over="ignore"):
            term = t * power(pos + 1)[:, None]
            run = np.cumsum(term, axis=0, dtype=np.uint64)
            sums = run - (run - term)[start] + np.where(old[:, None], s[None, :], np.uint64(0))
            before = sums - term
        wrun = np.cumsum(words)
        wsum = wrun - (wrun - words)[start] + np.where(old, w, 0)
        n, s, w, last = pos[-1] + 1, sums[-1].copy(), wsum[-1], conv[-1]
        held = [np.full(len(conv), part, np.int32), (conv == first).astype(np.int32), conv, pos,
                *[np.ascontiguousarray(x).view(np.int64) for x in (sums[:, 0], sums[:, 1], before[:, 0], before[:, 1])], wsum, words]
    if held is not None:
        held[1][-1] += 2
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in held], names=_names(_LOCAL))


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def carries(edges: list) -> dict[int, tuple]:
    """(turns, lane sums, words) that each partition's first conversation has in earlier ones. ``edges``: the first
    row and the last row of every partition."""
    firsts = {r.part: r.conv for r in edges if r.edge & 1 and r.pos == 0}
    lasts = {r.part: r for r in edges if r.edge & 2}
    out, open_, m = {}, None, 1 << 64
    for part in sorted(lasts):
        r, f = lasts[part], firsts[part]
        if open_ and open_[0] == f:
            out[part] = open_[1:]
        else:
            open_ = None
        n, s1, s2, w = out.get(part, (0, 0, 0, 0)) if r.conv == f else (0, 0, 0, 0)
        p = pow(_B, n, m)
        open_ = (r.conv, n + r.pos + 1, (s1 + p * r.s1) % m, (s2 + p * r.s2) % m, w + r.w)
    return out


def _finish(carry):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = carry()
        for b in batches:
            part, edge = b.column(0).to_numpy(), b.column(1).to_numpy()
            cols = [np.array(b.column(i).to_numpy()) for i in range(2, 10)]
            if known:
                for p in np.unique(part[edge & 1 == 1]):
                    if int(p) not in known:
                        continue
                    n, s1, s2, w = known[int(p)]
                    rows = np.flatnonzero((part == p) & (edge & 1 == 1))
                    with np.errstate(over="ignore"):
                        for c, s in ((2, s1), (3, s2), (4, s1), (5, s2)):
                            lane = cols[c].view(np.uint64)
                            lane[rows] = np.uint64(s) + np.uint64(pow(_B, n, 1 << 64)) * lane[rows]
                    cols[1][rows] += n
                    cols[6][rows] += w
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=_names(_TURN))
    return run


def prefix_sums(conversations: DataFrame) -> DataFrame:
    """conv, pos, digest of the prefix with (s1, s2) and without (e1, e2) this turn, words so far (w), words."""
    spark = conversations.sparkSession
    rows = materialize(turns(conversations), "trie-turns")
    order = ["conv", F.col("turn").asc_nulls_first(), "digest", "place"]
    local = (rows.repartitionByRange(max(2, partitions(spark)), *order).sortWithinPartitions(*order)
             .select("conv", "digest", "words").mapInArrow(_scan, _LOCAL))
    local = materialize(local, "trie-sums")
    edges = local.where("edge >= 2 OR (edge = 1 AND pos = 0)").collect()   # at most two rows a range partition
    return local.mapInArrow(_finish(share(spark, carries(edges))), _TURN)


# ---------------------------------------------------------------- rebuilding
def conversations_of(sums: DataFrame) -> DataFrame:
    """One row per conversation: how it is rebuilt (``h`` turns looked for in the family's first, ``k`` found there,
    ``len`` turns in all) and the sums that its prefixes are made of."""
    at = lambda c, j: F.max(F.when(F.col("pos") == j, F.col(c)))
    heads = materialize(sums.groupBy("conv").agg(
        F.count(F.lit(1)).alias("n"), F.max("w").alias("w_all"),
        *[F.array(F.lit(0).cast("long"), *[at(c, j) for j in range(3)]).alias(f"{c}s") for c in ("s1", "s2", "w")]), "trie-conversations")
    family = heads.where(F.col("conv") % FAMILY == 0).select(
        F.col("conv").alias("p"), F.col("n").alias("pn"), *[F.col(f"{c}s").alias(f"p{c}s") for c in ("s1", "s2", "w")])
    none = F.array(*[F.lit(0).cast("long")] * 4)
    rows = heads.withColumns({"p": F.col("conv") - F.col("conv") % FAMILY, "h": head_length(F.col("conv"))}).join(family, "p", "left")
    rows = rows.withColumn("k", F.least("h", F.coalesce("pn", F.lit(0).cast("long"))))
    rows = rows.withColumns({c: F.coalesce(c, none) for c in ("ps1s", "ps2s", "pws")})
    own = F.col("n") > F.col("h")
    pick = lambda c, i: F.get(F.col(c), F.col(i).cast("int"))
    return rows.select(
        "conv", "h", "k", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len"), "ps1s", "ps2s", "pws",
        pick("ps1s", "k").alias("off1"), pick("ps2s", "k").alias("off2"), pick("pws", "k").alias("offw"),
        *[F.when(own, pick(f"{c}s", "h")).alias(f"base{i}") for c, i in (("s1", 1), ("s2", 2), ("w", "w"))],
        (pick("pws", "k") + F.when(own, F.col("w_all") - pick("ws", "h")).otherwise(0)).alias("total"))


_ROW = "conv long, d long, p1 long, p2 long, q1 long, q2 long, before long, len long"


def _rebase(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of the rebuilt prefix: the head's sum, then the own turns' sum moved to their new places."""
    with np.errstate(over="ignore"):
        back = np.cumprod(np.array([1] + [_INV] * 3, np.uint64))
    for b in batches:
        conv, pos, h, k, length, before, offw, basew = (b.column(i).to_numpy() for i in (0, 1, 6, 7, 8, 9, 10, 11))
        s1, s2, e1, e2 = (_u64(b.column(i)) for i in (2, 3, 4, 5))
        off1, off2, base1, base2 = (_u64(b.column(i)) for i in (12, 13, 14, 15))
        with np.errstate(over="ignore"):
            move = back[h - k]
            lanes = [o + move * (s - a) for s, o, a in ((s1, off1, base1), (s2, off2, base2), (e1, off1, base1), (e2, off2, base2))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(conv), pa.array(k + pos - h + 1), *[_signed(x) for x in lanes], pa.array(offw + before - basew), pa.array(length)],
            names=_names(_ROW))


def in_slices(info: DataFrame, last: Column, slice_: int) -> DataFrame:
    """One copy of a conversation's row for each slice of its depths."""
    return info.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), int_div(last, slice_))))


def prefixes(conversations: DataFrame, slice_: int = SLICE) -> tuple[DataFrame, DataFrame]:
    """(every prefix of every rebuilt conversation, root included; the conversations). ``p``: digest of the prefix,
    ``q``: of its parent, ``before``: words of the parent's turns."""
    sums = prefix_sums(conversations)
    info = materialize(conversations_of(sums), "trie-plan")
    zero = F.lit(0).cast("long")
    root = info.select("conv", *[zero.alias(c) for c in ("d", "p1", "p2", "q1", "q2", "before")], "len")
    at = lambda c, back=0: F.get(F.col(c), (F.col("d") - back).cast("int"))
    heads = (info.where("k > 0").withColumn("d", F.explode(F.sequence(F.lit(1).cast("long"), "k")))
             .select("conv", "d", at("ps1s").alias("p1"), at("ps2s").alias("p2"), at("ps1s", 1).alias("q1"), at("ps2s", 1).alias("q2"),
                     at("pws", 1).alias("before"), "len"))
    plan = in_slices(info.where("len > k").drop("ps1s", "ps2s", "pws"), F.col("len") + F.col("h"), slice_)
    own = (sums.where(F.col("pos") >= head_length(F.col("conv"))).withColumn("slice", int_div(F.col("pos"), slice_))
           .join(plan, ["conv", "slice"])
           .select("conv", "pos", "s1", "s2", "e1", "e2", "h", "k", "len", (F.col("w") - F.col("words")).alias("before"),
                   "offw", "basew", "off1", "off2", "base1", "base2").mapInArrow(_rebase, _ROW))
    return materialize(root.unionByName(heads).unionByName(own), "trie-prefixes"), info


# ---------------------------------------------------------------- count-min sketch
def sketch_bits(n: int, max_cells: int) -> int:
    """Cells of a row as a power of two: four per prefix up to the bound."""
    return max(6, min((4 * max(n, 1) - 1).bit_length(), max_cells.bit_length() - 1))


def cells_of(d: np.ndarray, p1: np.ndarray, p2: np.ndarray, bits: int) -> np.ndarray:
    """DEPTH x n cell numbers of prefix digests."""
    with np.errstate(over="ignore"):
        key = p1 + p2 * _SEEDS[0] + d.astype(np.uint64) * _SEEDS[1]
        return np.stack([(mix64(key ^ s) >> np.uint64(64 - bits)).astype(np.int64) + (r << bits) for r, s in enumerate(_SEEDS)])


def _fill(bits: int, flush: int = 1 << 20):
    """Cells of a task's prefixes, those met once and those met again, by block."""
    block = min(bits, 20)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def emit():
            cell, count = np.unique(np.concatenate(held), return_counts=True)
            edges = split_runs(cell >> block)
            for a, b in zip(edges[:-1], edges[1:]):
                sent = [deltas(x) for x in (cell[a:b][count[a:b] == 1], cell[a:b][count[a:b] > 1])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(cell[a] >> block)]), *[pa.array([x]) for y in sent for x in (len(y), pack(y, 5) if len(y) else b"")]],
                    schema=pa.schema([("block", pa.int64()), ("n1", pa.int64()), ("once", pa.binary()), ("n2", pa.int64()), ("more", pa.binary())]))

        for b in batches:
            held.append(cells_of(b.column(0).to_numpy(), _u64(b.column(1)), _u64(b.column(2)), bits).ravel())
            n += b.num_rows
            if n >= flush:
                yield from emit()
                held, n = [], 0
        if n:
            yield from emit()
    return run


def _merge(bits: int):
    size = 1 << min(bits, 20)

    def run(key, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, seen = key[0].as_py() * size, np.zeros(size, np.uint8)
        for b in batches:
            for n1, once, n2, more in zip(*(b.column(i).to_pylist() for i in (1, 2, 3, 4))):
                if n1:
                    one = np.cumsum(unpack(once, n1, 5, np.int64)) - base
                    seen[one] = np.minimum(seen[one] + 1, 2)
                if n2:
                    seen[np.cumsum(unpack(more, n2, 5, np.int64)) - base] = 2
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()]), pa.array([np.packbits(seen > 1, bitorder="little").tobytes()])],
                                         schema=pa.schema([("block", pa.int64()), ("bits", pa.binary())]))
    # grouped Arrow functions tell their kind by annotation
    run.__annotations__ = {"key": tuple[pa.Scalar, ...], "batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    return run


def sketch(rows: DataFrame, bits: int) -> np.ndarray:
    """Bit per cell: met more than once. Bounded by ``bits``, not by the rows."""
    filled = rows.where("d > 0").select("d", "p1", "p2").mapInArrow(_fill(bits), "block long, n1 long, once binary, n2 long, more binary")
    merged = filled.groupBy("block").applyInArrow(_merge(bits), "block long, bits binary").collect()
    size = (1 << min(bits, 20)) // 8
    out = np.zeros((DEPTH << bits) // 8, np.uint8)
    for r in merged:
        out[r.block * size:(r.block + 1) * size] = np.frombuffer(r.bits, np.uint8)
    return out


def _classify(sent, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        more = sent()

        def single(d, a, b):   # the estimate is one when some cell was met once
            cell = cells_of(d, a, b, bits)
            return ((more[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 0).any(0) & (d > 0)

        for b in batches:
            d = b.column(1).to_numpy()
            own = single(d, _u64(b.column(2)), _u64(b.column(3)))
            above = single(d - 1, _u64(b.column(4)), _u64(b.column(5)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own), pa.array(own & above)], names=[*_names(_ROW), "single", "tail"])
    return run


# ---------------------------------------------------------------- ids that end at a node
_CHUNK = "d long, p1 long, p2 long, first long, ids binary"
_KEY = ["d", "p1", "p2"]


def _chunks(limit: int):
    """Ids of a sorted range partition as joined text, a new chunk for each node and after ``limit`` ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = np.stack([b.column(i).to_numpy() for i in range(3)], 1)
            ids = b.column(3).to_numpy()
            new = np.concatenate([[True], (keys[1:] != keys[:-1]).any(1)]) if len(ids) else np.zeros(0, bool)
            starts = np.flatnonzero(new)
            cuts = np.concatenate([np.arange(a, z, limit) for a, z in zip(starts, [*starts[1:], len(ids)])]) if len(ids) else starts
            text = [",".join(map(str, ids[a:z])).encode() for a, z in zip(cuts, [*cuts[1:], len(ids)])]
            yield pa.RecordBatch.from_arrays([*[pa.array(keys[cuts, i]) for i in range(3)], pa.array(ids[cuts]), pa.array(text, pa.binary())],
                                             names=_names(_CHUNK))
    return run


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over each node's chunks, which come in order."""
    at, h = None, None
    for b in batches:
        done = []
        for *key, ids in zip(*(b.column(i).to_pylist() for i in (0, 1, 2, 4))):
            if key != at:
                if at:
                    done.append((*at, h.hexdigest()))
                at, h = key, hashlib.sha256(ids)
            else:
                h.update(b"," + ids)
        yield _hashed(done)
    if at:
        yield _hashed([(*at, h.hexdigest())])


def _hashed(rows: list) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string())], names=[*_KEY, "ends"])


def ends_of(rows: DataFrame, limit: int = 1 << 16) -> DataFrame:
    """d, p1, p2, hash of the ids of the conversations that end there."""
    n, order = max(2, partitions(rows.sparkSession)), [*_KEY, "conv"]
    packed = (rows.where("d = len").select(*order).repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(_chunks(limit), _CHUNK))
    return (packed.repartition(n, *_KEY).sortWithinPartitions(*_KEY, "first").mapInArrow(_hash, "d long, p1 long, p2 long, ends string"))


# ---------------------------------------------------------------- trie
def owners(nodes: DataFrame, info: DataFrame) -> DataFrame:
    """conv, len, own (depth of the topmost node it owns, beyond ``len`` if none), saved_to (words above that
    node), leaf (it owns a childless node), parent (owner of the node above ``own``)."""
    top = nodes.groupBy(F.col("owner").alias("conv")).agg(
        F.min("d").alias("own"), F.min_by("before", "d").alias("above"), F.min_by("q1", "d").alias("q1"), F.min_by("q2", "d").alias("q2"),
        F.max(F.col("single") | ~F.col("more")).alias("leaf"))
    # the root is the parent of most: a literal, not a hot join key
    root = nodes.where("d = 0").select("owner").first()
    first = top.where("own <= 1").withColumn("parent", F.when(F.col("own") == 1, F.lit(root.owner if root else None).cast("long")))
    up = nodes.where("d > 0").select((F.col("d") + 1).alias("own"), F.col("p1").alias("q1"), F.col("p2").alias("q2"),
                                     F.col("owner").alias("parent"))
    top = first.unionByName(top.where("own > 1").join(up, ["own", "q1", "q2"], "left"))
    return info.select("conv", "len", "total").join(top, "conv", "left").select(
        "conv", "len", F.coalesce("own", F.col("len") + 1).alias("own"), F.coalesce("above", "total").alias("saved_to"),
        F.coalesce("leaf", F.lit(False)).alias("leaf"), "parent")


def conversation_trie(conversations: DataFrame, max_cells: int = 1 << 27, slice_: int = SLICE) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node."""
    spark = conversations.sparkSession
    rows, info = prefixes(conversations, slice_)
    bits = sketch_bits(rows.count(), max_cells)
    marked = materialize(rows.mapInArrow(_classify(share(spark, sketch(rows, bits)), bits), _ROW + ", single boolean, tail boolean"), "trie-marked")
    shared = marked.where("NOT tail")
    nodes = materialize(shared.groupBy(*_KEY).agg(
        F.min("conv").alias("owner"), F.max(F.col("len") > F.col("d")).alias("more"), F.max("single").alias("single"),
        *[F.min(c).alias(c) for c in ("q1", "q2", "before")]), "trie-nodes")
    who = in_slices(owners(nodes, info), F.col("len"), slice_).drop("len")
    d, own = F.col("d"), F.col("own")
    member = shared.withColumn("slice", int_div(d, slice_)).join(who, ["conv", "slice"]).select(
        *_KEY, "conv", F.when(own == d, F.col("parent")).when(d > 0, F.col("conv")).alias("parent"),
        ((F.col("len") > d) & (own <= d + 1)).cast("long").alias("child"), F.col("leaf").cast("long").alias("leaf"),
        F.when(own > d, F.col("saved_to") - F.col("before")).otherwise(0).alias("saved"))
    grouped = member.groupBy(*_KEY).agg(
        F.min("conv").alias("conv_id"), F.min_by("parent", "conv").alias("parent_conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.sum("child").alias("n_children"), F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    grouped = grouped.join(ends_of(shared), _KEY, "left").select(
        "conv_id", d.alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", F.lit(NOBODY)).alias("ends_sha256"))
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    tails = marked.where("tail").select(
        F.col("conv").alias("conv_id"), d.alias("depth"), F.col("conv").alias("parent_conv_id"), one.alias("n_convs"),
        (F.col("len") > d).cast("long").alias("n_children"), one.alias("n_leaves"), none.alias("saved_tokens"),
        F.when(F.col("len") == d, F.sha2(F.col("conv").cast("string").cast("binary"), 256)).otherwise(NOBODY).alias("ends_sha256"))
    return grouped.unionByName(tails)
