"""N-gram Jaccard join: prefix filtering over rare-first ordered shingles.

A document's set holds its distinct ``words``-word shingles (ASCII letters
lower-cased); a shorter document has its whole sequence as its one shingle, one
without words has the empty set and links with nothing. Two documents link
when 100 * intersection >= ``percent`` * union.

1. Scan: every whole text is shingled once. Identical sets of a block collapse
   to their smallest document. Shingle hashes go to range buckets as packed
   planes; one that ``RARE`` or more documents of a block share goes as one
   entry without documents.
2. Count: a reducer counts, over all documents, the documents of each hash and
   hands every shared shingle back to its documents with its class
   min(count, RARE). The global order is (class, hash): rare first.
   Shingles of one document alone cannot link and need not travel further.
3. Prefixes: identical sets collapse across blocks. The prefix of a set of n
   holds its n - ceil(t * n) + 1 rarest shingles; lone shingles fill
   it first, and most documents end here.
4. Candidates: documents that share a prefix shingle, after length and
   positional filters, are verified once per pair (suffix filter, then exact
   intersection). Pairs go in two steps so that a group of k near
   copies costs about k pairs, not k**2 / 2: first every member against one
   pivot per shingle, then, after the links found have been joined to
   components, all pairs that still lie in different components. A pair inside
   one component cannot change it, so the components are those of all links.
5. Components: smallest id reachable, by label propagation in Spark.

Hashes of shingles are 48 bits of a 64-bit rolling hash: 2 sets of 500 shingles
gain a false common shingle with odds of 1e-9.

Cases: NULL text counts as empty; equal sets form one component; an empty table
gives an empty result. ``row_components`` judges every row by its own text, also
rows that repeat an id or have none; NULL ids sort last, and a component of
NULL ids only has the id NULL. ``jaccard_components`` has one row per id: the
greatest text by code point stands, and NULL ids are one id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (MAX_ID, Rolling, bucket_count, deltas, exchanged, home_of, id_key, materialize, one_row_per_id,
                     pack, pairs_by_home, split_runs, text_bytes, texts, unpack, values_of)
from .sharding import keyed_rows
from .substring_dedup import word_hashes

RARE = 32
BITS = 48
BLOCK_SHINGLES = 1_000_000
BARE = np.int64(-1 << 63)  # in place of a document: 'RARE or more documents of this block'
# One row type through the shuffle, of three kinds: entries to be counted (home is NULL), what a document's set is
# (n, sig), and packed (document, key) pairs for the documents of a home.
_SHIPPED = "bucket long, home long, doc_id long, n long, sig binary, packed binary"
_SHIPPED_PA = pa.schema([("bucket", pa.int64()), ("home", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()),
                         ("sig", pa.binary()), ("packed", pa.binary())])
_KNOWN = "home long, doc_id long, n long, sig binary, packed binary"
_KNOWN_PA = pa.schema(list(_SHIPPED_PA)[1:])
_SETS = "doc_id long, n long, sig binary, shared long, keys binary"
_SETS_PA = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("sig", pa.binary()), ("shared", pa.int64()),
                      ("keys", pa.binary())])


def _columns(rows: list[tuple], schema: pa.Schema) -> list[pa.Array]:
    cols = list(zip(*rows)) or [()] * len(schema)
    return [pa.array(c, f.type) for c, f in zip(cols, schema)]


def shingle_set(text: bytes | None, roll: Rolling) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < roll.width:
        # the count keeps a short sequence apart from every shingle of full width
        return np.array([xxhash.xxh3_64_intdigest(b"%d " % len(words) + b" ".join(words))], np.uint64)
    return np.unique(roll(word_hashes(words)))


def _block(ids: list[int], sets: list[np.ndarray], buckets: int, homes: int) -> pa.RecordBatch:
    rows: list[tuple] = []
    owner: dict[bytes, int] = {}
    sigs = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
    for i, (d, g, home) in enumerate(zip(ids, sigs, home_of(np.array(ids, np.int64), homes).tolist())):
        if g is not None and (g not in owner or d < ids[owner[g]]):
            owner[g] = i
        rows.append((home % buckets, home, d, len(sets[i]), g, None))
    pick = sorted(owner.values(), key=lambda i: ids[i])
    if pick:
        cut = [np.unique(sets[i] >> np.uint64(64 - BITS)) for i in pick]
        doc = np.repeat(np.array([ids[i] for i in pick], np.int64), [len(c) for c in cut])
        h = np.concatenate(cut)
        order = np.argsort(h, kind="stable")
        hs, ds = h[order], doc[order]
        starts = split_runs(hs)
        count = np.diff(starts)
        frequent = np.repeat(count >= RARE, count)
        # frequent here: the class is known, documents keep the shingle, and one bare entry tells the reducer
        key = (np.uint64(RARE) << np.uint64(BITS)) | hs[frequent]
        rows += [(home % buckets, home, None, n, None, p) for home, n, p in pairs_by_home(ds[frequent], key, homes)]
        bare = np.zeros(len(hs), bool)
        bare[starts[:-1][count >= RARE]] = True
        keep = ~frequent | bare
        hk, dk = hs[keep], np.where(bare[keep], BARE, ds[keep])
        b = (hk * np.uint64(buckets)) >> np.uint64(BITS)
        cuts = split_runs(b)
        for x, y in zip(cuts[:-1], cuts[1:]):
            by_doc = np.argsort(dk[x:y], kind="stable")
            e = pack(hk[x:y][by_doc], BITS // 8) + pack(deltas(dk[x:y][by_doc]), 8)
            rows.append((int(b[x]), None, None, int(y - x), None, e))
    return pa.RecordBatch.from_arrays(_columns(rows, _SHIPPED_PA), schema=_SHIPPED_PA)


def _scan(words: int, buckets: int, homes: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll, ids, sets, held = Rolling(words), [], [], 0
        for d, t in texts(batches):
            ids.append(d)
            sets.append(shingle_set(t, roll))
            held += len(sets[-1]) + 1
            if held >= block:
                yield _block(ids, sets, buckets, homes)
                ids, sets, held = [], [], 0
        if held:
            yield _block(ids, sets, buckets, homes)
    return run


def _count(homes: int):
    def run(t: pa.Table) -> pa.Table:
        rows, hs, ds, w = [], [], [], BITS // 8
        for row in zip(*(t.column(c).to_pylist() for c in _KNOWN_PA.names)):
            home, _, n, _, p = row
            if home is not None:
                rows.append(row)
                continue
            hs.append(unpack(p[:w * n], n, w))
            ds.append(np.cumsum(unpack(p[w * n:], n, 8, np.int64)))
        if hs:
            h, d = np.concatenate(hs), np.concatenate(ds)
            del hs, ds
            order = np.argsort(h, kind="stable")
            h, d = h[order], d[order]
            starts = split_runs(h)
            count = np.diff(starts)
            total = count + (RARE - 1) * np.add.reduceat((d == BARE).astype(np.int64), starts[:-1])
            cls = np.repeat(np.minimum(total, RARE), count).astype(np.uint64)
            back = (cls >= 2) & (d != BARE)
            key = (cls[back] << np.uint64(BITS)) | h[back]
            rows += [(home, None, n, None, p) for home, n, p in pairs_by_home(d[back], key, homes)]
        return pa.Table.from_arrays(_columns(rows, _KNOWN_PA), schema=_KNOWN_PA)
    return run


def _assemble(t: pa.Table) -> pa.Table:
    """The documents of a home, each with its keys in global order."""
    docs, blobs = [], []
    for _, d, n, sig, p in zip(*(t.column(c).to_pylist() for c in _KNOWN_PA.names)):
        if p is None:
            docs.append((d, n, sig))
        else:
            blobs.append((n, p))
    keys = values_of(np.array([d for d, *_ in docs], np.int64), blobs)
    rows = [(*doc, len(k), np.sort(k).tobytes()) for doc, k in zip(docs, keys)]
    return pa.Table.from_arrays(_columns(rows, _SETS_PA), schema=_SETS_PA)


def shingled(rows: DataFrame, words: int = 5, block: int = BLOCK_SHINGLES) -> DataFrame:
    """Of ``rows`` (doc_id, text; an id each, none NULL): doc_id, n (set size), sig (of the set, NULL if empty), shared, keys (packed, in global order: the shared
    shingles). One document of a block keeps the keys of an equal set."""
    buckets = bucket_count(rows.sparkSession, text_bytes(rows))
    homes = -(-buckets // 4)   # about 16 MB of text each
    known = rows.mapInArrow(_scan(words, buckets, homes, block), _SHIPPED).groupBy("bucket") \
        .applyInArrow(_count(homes), _KNOWN)
    return materialize(known.groupBy("home").applyInArrow(_assemble, _SETS), "shingles")


def need_overlap(a, b, percent: int):
    """Smallest intersection of two sets of these sizes that links them."""
    return -((-percent * (a + b)) // (100 + percent))


def _postings(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        tok, doc, size, pos, lone = [], [], [], [], []
        for d, n, s, k in zip(*(b.column(c).to_pylist() for c in ("doc_id", "n", "shared", "keys"))):
            prefix = n - -(-percent * n // 100) + 1
            take = max(0, prefix - (n - s))
            keys = np.frombuffer(k, np.int64)[:take]
            tok.append(keys)
            pos.append(np.arange(n - s, n - s + len(keys), dtype=np.int64))
            for lst, v in ((doc, d), (size, n), (lone, n - s)):
                lst.append(np.full(len(keys), v, np.int64))
        if tok:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (tok, doc, size, pos, lone)],
                                             names=["token", "doc_id", "n", "pos", "lone"])


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            hit = []
            for na, nb, ka, kb in zip(*(t.column(c).to_pylist() for c in ("na", "nb", "ka", "kb"))):
                hit.append(_linked(na, nb, np.frombuffer(ka, np.uint64), np.frombuffer(kb, np.uint64), percent))
            t = t.select(["a", "b"]).filter(pa.array(hit, pa.bool_()))
            if t.num_rows:
                yield t
    return run


def _linked(na: int, nb: int, x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    need = need_overlap(na, nb, percent)
    if min(len(x), len(y)) < need:
        return False
    # suffix filter: split both at y's middle shingle; an overlap cannot exceed the smaller of each two sides
    mid = y[len(y) // 2]
    i, j = int(np.searchsorted(x, mid)), len(y) // 2
    if min(i, j) + min(len(x) - i, len(y) - j) < need:
        return False
    return len(np.intersect1d(x, y, assume_unique=True)) >= need


def links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link; each is verified once."""
    s = exchanged(sets.select("doc_id", "n", "keys"))
    both = (pairs.join(s.toDF("a", "na", "ka"), "a").join(s.toDF("b", "nb", "kb"), "b")
            .select("a", "b", "na", "nb", "ka", "kb"))
    return both.mapInArrow(_verify(percent), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """doc_id, comp (smallest id reachable) of every id in ``edges`` (a, b). Each round replaces labels by the
    smallest among neighbours and then by their label's label, so long chains shrink geometrically."""
    e = materialize(edges.select(F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")),
                                                   F.struct(F.col("b").alias("x"), F.col("a").alias("y")))).alias("e"))
                    .select("e.*").distinct(), "link-edges")
    label = materialize(e.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("comp"))
                        .select(F.col("x").alias("doc_id"), "comp"), "labels")
    while True:
        near = e.join(exchanged(label), e.y == label.doc_id).groupBy("x").agg(F.min("comp").alias("m"))
        step = label.join(exchanged(near), label.doc_id == near.x, "left") \
            .select("doc_id", "comp", F.least("comp", F.coalesce("m", "comp")).alias("c2"))
        up = label.select(F.col("doc_id").alias("k"), F.col("comp").alias("c3"))
        step = step.join(exchanged(up), F.col("c2") == F.col("k"), "left") \
            .select("doc_id", "comp", F.least("c2", F.coalesce("c3", "c2")).alias("new"))
        step = materialize(step, "labels")
        moved = not step.where("new <> comp").isEmpty()
        label = step.select("doc_id", F.col("new").alias("comp"))
        if not moved:
            return label


def _near(x: str, y: str, percent: int, first: bool = False):
    """Length and positional filter of two postings, ``x`` and ``y`` being the suffixes of their columns. Lone shingles
    (which come first) are in no intersection: at a common shingle, at most the fewer of the shared ones before
    it (none at the ``first`` common one), itself, and the fewer of the ones after it are common."""
    n, pos, lone = (lambda s: F.col("n" + s)), (lambda s: F.col("pos" + s)), (lambda s: F.col("lone" + s))
    need = F.call_function("div", percent * (n(x) + n(y)) + (99 + percent), F.lit(100 + percent).cast("long"))
    most = F.least(n(x) - pos(x), n(y) - pos(y))
    if not first:
        most = most + F.least(pos(x) - lone(x), pos(y) - lone(y))
    return (100 * F.least(n(x), n(y)) >= percent * F.greatest(n(x), n(y))) & (most >= need)


def class_links(reps: DataFrame, percent: int = 80) -> DataFrame:
    """comp of the class representatives ``reps`` (doc_id, n, shared, keys): doc_id, comp for those that link."""
    def postings(batches):
        return _postings(batches, percent)

    open_ = materialize(reps.where((F.col("n") - F.col("shared")) < F.col("n") - F.ceil(F.col("n") * percent / 100.0) + 1),
                        "open-sets")
    post = open_.select("doc_id", "n", "shared", "keys").mapInArrow(
        postings, "token long, doc_id long, n long, pos long, lone long")
    post = materialize(post, "postings")
    pivot = post.groupBy("token").agg(F.min(F.struct("lone", "doc_id", "n", "pos")).alias("p"),
                                      F.count(F.lit(1)).alias("k")).where("k > 1")
    pivot = materialize(pivot.select("token", F.col("p.doc_id").alias("doc2"), F.col("p.n").alias("n2"),
                                     F.col("p.pos").alias("pos2"), F.col("p.lone").alias("lone2")), "pivots")
    near = post.join(exchanged(pivot), "token").where(F.col("doc_id") != F.col("doc2")).where(_near("", "2", percent))
    tried = near.select(F.least("doc_id", "doc2").alias("a"), F.greatest("doc_id", "doc2").alias("b")).distinct()
    tried = materialize(tried, "pivot-pairs")
    found = materialize(links(tried, open_, percent), "pivot-links")
    first = components(found)

    # what is left: pairs of one shingle whose components differ
    labelled = materialize(post.join(exchanged(pivot.select("token")), "token", "left_semi")
                           .join(exchanged(first), "doc_id", "left")
                           .select("token", "doc_id", "n", "pos", "lone", F.coalesce("comp", "doc_id").alias("comp")), "labelled")
    mixed = labelled.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi") \
        .select("token")
    # A pair comes up at the first shingle that its prefixes share, and nowhere else. All shingles that documents of
    # different components share are mixed ones, so no others need to be compared.
    mixed = materialize(labelled.join(exchanged(mixed), "token", "left_semi"), "mixed-postings")
    prefix = mixed.groupBy("doc_id").agg(F.collect_list("token").alias("prefix"))
    x = mixed.join(exchanged(prefix), "doc_id").select("token", "doc_id", "n", "pos", "lone", "comp", "prefix")
    y = x.toDF("token", "doc2", "n2", "pos2", "lone2", "comp2", "prefix2")
    before = F.filter("prefix", lambda t: t < x.token)
    rest = x.join(exchanged(y), (x.token == y.token) & (F.col("comp") < F.col("comp2")) & _near("", "2", percent, first=True)
                  & ~F.arrays_overlap(before, F.col("prefix2"))) \
        .select(F.least("doc_id", "doc2").alias("a"), F.greatest("doc_id", "doc2").alias("b")) \
        .join(exchanged(tried), ["a", "b"], "left_anti")
    more = materialize(links(rest, open_, percent), "cross-links")
    if more.isEmpty():
        return first
    return components(found.unionByName(more))


def key_components(rows: DataFrame, words: int = 5, percent: int = 80, block: int = BLOCK_SHINGLES) -> DataFrame:
    """doc_id, n_shingles, component_id, rep_id (smallest document with the same set) of ``rows`` (doc_id, text; an
    id each, none NULL)."""
    sets = shingled(rows, words, block)
    classes = materialize(sets.where("sig IS NOT NULL").groupBy("sig").agg(F.min("doc_id").alias("rep")), "classes")
    reps = sets.join(exchanged(classes.select(F.col("rep").alias("doc_id"))), "doc_id", "left_semi")
    comp = class_links(reps, percent).select(F.col("doc_id").alias("rep"), "comp")
    named = classes.join(exchanged(comp), "rep", "left").select("sig", "rep", F.coalesce("comp", "rep").alias("comp"))
    out = sets.select("doc_id", "n", "sig").join(exchanged(materialize(named, "named-classes")), "sig", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("comp", "doc_id").alias("component_id"),
                      F.coalesce("rep", "doc_id").alias("rep_id"))


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80, block: int = BLOCK_SHINGLES) -> DataFrame:
    """doc_id, n_shingles, component_id, rep_id of every document id, NULL being one."""
    out = key_components(one_row_per_id(docs.select(id_key().alias("doc_id"), "text")), words, percent, block)
    null = F.lit(MAX_ID)
    return out.select("n_shingles", *[F.nullif(c, null).alias(c) for c in ("doc_id", "component_id", "rep_id")])


def row_components(docs: DataFrame, words: int = 5, percent: int = 80, block: int = BLOCK_SHINGLES) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id of the component) of every row, each with its own text."""
    rows, unique = keyed_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    out = key_components(rows.select(F.col("_row").alias("doc_id"), "text"), words, percent, block) \
        .select("doc_id", "n_shingles", "component_id")
    if unique:
        return out
    # keys have the order of the ids, so the smallest key of a component is that of its smallest id
    own = rows.select(F.col("_row").alias("_own"), F.col("doc_id").alias("_own_id"))
    first = rows.select(F.col("_row").alias("_first"), F.col("doc_id").alias("_first_id"))
    return out.join(exchanged(own), F.col("doc_id") == F.col("_own")) \
        .join(exchanged(first), F.col("component_id") == F.col("_first")) \
        .select(F.col("_own_id").alias("doc_id"), "n_shingles", F.col("_first_id").alias("component_id"))
