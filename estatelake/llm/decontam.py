"""Benchmark decontamination: BM25 over an inverted index of the test items,
searched with block-max WAND, one query per training passage.

* Statistics: document frequencies, number of items and mean length are computed
  once in Spark over the whole benchmark, and so is each length class's longest item. A
  posting holds the BM25 impact of a term in an item, divided by the item's own
  total, so a passage that holds every term of an item scores 1 and one threshold
  serves all items. Nothing of this depends on how the index is cut.
* Index: sorted posting lists in flat arrays, the largest impact of each term, and its
  largest impact per block of ``block_items`` items. The index is cut into parts of about
  ``max_index_bytes``, each broadcast for a pass of its own over the corpus; the benchmark passes
  through the driver one part at a time.
* Queries: every whole training text is cut into passages of 2L words that
  start every L words, L being the class's longest item, so a copied item always
  lies wholly inside one passage. A passage's query is its distinct terms.
* Search: a passage's terms are ordered by their largest impacts. Those before the
  pivot, where the running sum reaches the threshold, cannot reach it by
  themselves, so only the lists from the pivot on are read for candidates. A candidate
  goes on while its impacts there plus the bound of the others can reach
  the threshold, first with the terms' maxima, then with the maxima of its block; what is left is scored exactly. Bounds are never
  below a score, so everything at or above the threshold is retrieved. Batches of passages take
  each step together, in pieces of bounded size.
* Verification: an item's answer is its last sentence (the last third of its
  words when it has one sentence), the rest is its question. Of both, at least
  ``overlap`` of the word trigrams must occur in the passage.

Cases: NULL or empty text matches nothing; NULL or empty items, and items of
punctuation only, are never found; rows that repeat an id are
searched one by one; repeated items are each reported; NULL doc ids come back as
NULL; empty tables give empty results.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import exchanged, materialize, share, texts
from .sharding import keyed_rows

_BLANK = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_OUT = ("doc_id long, item_id long, score double, question_overlap double, answer_overlap double, "
        "start_word long, end_word long")
_OUT_PA = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()),
                     ("question_overlap", pa.float64()), ("answer_overlap", pa.float64()),
                     ("start_word", pa.int64()), ("end_word", pa.int64())])
SPAN_CLASS = 64  # items of up to 64, 256, 1024, ... words share an index


def terms(text: str | None) -> list[bytes]:
    """Lower-cased words; ASCII punctuation separates them."""
    return (text or "").lower().encode("utf-8", "replace").translate(_BLANK).split()


def parts(text: str) -> tuple[list[bytes], list[bytes]]:
    """(question, answer) words of an item."""
    sentences = [s for s in re.split(r"(?<=[.?!])\s+", text.strip()) if terms(s)]
    if len(sentences) > 1:
        return [w for s in sentences[:-1] for w in terms(s)], terms(sentences[-1])
    words = terms(text)
    cut = max(1, math.ceil(len(words) * 2 / 3))
    return words[:cut], words[cut:]


def grams(words: list, n: int = 3) -> set[tuple]:
    n = min(n, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set()


K1, B = 1.2, 0.75
_ITEM = "place long, item_id long, text string, n long, terms array<struct<term:binary,tf:long>>"


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("term", pa.binary()), ("tf", pa.int64())]))
    for b in batches:
        words = [terms(t) for t in b.column(2).to_pylist()]
        counts = [[{"term": w, "tf": k} for w, k in sorted(Counter(ws).items())] for ws in words]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array([len(w) for w in words], pa.int64()), pa.array(counts, kind)],
                                         names=["place", "item_id", "text", "n", "terms"])


def length_class(n: Column) -> Column:
    return F.when(n <= SPAN_CLASS, 0).otherwise(F.ceil(F.log(4.0, n / SPAN_CLASS) - 1e-9)).cast("int")


def weighted_items(benchmark: DataFrame) -> DataFrame:
    """place, item_id, text, class, span, terms (term, impact) of every item with a word; statistics are those of all
    items. Impacts of an item add up to 1."""
    items = benchmark.select(F.monotonically_increasing_id().alias("place"), F.col("item_id").cast("long").alias("item_id"), "text")
    items = items.where("item_id IS NOT NULL AND text IS NOT NULL").mapInArrow(_item_rows, _ITEM)
    items = materialize(items.where("n > 0").withColumn("class", length_class(F.col("n"))), "benchmark-items")
    count, mean = items.agg(F.count(F.lit(1)), F.avg("n")).first()
    each = items.select("place", "n", F.inline("terms"))
    df = each.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log1p((F.lit(count) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = K1 * (1 - B + B * F.col("n") / F.lit(float(mean or 1)))
    w = each.join(exchanged(df), "term").select("place", "term", (idf * F.col("tf") * (K1 + 1) / (F.col("tf") + norm)).alias("w"))
    w = w.groupBy("place").agg(F.sort_array(F.collect_list(F.struct("term", "w"))).alias("w"))      # a row of one item
    total = F.aggregate("w", F.lit(0.0), lambda acc, x: acc + x["w"])
    w = w.select("place", F.transform("w", lambda x: F.struct(x["term"].alias("term"), (x["w"] / total).cast("float").alias("impact"))).alias("weights"))
    spans = items.groupBy("class").agg(F.max("n").alias("span"))
    return materialize(items.drop("terms").join(exchanged(w), "place").join(F.broadcast(spans), "class"), "benchmark-impacts")   # one row a class


@dataclass
class Index:
    span: int                        # passages are 2 * span words
    vocab: dict[bytes, int]          # numbers follow the terms' order
    ids: np.ndarray                  # item ids
    start: np.ndarray                # postings of term t: start[t] to start[t + 1]
    item: np.ndarray                 # sorted in each list
    impact: np.ndarray               # float32
    top: np.ndarray                  # largest impact of a term
    block_items: int
    block_start: np.ndarray          # blocks of term t: block_start[t] to block_start[t + 1]
    block: np.ndarray                # sorted for each term
    block_level: np.ndarray          # largest impact of the term in the block, in 255ths of its top, rounded up
    words: np.ndarray                # all items' words, question first
    word_start: np.ndarray
    question: np.ndarray             # words of the question

    def bytes(self) -> int:
        arrays = (self.ids, self.start, self.item, self.impact, self.top, self.block_start, self.block, self.block_level, self.words, self.word_start, self.question)
        return sum(a.nbytes for a in arrays) + sum(map(len, self.vocab))

    @property
    def blocks(self) -> int:
        return -(-len(self.ids) // self.block_items)


def _small(values) -> np.ndarray:
    """Non-negative integers in the narrowest type that holds them."""
    values = np.asarray(values, np.int64)
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))


def build_index(rows: list, block_items: int = 16) -> Index:
    """``rows`` of ``weighted_items``, all of one class."""
    rows = sorted(rows, key=lambda r: (r["item_id"], r["text"]))
    vocab = {t: i for i, t in enumerate(sorted({bytes(x["term"]) for r in rows for x in r["weights"]}))}
    term = np.array([vocab[bytes(x["term"])] for r in rows for x in r["weights"]], np.int64)
    item = np.repeat(np.arange(len(rows)), [len(r["weights"]) for r in rows])
    impact = np.array([x["impact"] for r in rows for x in r["weights"]], np.float32)
    order = np.lexsort((item, term))
    term, item, impact = term[order], item[order], impact[order]
    start = np.searchsorted(term, np.arange(len(vocab) + 1))
    blocks = -(-len(rows) // block_items)
    key = term * blocks + item // block_items
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    top = np.maximum.reduceat(impact, start[:-1])
    level = np.ceil(np.maximum.reduceat(impact, first) / top[term[first]] * 255 - 1e-4).astype(np.uint8)
    halves = [parts(r["text"]) for r in rows]
    words = [[vocab[w] for w in q + a] for q, a in halves]
    return Index(rows[0]["span"], vocab, np.array([r["item_id"] for r in rows], np.int64), _small(start), _small(item), impact,
                 top, block_items, _small(np.searchsorted(term[first], np.arange(len(vocab) + 1))), _small(key[first] % blocks), level,
                 _small([w for ws in words for w in ws]), _small(np.cumsum([0] + [len(w) for w in words])),
                 _small([len(q) for q, _ in halves]))


EPS = 1e-6   # impacts are rounded to float32


def _ragged(start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which range, place) of every element of the ranges ``start`` to ``start + count``."""
    owner = np.repeat(np.arange(len(start)), count)
    return owner, np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + start[owner]


def _pieces(cost: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges whose costs stay within ``most``, or hold one element."""
    at, run = 0, np.cumsum(cost)
    while at < len(cost):
        end = max(at + 1, int(np.searchsorted(run, (run[at - 1] if at else 0) + most, "right")))
        yield at, end
        at = end


TABLE = 1 << 22   # entries of a lookup table; beyond it keys are searched, with the same result


def _lookup(keys: np.ndarray, values: np.ndarray, size: int):
    """Function from numbers below ``size`` to the values of sorted ``keys``, 0 where there is none."""
    if size <= TABLE:
        table = np.zeros(size, np.float32)
        table[keys] = values
        return lambda wanted: table.take(wanted)

    def find(wanted):
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, values[at], np.float32(0))
    return find


class Reader:
    """An index made ready for searching, in the task: posting lists, and lookups of a term's impact by block and by
    item."""

    def __init__(self, ix: Index):
        self.ix, self.n = ix, len(ix.ids)
        start = ix.start.astype(np.int64)
        self.start, self.size = start[:-1], np.diff(start)
        term = np.repeat(np.arange(len(self.size)), self.size)
        own = np.repeat(np.arange(len(self.size)), np.diff(ix.block_start.astype(np.int64)))
        self.in_block = _lookup(own * ix.blocks + ix.block, ix.block_level * (ix.top[own] / np.float32(255) * np.float32(1 + 1e-3)),
                                len(self.size) * ix.blocks)
        self.in_item = _lookup(term * self.n + ix.item, ix.impact, len(self.size) * self.n)
        self.item = ix.item.astype(np.int64)


def _sum_by(owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, values, n)


def search(reader: Reader, docs: list[list[bytes]], threshold: float, most: int = 1 << 21) -> Iterator[tuple[int, int, int, float]]:
    """(document, passage, item position, score) of every passage and item at or above the threshold."""
    ix = reader.ix
    size = len(ix.vocab)
    keys, base, owner = [], 0, []
    for d, words in enumerate(docs):
        n = len(words)
        t = np.fromiter(map(ix.vocab.get, words, repeat(-1)), np.int64, n)
        at = np.flatnonzero(t >= 0)
        t, p = t[at], at // ix.span
        passages = max(1, math.ceil(n / ix.span))
        # a word belongs to the passage that starts at or before its span, and to the one before that
        keys += [(base + p) * size + t, (base + p[p > 0] - 1) * size + t[p > 0]]
        owner.append((base, passages))
        base += passages
    key = np.sort(np.concatenate(keys)) if keys else np.empty(0, np.int64)
    if not len(key):
        return
    key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    term, passage = key % size, key // size
    cut = np.concatenate([[0], np.flatnonzero(np.diff(passage)) + 1])
    live = np.add.reduceat(ix.top[term].astype(np.float64), cut) >= threshold - EPS
    if not live.any():
        return
    count = np.diff(np.concatenate([cut, [len(term)]]))
    term, name, count = term[np.repeat(live, count)], passage[cut][live], count[live]
    lists = reader.size[term]
    starts = np.array([b for b, _ in owner])
    begin = np.cumsum(count) - count
    # the work of a passage is at most its terms' postings
    for a, b in _pieces(np.add.reduceat(lists, begin), most):
        lo, hi = begin[a], begin[b - 1] + count[b - 1]
        for g, item, score in _candidates(reader, term[lo:hi], count[a:b], threshold, most):
            g = name[a + g]
            d = int(np.searchsorted(starts, g, "right")) - 1
            yield d, int(g - starts[d]), int(item), float(score)


def _candidates(reader: Reader, term: np.ndarray, count: np.ndarray, threshold: float, most: int):
    """(passage, item, score) at or above the threshold; ``count`` terms of each passage, in order."""
    ix, n_items = reader.ix, reader.n
    group = np.repeat(np.arange(len(count)), count)
    order = np.lexsort((ix.top[term], group))
    t, g = term[order], group[order]
    begin = np.cumsum(count) - count
    run = np.cumsum(ix.top[t].astype(np.float64))
    run -= np.repeat(run[begin] - ix.top[t[begin]], count)
    pivot = run >= threshold - EPS
    rest = np.zeros(len(count))                   # what the terms before the pivot can add
    np.maximum.at(rest, g[~pivot], run[~pivot])
    own, at = _ragged(reader.start[t[pivot]], reader.size[t[pivot]])
    pair = g[pivot][own] * n_items + reader.item[at]
    if len(count) * n_items <= TABLE:             # few enough pairs to count in place
        have = _sum_by(pair, ix.impact[at], len(count) * n_items)
        found = np.flatnonzero(have)
        have = have[found]
    else:
        found, which = np.unique(pair, return_inverse=True)
        have = _sum_by(which, ix.impact[at], len(found))
    pg = found // n_items
    go = have + rest[pg] >= threshold - EPS
    found, have, pg = found[go], have[go], pg[go]
    if not len(found):
        return
    # the same with the maxima of the candidate's block
    before, quiet = t[~pivot], np.bincount(g[~pivot], minlength=len(count))
    quiet_begin = np.cumsum(quiet) - quiet
    blocks = ix.blocks
    at_block = pg * blocks + found % n_items // ix.block_items      # sorted, as the pairs are
    fresh = np.concatenate([[True], at_block[1:] != at_block[:-1]])
    cell, back = at_block[fresh], np.cumsum(fresh) - 1
    bound = np.empty(len(cell))
    for x, y in _pieces(quiet[cell // blocks] + 1, most):
        cg, cb = cell[x:y] // blocks, cell[x:y] % blocks
        who, where = _ragged(quiet_begin[cg], quiet[cg])
        bound[x:y] = _sum_by(who, reader.in_block(before[where] * blocks + cb[who]), y - x)
    go = have + bound[back] >= threshold - EPS
    found, pg = found[go], pg[go]
    for x, y in _pieces(count[pg] + 1, most):
        who, where = _ragged(begin[pg[x:y]], count[pg[x:y]])
        item = found[x:y] % n_items
        score = _sum_by(who, reader.in_item(term[where] * n_items + item[who]), y - x)
        for i in np.flatnonzero(score >= threshold - EPS):
            yield pg[x + i], item[i], score[i]


def _share(part: set, have: set) -> float:
    return len(part & have) / len(part) if part else 1.0


def _checks(ix: Index, item: int) -> tuple[set, set]:
    """Question and answer trigrams of an item, as numbers of terms."""
    words = ix.words[int(ix.word_start[item]):int(ix.word_start[item + 1])].tolist()
    return grams(words[:ix.question[item]]), grams(words[ix.question[item]:])


def _verified(ix: Index, words: list[list[bytes]], hits, overlap: float) -> dict:
    best: dict[tuple[int, int], tuple] = {}
    checks: dict[int, tuple[set, set]] = {}        # of this batch's hits
    for d, passage, item, score in hits:
        a, b = passage * ix.span, min(len(words[d]), (passage + 2) * ix.span)
        text = [ix.vocab.get(w, -1) for w in words[d][a:b]]
        if item not in checks:
            checks[item] = _checks(ix, item)
        have: set = set()
        for n in {len(next(iter(p))) for p in checks[item] if p}:
            have |= grams(text, n) if len(text) >= n else set()
        q, r = (_share(p, have) for p in checks[item])
        if q >= overlap and r >= overlap:
            row = (score, q, r, -a, b)
            if row > best.get((d, item), (-1.0,)):
                best[d, item] = row
    return best


def _match(indexes, threshold: float, overlap: float, batch_words: int = 150_000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readers = [Reader(ix) for ix in indexes()]

        def flush(ids, words):
            out: dict[str, list] = {k: [] for k in _OUT_PA.names}
            for reader in readers:
                ix = reader.ix
                found = _verified(ix, words, search(reader, words, threshold), overlap)
                for (d, item), (score, q, r, a, b) in found.items():
                    for k, v in zip(out, (ids[d], int(ix.ids[item]), score, q, r, -a, b)):
                        out[k].append(v)
            return pa.RecordBatch.from_pydict(out, schema=_OUT_PA)

        ids, words, held = [], [], 0
        for d, t in texts(batches, as_bytes=False):
            w = terms(t)
            if not w:
                continue
            ids.append(d)
            words.append(w)
            held += len(w)
            if held >= batch_words:
                yield flush(ids, words)
                ids, words, held = [], [], 0
        if ids:
            yield flush(ids, words)
    return run


def index_parts(items: DataFrame, max_index_bytes: int) -> Iterator[list[Index]]:
    """Indexes of one pass after the other, of about ``max_index_bytes`` each. One row per class and part is known
    beforehand, items only while their pass is built."""
    cost = 20 * F.size("weights") + 6 * F.col("n") + 100
    sizes = {r["class"]: r["b"] for r in items.groupBy("class").agg(F.sum(cost.cast("long")).alias("b")).collect()}
    cuts = {c: max(1, math.ceil(b / max_index_bytes)) for c, b in sizes.items()}
    passes, room = [], 0
    for c, k in sorted(cuts.items()):
        for part in range(k):
            if not passes or sizes[c] / k > room:
                passes.append([])
                room = max_index_bytes
            passes[-1].append((c, k, part))
            room -= sizes[c] / k
    for some in passes:
        out = []
        for c, k, part in some:
            rows = items.where((F.col("class") == c) & (F.pmod(F.xxhash64("item_id", "text"), F.lit(k)) == part)).collect()
            out += [build_index(rows)] if rows else []
        if out:
            yield out


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.6, overlap: float = 0.5,
          max_index_bytes: int = 32 << 20) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap, start_word, end_word: the verified leaks, best
    passage of each document row and item."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for indexes in index_parts(weighted_items(benchmark), max_index_bytes):
        found = rows.mapInArrow(_match(share(spark, indexes), threshold, overlap), _OUT)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], _OUT) if out is None else out


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows whose text leaks an item."""
    rows, _ = keyed_rows(docs)
    bad = leaks(rows.select(F.col("_row").alias("doc_id"), "text"), benchmark, **options)
    bad = bad.select(F.col("doc_id").alias("_bad")).distinct()
    return rows.join(exchanged(bad), F.col("_row") == F.col("_bad"), "left_anti").select(*docs.columns)
