"""Mixing sources to target weights by pivotal dependent rounding.

Targets: the mix holds ``share`` (150 %) of all words; sources, ordered by code
point with NULL last, weigh 5, 2, 1 repeating; a target stops at ``cap`` (2)
times its source's size and the excess is reshared by weight among the others
until none is above its cap. Only one row per source takes part in this.

Copies: every document of a source has the same expected number of copies,
c = target / source size. It gets floor(c) copies for sure and one more with
probability c - floor(c). The pivotal method rounds these fractions
dependently: two documents with open fractions meet, and word mass moves from
one to the other, in a random direction with the odds that keep both
expectations, until one fraction is 0 or 1. The sum of size times copies of
the pair does not change, so a whole source misses its target by less than one
document.

Distribution: documents are dealt to leaves by a hash of their id; a leaf
rounds all but one of its documents and passes that residual on; groups of
``fan_in`` residuals are combined level by level until one per source is left,
which is rounded by a draw of its own. Every draw is a hash of the seed and of
the two ids, so reruns agree whatever the partitioning is.

Cases: NULL or empty text has size 0, takes no words and gets no copy; NULL
source is a source of its own; repeated rows (same id) are told apart by their
count and each is a document, with a draw of its own that ``apply_mix`` gives to one row; NULL ids sort last; empty tables and sources
without words give empty results or targets of 0.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, exchanged, id_back, id_key, materialize
from .sharding import keyed_rows

WEIGHTS = (5.0, 2.0, 1.0)
_GOLD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def _draw(seed: int, a: int, b: int, level: int) -> float:
    """Uniform in [0, 1) from a seed, two ids and the tree level."""
    h = (seed * _GOLD + level) & _MASK
    for v in (a, b):
        h = ((h ^ (v & _MASK)) * 0xD6E8FEB86659FD93) & _MASK
        h ^= h >> 32
        h = (h * _GOLD) & _MASK
        h ^= h >> 29
    return (h >> 11) / float(1 << 53)


def targets(sizes: DataFrame, share: float = 1.5, cap: float = 2.0,
            weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """``sizes`` (source, source_size; one row per source) with ``target``.
    Each round caps every source whose share reaches its cap; it ends when no
    more source is capped, after at most as many rounds as there are sources
    and in practice two or three."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (rank % len(weights) + 1).cast("int"))
    s = materialize(sizes.select("source", F.col("source_size").cast("double").alias("source_size"),
                                 w.alias("weight")), "mix-sources")
    total = s.agg(F.sum("source_size")).first()[0] or 0.0
    level, capped_n = 0.0, -1
    while True:
        # the level is words per unit of weight for the sources not capped
        capped = F.col("source_size") * cap <= F.col("weight") * level
        row = s.agg(F.sum(F.when(capped, F.col("source_size") * cap).otherwise(0.0)),
                    F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))), F.count_if(capped)).first()
        if row[2] == capped_n or not row[1]:
            break
        capped_n, level = row[2], (share * total - (row[0] or 0.0)) / row[1]
    target = F.least(F.col("source_size") * cap, F.col("weight") * level)
    return s.select("source", target.alias("target"))


def _round_leaf(ids, nth, sizes, probs, seed: int, level: int):
    """Sequential pivotal rounding of one leaf. Returns the extra copy (0/1)
    of each document and the index of the residual (or -1) with its fraction."""
    extra = np.zeros(len(ids), np.int64)
    held, hp = -1, 0.0
    for i in range(len(ids)):
        p = probs[i]
        if sizes[i] <= 0 or p <= 0.0:
            continue
        if p >= 1.0:
            extra[i] = 1
            continue
        if held < 0:
            held, hp = i, p
            continue
        si, sj = sizes[held], sizes[i]
        up = min((1.0 - hp) * si, p * sj)      # words that can move to the held one
        down = min(hp * si, (1.0 - p) * sj)    # and from it
        u = _draw(seed, int(ids[held]) * 31 + int(nth[held]), int(ids[i]) * 31 + int(nth[i]), level)
        move = up if u * (up + down) < down else -down
        # set the integral side exactly, so no rounding error survives
        if move >= 0 and up == (1.0 - hp) * si:
            extra[held], held, hp = 1, i, p - move / sj
        elif move >= 0:
            hp += move / si
        elif down == hp * si:
            held, hp = i, p - move / sj
        else:
            extra[i] = 1
            hp += move / si
        if hp <= 1e-12 or hp >= 1.0 - 1e-12:
            extra[held] = int(hp > 0.5)
            held = -1
    return extra, held, hp


_SCHEMA = "doc_id long, nth long, size long, sid long, leaf long, p double, extra long, open boolean"


def _leaf(seed: int, level: int):
    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["doc_id", "nth"], kind="stable").reset_index(drop=True)
        extra, held, hp = _round_leaf(g["doc_id"].to_numpy(), g["nth"].to_numpy(), g["size"].to_numpy(),
                                      g["p"].to_numpy(), seed, level)
        g["extra"], g["open"] = extra, False
        if held >= 0:
            g.loc[held, "open"] = True
            g.loc[held, "p"] = hp
        return g[["doc_id", "nth", "size", "sid", "leaf", "p", "extra", "open"]]
    return run


def pivotal(docs: DataFrame, seed: int = 1, leaf_rows: int = 4000, fan_in: int = 256) -> DataFrame:
    """``docs`` (doc_id, nth, size, sid, p) with ``extra`` (0 or 1). ``sid`` is the
    group whose weighted sum is preserved."""
    biggest = docs.groupBy("sid").count().agg(F.max("count")).first()[0] or 0
    leaves = max(1, math.ceil(biggest / leaf_rows))
    state = docs.withColumn("leaf", F.pmod(F.xxhash64("doc_id", "nth"), F.lit(leaves)))
    done, level = [], 0
    while True:
        state = materialize(state.groupBy("sid", "leaf").applyInPandas(_leaf(seed, level), _SCHEMA), "mix-tree")
        done.append(state.where(~F.col("open")).select("doc_id", "nth", "extra"))
        left = state.where("open")
        if leaves == 1:
            break
        leaves, level = math.ceil(leaves / fan_in), level + 1
        state = left.select("doc_id", "nth", "size", "sid", F.call_function("div", "leaf", F.lit(fan_in).cast("long"))
                            .alias("leaf"), "p")
    # one residual per source: a last draw
    u = (F.xxhash64("doc_id", "nth", F.lit(seed)).bitwiseAND((1 << 52) - 1)) / float(1 << 52)
    done.append(left.select("doc_id", "nth", (u < F.col("p")).cast("long").alias("extra")))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def word_count() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")


def sized(docs: DataFrame, row: Column) -> DataFrame:
    """doc_id, source, size, row of every row."""
    return docs.select(id_key().alias("doc_id"), "source", word_count().alias("size"), row.alias("row"))


def mix(docs: DataFrame, share: float = 1.5, cap: float = 2.0, weights: tuple[float, ...] = WEIGHTS,
        seed: int = 1) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken of every row."""
    return _drawn(sized(docs, F.lit(0).cast("long")), share, cap, weights, seed) \
        .select(id_back(), "source", "size", "source_size", "target", "copies", "taken")


def _drawn(rows: DataFrame, share: float = 1.5, cap: float = 2.0, weights: tuple[float, ...] = WEIGHTS,
           seed: int = 1) -> DataFrame:
    """``rows`` (doc_id, source, size, row) with source_size, target, copies and taken. Rows that agree in doc_id,
    source and size have adjoining ``row`` numbers."""
    rows = materialize(rows, "mix-sizes")
    # rows that agree in id, source and size become one row with a multiplicity
    rows = rows.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("times"), F.min("row").alias("row"))
    sizes = materialize(rows.groupBy("source").agg(F.sum(F.col("size") * F.col("times")).alias("source_size")),
                        "mix-source-sizes")
    goal = (sizes.join(targets(sizes, share, cap, weights).withColumnRenamed("source", "s"),
                       F.col("source").eqNullSafe(F.col("s"))).drop("s")
            .withColumn("sid", F.xxhash64(F.col("source").isNull(), "source")))
    goal = materialize(goal, "mix-goals").withColumnRenamed("source", "s")
    per = (rows.join(goal, F.col("source").eqNullSafe(F.col("s"))).drop("s")
           .withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
           .withColumn("row", F.col("row") + F.col("nth") - 1))
    per = per.withColumn("c", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    per = per.select("doc_id", F.xxhash64("source", "size", "nth").alias("nth"), "row", "source", "size",
                     "source_size", "target", "sid", F.floor("c").cast("long").alias("base"), (F.col("c") - F.floor("c")).alias("p"))
    per = materialize(per, "mix-rows")
    extra = pivotal(per.select("doc_id", "nth", "size", "sid", "p"), seed)
    out = per.join(exchanged(extra), ["doc_id", "nth"])
    copies = F.when(F.col("size") > 0, F.col("base") + F.col("extra")).otherwise(0)
    return out.select("doc_id", "row", "source", "size", F.col("source_size").cast("long").alias("source_size"), "target",
                      copies.cast("long").alias("copies"), (copies * F.col("size")).cast("long").alias("taken"))


def apply_mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: each row as many times as it was drawn, with the columns of ``docs``.
    Rows that agree in id, source and size are numbered one after another, and each gets one of their draws."""
    rows, _ = keyed_rows(docs, F.col("source"), word_count())
    taken = _drawn(sized(rows, F.col("_row")), **options).where("copies > 0") \
        .select(F.col("row").alias("_drawn"), F.col("copies").alias("_each"))
    rows = rows.join(exchanged(taken), F.col("_row") == F.col("_drawn"))
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_each").cast("int")))).select(*docs.columns)
