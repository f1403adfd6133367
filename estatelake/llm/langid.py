"""Language ID by string kernels: blended-spectrum n-gram presence kernels,
Nyström landmarks and one-versus-rest kernel ridge regression.

* Features: a text is lower-cased, every non-letter becomes a blank, runs of
  blanks count once; its character n-grams of 1 to 3 are hashed to ``2**bits`` slots
  and only their presence counts. k(x, y) = |grams(x) and grams(y)| /
  sqrt(|grams(x)| * |grams(y)|).
* Fit: per language the ``per_language`` labelled rows with the smallest id
  hashes, at most ``max_rows`` in all (a bounded sample, fixed by id and so the
  same on every run); ``landmarks`` of them, dealt over the languages, span the
  Nyström space, in which ridge regression fits +1 / -1 per language.
* Scoring: tasks turn batches of whole texts into presence matrices; two matrix
  products give all languages' scores. The best one wins, ties go to the
  smaller name; ``score`` is (value + 1) / 2 cut to 0..1.

Language, source and id are not inputs of a prediction.

Cases: NULL text and text without a letter get ``und`` with score 0; repeated rows
are predicted alike; with no labelled row every text is ``und``; NULL ids come
back as NULL; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import share

BITS = 14
_ODD = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def _letter_table() -> np.ndarray:
    """Code point to itself for letters of the basic plane, to a blank for all else. The last slot is for
    everything beyond that plane."""
    t = np.full(0x10001, 32, np.uint32)
    letters = [c for c in range(0x10000) if chr(c).isalpha()]
    t[letters] = letters
    return t


def presence(text: str | None, row: np.ndarray, table: np.ndarray, bits: int = BITS) -> bool:
    """Mark the n-gram slots of a text in ``row``; False when it has no letter."""
    c = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    c = table[np.minimum(c, 0x10000)]
    if not (c != 32).any():
        # letters beyond the basic plane are letters too, with nothing to learn from
        return any(ch.isalpha() for ch in text or "")
    c = np.concatenate([[32], c, [32]]).astype(np.uint32)
    c = c[np.concatenate([[True], (c[1:] != 32) | (c[:-1] != 32)])]
    shift = np.uint32(32 - bits)
    g = c * _ODD[0]
    row[g >> shift] = 1
    g = (g[:-1] ^ (g[:-1] >> np.uint32(15))) * _ODD[1] + c[1:]
    row[(g * _ODD[2]) >> shift] = 1
    g = (g[:-1] ^ (g[:-1] >> np.uint32(13))) * _ODD[1] + c[2:]
    row[(g * _ODD[2]) >> shift] = 1
    return True


@dataclass
class Model:
    names: list[str]
    landmarks: np.ndarray    # m x slots, uint8
    root: np.ndarray         # m, square roots of the landmarks' gram counts
    weights: np.ndarray      # m x languages


def _kernel(x: np.ndarray, landmarks: np.ndarray, root: np.ndarray) -> np.ndarray:
    own = np.sqrt(np.maximum(x.sum(1), 1))
    return (x @ landmarks.T) / own[:, None] / root[None, :]


def fit(rows: list[tuple[str, np.ndarray]], landmarks: int = 160, ridge: float = 1.0) -> Model | None:
    """``rows``: (language, presence vector), in a fixed order."""
    if not rows:
        return None
    names = sorted({n for n, _ in rows}, key=lambda s: s.encode())
    x = np.stack([v for _, v in rows]).astype(np.float32)
    y = np.array([[1.0 if n == m else -1.0 for m in names] for n, _ in rows])
    seen = dict.fromkeys(names, 0)
    turn = []
    for i, (n, _) in enumerate(rows):   # landmarks are dealt over the languages
        turn.append((seen[n], n, i))
        seen[n] += 1
    pick = [i for *_, i in sorted(turn)[:landmarks]]
    marks = x[pick]
    root = np.sqrt(np.maximum(marks.sum(1), 1))
    inner = _kernel(marks, marks, root).astype(np.float64)
    value, vector = np.linalg.eigh((inner + inner.T) / 2)
    keep = value > 1e-6 * value[-1]
    half = vector[:, keep] / np.sqrt(value[keep])          # Nyström map: k(x, marks) @ half
    phi = _kernel(x, marks, root) @ half
    w = np.linalg.solve(phi.T @ phi + ridge * np.eye(phi.shape[1]), phi.T @ y)
    return Model(names, marks.astype(np.uint8), root.astype(np.float32), (half @ w).astype(np.float32))


def _bits(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _letter_table()
        for b in batches:
            packed = []
            for t in b.column(2).to_pylist():
                row = np.zeros(1 << bits, np.uint8)
                packed.append(np.packbits(row).tobytes() if presence(t, row, table, bits) and row.any() else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(packed, pa.binary())],
                                             names=["key", "lang", "grams"])
    return run


def train(labelled: DataFrame, per_language: int = 250, max_rows: int = 8192, landmarks: int = 160,
          bits: int = BITS) -> Model | None:
    """Fit on a bounded sample of ``labelled`` (doc_id, text, lang). At most ``max_rows`` presence vectors
    (2**bits / 8 bytes each) reach the driver."""
    rows = labelled.select(F.xxhash64("doc_id").alias("key"), "lang", "text").where("lang IS NOT NULL AND text IS NOT NULL")
    narrow = rows.select("key", "lang").distinct()
    # a language may hold most rows: the smallest of each salt first, then the smallest of those
    pick = narrow.withColumn("salt", F.pmod("key", F.lit(64)))
    for group in (["lang", "salt"], ["lang"]):
        nth = F.row_number().over(Window.partitionBy(*group).orderBy("key"))
        pick = pick.withColumn("nth", nth).where(F.col("nth") <= per_language)
    pick = pick.orderBy("nth", "lang").limit(max_rows)
    rows = rows.join(F.broadcast(pick.select("key", "lang")), ["key", "lang"]).select("key", "lang", "text")
    got = rows.mapInArrow(_bits(bits), "key long, lang string, grams binary").where("grams IS NOT NULL")
    # rows that repeat a picked id are folded before they travel
    got = got.groupBy("key", "lang").agg(F.min("grams").alias("grams")).toPandas().sort_values(["key", "lang"])
    return fit([(n, np.unpackbits(np.frombuffer(g, np.uint8))) for n, g in zip(got["lang"], got["grams"])], landmarks)


_OUT = "doc_id long, lang_pred string, score double"
_OUT_PA = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


def _score(model, bits: int, chunk: int = 128):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, m = _letter_table(), model()
        marks = None if m is None else m.landmarks.astype(np.float32)
        for b in batches:
            for at in range(0, b.num_rows, chunk):
                part = b.slice(at, chunk)
                x = np.zeros((part.num_rows, 1 << bits), np.uint8)
                known = np.array([presence(t, x[i], table, bits) for i, t in enumerate(part.column(1).to_pylist())], bool)
                if m is None:
                    lang, score = [None] * part.num_rows, np.zeros(part.num_rows)
                    known[:] = False
                else:
                    f = _kernel(x.astype(np.float32), marks, m.root) @ m.weights
                    best = f.argmax(1)
                    lang = [m.names[i] for i in best]
                    score = np.clip((f.max(1).astype(np.float64) + 1) / 2, 0, 1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([n if k else "und" for n, k in zip(lang, known)], pa.string()),
                     pa.array(np.where(known, score, 0.0))], schema=_OUT_PA)
    return run


def predict(docs: DataFrame, model: Model | None, bits: int = BITS) -> DataFrame:
    """doc_id, lang_pred, score of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_score(share(docs.sparkSession, model), bits), _OUT)


def held_out():
    """Rows that never train: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, **options) -> Model | None:
    """Fit on the labelled rows that have an id and are not held out."""
    return train(docs.where(~held_out() & F.col("doc_id").isNotNull()).select("doc_id", "text", "lang"), **options)


def identify(docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row, learned from the rows that are not held out."""
    return predict(docs, learn(docs, **options)).withColumn("held_out", held_out()).select("doc_id", "held_out", "lang_pred", "score")
