"""Personal data: exact expressions plus a character-level BiLSTM-CRF.

Four kinds have exact expressions (the base spans): email, ip, card, phone.
Written another way - ``ann [at] host [dot] org``, ``10[.]0[.]0[.]1``, a card in dotted groups,
a phone number without its plus - they escape those, so a tagger is trained on
labelled spans and adds what it finds (``email_like`` and so on).

* Labels: the base spans of at most ``max_rows`` rows, those with the smallest
  hashes among rows that hold a digit group, ``@`` or ``+`` (a bounded sample, the same
  on every run), at most ``per_row`` windows each. Half of the labelled spans are
  respelled for training, with their labels; numbers that are no personal data
  are set between the words of other windows as counter-examples.
* Model: characters, a bidirectional LSTM and a linear-chain CRF over begin /
  inside tags, trained in numpy by back-propagation and Adam with a fixed seed.
* Decoding: whole texts are cut into overlapping windows that are tagged by
  Viterbi, many at a time. Windows from which no span can come that holds up (below; it takes digits, or
  an "at" before a name and a dot) are passed over, unless a span of a neighbour reaches into them; this is exact. A bound on what any tagged stretch could gain over "no
  tag at all" (largest emission margins plus largest transition gains, best
  stretch by one running sum) proves most windows empty without Viterbi; this is
  exact. Spans carry the least posterior of their characters.
* Reconciling: spans that a window's edge cuts are united with the
  neighbour's part; then, over the whole text, the set of disjoint spans with the
  largest total weight stays (weighted interval scheduling). Spans that meet a
  base span, fall short of ``least`` or do not hold up (card: 13 to 19 digits passing
  Luhn, ip: four parts up to 255, phone: 9 to 15 digits, email: one that the
  base expression accepts once spelled plainly) are dropped. Base spans always stay.

Base spans take linear time on any text. Memory is bounded by one text and one
block of windows; a text of any length is processed whole.

Cases: NULL text is empty and has no spans; repeated rows are scanned one by
one; NULL ids come back as NULL; without a labelled span there is no model and only
base spans are found; an empty table gives an empty result.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import share

KINDS = ("email", "ip", "card", "phone")
LIKE = tuple(f"{k}_like" for k in KINDS)

# ---------------------------------------------------------------- base spans
# The fixed expressions of the four kinds, written so that no run of characters is scanned more than a few times: a match
# of ip can only start where a digit run starts (it ends where one ends), and an email is looked for from its "@".
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_TAIL = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end = 0
    for m in _TAIL.finditer(text):
        low = max(end, text.rfind("@", end, m.start()) + 1)
        start = low + len(text[low:m.start()].rstrip(_LOCAL))
        if start < m.start():
            end = m.end()
            yield start, end


def _ip_parts(parts: list[str]) -> bool:
    parts = [p.lstrip("0") or "0" for p in parts]
    return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end): leftmost non-overlapping matches of each kind, failing ones dropped."""
    out = [(0, a, b) for a, b in _emails(text)]
    out += [(1, *m.span()) for m in _IP.finditer(text) if _ip_parts(m.group().split("."))]
    for m in _CARD.finditer(text):
        d = _digits(m.group()) if len(m.group()) <= 40 else ""
        if 13 <= len(d) <= 19 and luhn(d):
            out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            out.append((3, *m.span()))
    return out


_AT = re.compile(r"\s*[\[({<]\s*(?:at|@)\s*[\])}>]\s*|\s+at\s+|\s*@\s*", re.I)
_DOT = re.compile(r"\s*[\[({<]\s*(?:dot|\.)\s*[\])}>]\s*|\s+dot\s+|\s*\.\s*", re.I)
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")


def holds_up(kind: int, value: str) -> bool:
    """Whether a tagged text can be what its tag says."""
    if len(value) > 320:
        return False
    d = _digits(value)
    if kind == 0:
        return _EMAIL.fullmatch(_DOT.sub(".", _AT.sub("@", value))) is not None
    if kind == 1:
        return _ip_parts(re.findall(r"[0-9]+", value))
    if kind == 2:
        return 13 <= len(d) <= 19 and luhn(d)
    return 9 <= len(d) <= 15


# ---------------------------------------------------------------- respelling
def respell(kind: int, value: str, rng: random.Random) -> str:
    """Another way to write a labelled value that the base expressions do not know."""
    if kind == 0:
        user, host = value.split("@", 1)
        at = rng.choice([" [at] ", " (at) ", "[at]", "(at)", " at ", " AT ", " @ "])
        dot = rng.choice([" [dot] ", " (dot) ", "[dot]", "(dot)", " dot ", " DOT ", "."])
        return (user.replace(".", dot) if rng.random() < 0.3 else user) + at + host.replace(".", dot)
    if kind == 1:
        return value.replace(".", rng.choice(["[.]", "(.)", " . ", "[dot]", "(dot)"]))
    d = _digits(value)
    if kind == 2:
        return rng.choice([".", "/", "_", " - ", "  "]).join(d[i:i + 4] for i in range(0, len(d), 4))
    local = d[-10:]
    a, b, c = local[:3], local[3:6], local[6:]
    return rng.choice([f"({a}) {b}-{c}", f"({a}) {b} {c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"001-{a}-{b}-{c}", f"00 1 {a} {b} {c}", f"1-{a}-{b}-{c}"])


def decoy(rng: random.Random) -> str:
    """Numbers and codes that are no personal data."""
    n = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    form = rng.randrange(8)
    if form == 0:
        return n(rng.randrange(1, 8))
    if form == 1:
        return f"{rng.randrange(20)}.{rng.randrange(20)}" + rng.choice(["", ".", f".{rng.randrange(20)}"])
    if form == 2:
        return "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([8, 16, 18, 32, 40])))
    if form == 3:
        return f"{rng.randrange(1900, 2100)}-{rng.randrange(1, 13):02}-{rng.randrange(1, 29):02}"
    if form == 4:
        return rng.choice(["$", "EUR ", ""]) + f"{n(3)},{n(3)}" + rng.choice(["", ".00"])
    if form == 5:
        return "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(20))
    if form == 6:
        return rng.choice(["meet at ten", "look at this", "a dot on the map", "(at) the end", "[dot]"])
    return f"({n(rng.randrange(1, 4))})" + rng.choice(["", f" {n(2)}"])


# ---------------------------------------------------------------- characters and tags
PAD = 0


def _letters() -> np.ndarray:
    """Code point to character class: ASCII one by one, then letters, digits, blanks and all else."""
    t = np.full(0x10001, 4, np.uint8)
    for c in range(0x10000):
        ch = chr(c)
        if 32 <= c < 127:
            t[c] = c - 32 + 8
        elif ch == "\n":
            t[c] = 1
        elif ch.isspace():
            t[c] = 2
        elif ch.isdigit():
            t[c] = 3
        elif ch.isalpha():
            t[c] = 5 if ch.isupper() else 6
    return t


CLASSES = 8 + 95
TAGS = 1 + 2 * len(KINDS)     # 0: none, 1 + 2k: begins kind k, 2 + 2k: goes on


def encode(text: str, table: np.ndarray) -> np.ndarray:
    return table[np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), 0x10000)]


def forbidden() -> np.ndarray:
    """Transitions to "goes on" from anything but the same kind."""
    out = np.zeros((TAGS, TAGS), bool)
    for k in range(len(KINDS)):
        out[:, 2 + 2 * k] = True
        out[1 + 2 * k, 2 + 2 * k] = out[2 + 2 * k, 2 + 2 * k] = False
    return out


@dataclass
class Model:
    """Gate order: input, forget, output, candidate. One entry per direction in ``wx``, ``wh``, ``b``."""
    wx: np.ndarray    # 2 x classes x 4 hidden
    wh: np.ndarray    # 2 x hidden x 4 hidden
    b: np.ndarray     # 2 x 4 hidden
    wo: np.ndarray    # 2 hidden x tags
    bo: np.ndarray    # tags
    trans: np.ndarray  # tags x tags

    def params(self) -> list[np.ndarray]:
        return [self.wx, self.wh, self.b, self.wo, self.bo, self.trans]

    def half(self) -> "Model":
        """float32 and transposed (gates x windows keeps every gate contiguous), with the sigmoid gates' inputs halved:
        sigmoid(x) = (1 + tanh(x / 2)) / 2."""
        h = self.wh.shape[1]
        scale = np.r_[np.full(3 * h, 0.5), np.ones(h)]
        f = lambda x: np.ascontiguousarray(x, np.float32)
        return Model(f(((self.wx + self.b[:, None]) * scale).transpose(0, 2, 1)), f((self.wh * scale).transpose(0, 2, 1)),
                     f(self.b), f(self.wo.T), f(self.bo), self.trans)


def emissions(m: Model, x: np.ndarray) -> np.ndarray:
    """time x tags x windows for a time x windows matrix of classes; ``m`` as ``half`` gives it."""
    steps, n = x.shape
    h = m.wh.shape[2]
    out = np.empty((steps, 2 * h, n), np.float32)
    z, part = np.empty((4 * h, n), np.float32), np.empty((4 * h, n), np.float32)
    for side in (0, 1):
        state, cell = np.zeros((h, n), np.float32), np.zeros((h, n), np.float32)
        for t in range(steps) if side == 0 else range(steps - 1, -1, -1):
            np.matmul(m.wh[side], state, out=z)
            m.wx[side].take(x[t], axis=1, out=part, mode="clip")
            z += part
            np.tanh(z, out=z)
            gates = z[:3 * h]
            gates *= 0.4999998      # never quite closed: cells that fade out would become slow denormal numbers
            gates += 0.5000002
            cell *= z[h:2 * h]
            cell += z[:h] * z[3 * h:]
            state = out[t, side * h:(side + 1) * h]
            np.tanh(cell, out=state)
            state *= z[2 * h:3 * h]
    return np.matmul(m.wo, out) + m.bo[:, None]


def may_hold(e: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Windows (of time x tags x windows) whose best path may hold a tag. A tagged stretch gains at most the best way to
    begin it, then at each step the best tag with the best transition into it, then the best way out; where no
    stretch gains anything, no tag at all is the best path."""
    gain = np.where(forbidden(), -np.inf, trans - trans[0, 0]).astype(np.float32)
    margin = e[:, 1:] - e[:, :1]
    begin = (margin + gain[0, 1:, None]).max(1)
    begin[0] = margin[0].max(0)          # a window may begin inside a span
    go_on = (margin + gain[1:, 1:].max(0)[:, None]).max(1)
    best, run = np.full(e.shape[2], -np.inf, np.float32), np.full(e.shape[2], -np.inf, np.float32)
    for first, more in zip(begin, go_on):
        run = np.maximum(first, run + more)
        best = np.maximum(best, run)
    return best + max(0.0, gain[1:, 0].max()) > -1e-3


def viterbi(e: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Best tags, time x windows."""
    a = np.where(forbidden(), -1e9, trans).astype(np.float32)
    score, back = e[0].astype(np.float32), []
    for row in e[1:]:
        step = score[:, :, None] + a
        back.append(step.argmax(1))
        score = step.max(1) + row
    tags = [score.argmax(1)]
    for b in reversed(back):
        tags.append(b[np.arange(len(b)), tags[-1]])
    return np.array(tags[::-1])


def posteriors(e: np.ndarray, trans: np.ndarray):
    """(posterior of each tag, expected transitions, log of the normaliser) for time x windows x tags, by
    forward-backward sums that are scaled to one at every step."""
    a = np.where(forbidden(), 0, np.exp(trans.astype(np.float64)))
    e = e.astype(np.float64)
    top = e.max(2, keepdims=True)
    b = np.exp(e - top)
    fwd, bwd, norm = np.empty_like(b), np.ones_like(b), np.empty(b.shape[:2])
    for t in range(len(b)):
        now = b[t] * (fwd[t - 1] @ a if t else 1)
        norm[t] = now.sum(1)
        fwd[t] = now / norm[t][:, None]
    for t in range(len(b) - 2, -1, -1):
        bwd[t] = (b[t + 1] * bwd[t + 1]) @ a.T / norm[t + 1][:, None]
    ahead = (b[1:] * bwd[1:] / norm[1:, :, None]).reshape(-1, TAGS)
    moves = fwd[:-1].reshape(-1, TAGS).T @ ahead * a
    return fwd * bwd, moves, np.log(norm).sum(0) + top[:, :, 0].sum(0)


# ---------------------------------------------------------------- training
def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def loss_and_gradient(m: Model, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean negative log-likelihood of the tags (time x windows) and its gradient, by back-propagation through time."""
    steps, n = x.shape
    h = m.wh.shape[1]
    sides = np.stack([x, x[::-1]])       # the second direction reads backwards
    fed = np.stack([m.wx[d][sides[d]] + m.b[d] for d in (0, 1)])
    zeros = lambda *shape: np.zeros(shape, m.wx.dtype)
    states, kept = zeros(2, steps, n, h), []
    state, cell = zeros(2, n, h), zeros(2, n, h)
    for t in range(steps):
        z = fed[:, t] + state @ m.wh
        s, g = _sigmoid(z[:, :, :3 * h]), np.tanh(z[:, :, 3 * h:])
        i, f, o = s[:, :, :h], s[:, :, h:2 * h], s[:, :, 2 * h:]
        new = f * cell + i * g
        tc = np.tanh(new)
        kept.append((s, g, cell, tc, state))
        cell, state = new, o * tc
        states[:, t] = state
    both = np.concatenate([states[0], states[1, ::-1]], 2)
    e = both @ m.wo + m.bo
    p, moves, z_total = posteriors(e, m.trans)
    at = np.arange(n)[None, :]
    gold = e[np.arange(steps)[:, None], at, y].sum(0) + m.trans[y[:-1], y[1:]].sum(0)
    de = p.copy()
    de[np.arange(steps)[:, None], at, y] -= 1
    de = (de / n).astype(m.wx.dtype)
    dtrans = moves.copy()
    np.subtract.at(dtrans, (y[:-1].ravel(), y[1:].ravel()), 1)
    dtrans = np.where(forbidden(), 0, dtrans) / n
    dwo = both.reshape(-1, 2 * h).T @ de.reshape(-1, TAGS)
    dboth = de @ m.wo.T
    dsides = np.stack([dboth[:, :, :h], dboth[::-1, :, h:]])
    back = m.wh.transpose(0, 2, 1)
    dstate, dcell, dz = zeros(2, n, h), zeros(2, n, h), zeros(2, steps, n, 4 * h)
    for t in range(steps - 1, -1, -1):
        s, g, cell, tc, _ = kept[t]
        i, f, o = s[:, :, :h], s[:, :, h:2 * h], s[:, :, 2 * h:]
        ds = dsides[:, t] + dstate
        dc = dcell + ds * o * (1 - tc * tc)
        now = dz[:, t]
        now[:, :, :h], now[:, :, h:2 * h], now[:, :, 2 * h:3 * h], now[:, :, 3 * h:] = dc * g, dc * cell, ds * tc, dc * i * (1 - g * g)
        now[:, :, :3 * h] *= s * (1 - s)
        dstate, dcell = now @ back, dc * f
    flat = dz.reshape(2, -1, 4 * h)
    before = np.stack([k[4] for k in kept], 1).reshape(2, -1, h)
    dwx = np.stack([np.eye(CLASSES, dtype=m.wx.dtype)[sides[d].ravel()].T @ flat[d] for d in (0, 1)])
    return float((z_total - gold).mean()), [dwx, before.transpose(0, 2, 1) @ flat, flat.sum(1), dwo, de.sum((0, 1)), dtrans]


def start(hidden: int, seed: int) -> Model:
    r = np.random.default_rng(seed)
    b = np.zeros((2, 4 * hidden))
    b[:, hidden:2 * hidden] = 1       # remember at first
    bo = np.zeros(TAGS)
    bo[0] = 2
    return Model(r.normal(0, 0.3, (2, CLASSES, 4 * hidden)), r.normal(0, 1 / np.sqrt(hidden), (2, hidden, 4 * hidden)), b,
                 r.normal(0, 0.3, (2 * hidden, TAGS)), bo, np.zeros((TAGS, TAGS)))


def _example(text: str, spans: list[tuple[int, int, int]], rng: random.Random, length: int) -> tuple[str, np.ndarray]:
    """A labelled window: spans kept or respelled, now and then a counter-example between two words."""
    parts, tags, at = [], [], 0

    def plain(piece):
        if " " in piece and rng.random() < 0.35:
            cut = rng.choice([i for i, c in enumerate(piece) if c == " "])
            piece = f"{piece[:cut]} {decoy(rng)}{piece[cut:]}"
        parts.append(piece)
        tags.append(np.zeros(len(piece), np.int64))

    for k, a, b in sorted(spans, key=lambda s: s[1]):
        if a < at:
            continue
        plain(text[at:a])
        value = text[a:b] if rng.random() < 0.4 else respell(k, text[a:b], rng)
        parts.append(value)
        tags.append(np.r_[1 + 2 * k, np.full(len(value) - 1, 2 + 2 * k)])
        at = b
    plain(text[at:])
    text, y = "".join(parts), np.concatenate(tags)
    room = len(text) - length
    cut = rng.randrange(room + 1) if room > 0 else 0
    return text[cut:cut + length], y[cut:cut + length]


def fit(windows: list[tuple[str, list[tuple[int, int, int]]]], hidden: int = 8, steps: int = 700, batch: int = 64, length: int = 64,
        rate: float = 0.025, seed: int = 1) -> Model | None:
    """``windows``: (text, spans), in a fixed order. The same windows and seed give the same model."""
    marked = [w for w in windows if w[1]]
    if not marked:
        return None
    by_kind = [[w for w in marked if any(s[0] == k for s in w[1])] for k in range(len(KINDS))]
    by_kind = [w for w in by_kind if w]
    bare = [w for w in windows if not w[1]] or [("", [])]
    rng, table, m = random.Random(seed), _letters(), Model(*[p.astype(np.float32) for p in start(hidden, seed).params()])
    first, second = [np.zeros_like(p) for p in m.params()], [np.zeros_like(p) for p in m.params()]
    for step in range(1, steps + 1):
        x, y = np.full((length, batch), PAD, np.uint8), np.zeros((length, batch), np.int64)
        for i in range(batch):
            # kinds take turns, so a rare one is learned as well as a common one
            text, spans = rng.choice(by_kind[i % len(by_kind)]) if rng.random() < 0.6 else rng.choice(bare)
            text, tags = _example(text, spans, rng, length)
            x[:len(text), i], y[:len(text), i] = encode(text, table), tags
        _, grad = loss_and_gradient(m, x, y)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad))
        now = rate * min(1.0, 5.0 / (norm + 1e-9)) if step > 20 else rate
        now *= 0.5 * (1 + np.cos(np.pi * step / (steps + 1)))
        for p, g, u, v in zip(m.params(), grad, first, second):
            u += 0.1 * (g - u)
            v += 0.005 * (g * g - v)
            p -= now * (u / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.995 ** step)) + 1e-8)
    return m


_WINDOWS = "key long, windows array<struct<text:string,spans:array<struct<kind:int,start:int,end:int>>>>"


def _cut(per_row: int, around: int):
    """Windows of a text about base spans and about other digits, a few of each; their places are fixed by the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text in b.column(1).to_pylist():
                spans, found = base_spans(text), []
                rng = random.Random(len(text))
                picks = rng.sample(spans, min(len(spans), per_row - 2))
                places = [(s[1], s[2]) for s in picks]
                at = rng.randrange(len(text) + 1)
                other = _DIGIT.search(text, at) or _DIGIT.search(text)
                places += [(at, at)] + ([(other.start(), other.end())] if other else [])
                for a, z in places:
                    a, z = max(0, a - around), min(len(text), z + around)
                    # a span that the window cuts moves its edge inwards, so no label is halved
                    for _, s, e in spans:
                        a, z = (e if s < a < e else a), (s if s < z < e else z)
                    inside = [{"kind": k, "start": s - a, "end": e - a} for k, s, e in spans if a <= s and e <= z]
                    if a < z:
                        found.append({"text": text[a:z], "spans": inside})
                out.append(found)
            kind = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.struct([("text", pa.string()), ("spans", pa.list_(kind))])))],
                                             names=["key", "windows"])
    return run


def labelled_windows(docs: DataFrame, max_rows: int = 4096, per_row: int = 6, around: int = 70) -> list:
    """(text, spans) of at most ``max_rows`` rows, ``per_row`` windows each. No more reaches the driver."""
    rows = docs.select(F.xxhash64("doc_id", "text").alias("key"), "text").where(F.col("text").rlike("[@+]|[0-9]{3}"))
    pick = rows.select("key").distinct().orderBy("key").limit(max_rows)
    rows = rows.join(F.broadcast(pick), "key").select("key", "text").mapInArrow(_cut(per_row, around), _WINDOWS)
    # rows that repeat a picked row are folded before they travel
    rows = rows.groupBy("key").agg(F.min("windows").alias("windows")).collect()
    return [(w.text, [(s.kind, s.start, s.end) for s in w.spans]) for r in sorted(rows, key=lambda r: r.key) for w in r.windows]


# ---------------------------------------------------------------- decoding
_CUE = re.compile(r"(?:@|(?<=[\s\[({<])at(?=[\s\])}>]))(?=\s{0,320}[\])}>]?\s{0,320}[a-z0-9-]{1,320}\s{0,320}(?:[\[({<]\s{0,320})?(?:dot|\.))", re.I)


def _windows(text: str, window: int, overlap: int) -> int:
    return max(1, -(-(len(text) - overlap) // (window - overlap)))


def live(text: str, window: int, overlap: int) -> list[int]:
    """Numbers of the windows from which a span that ``holds_up`` may come. Such a span has an "at" that a name and a dot
    follow, or four digits and at most 320 characters, of which one of the windows it lies in has an equal share. Others need
    no decoding: what is found there is dropped, unless it goes on into one of these (see ``Tagger.spans``)."""
    step = window - overlap
    last = _windows(text, window, overlap) - 1
    share = -(-4 // -(-(319 + window) // step))
    digits = [m.start() for m in _DIGIT.finditer(text)]
    out = set()
    for k in range(len(digits) - share + 1):
        out.update(range(max(0, (digits[k + share - 1] - window) // step + 1), min(last, digits[k] // step) + 1))
    for m in _CUE.finditer(text):
        out.update(range(max(0, (m.end() - 1 - window) // step + 1), min(last, m.start() // step) + 1))
    return sorted(out)


class Tagger:
    def __init__(self, model: Model, window: int = 256, overlap: int = 40, least: float = 0.6, block: int = 1024):
        self.m, self.window, self.overlap, self.least, self.block = model.half(), window, overlap, least, block
        self.table = _letters()

    def spans(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """(kind number, start, end) of the spans that the model adds to each text's base spans."""
        found: list[list] = [[] for _ in texts]
        step = self.window - self.overlap
        todo = [(d, n) for d, text in enumerate(texts) for n in live(text, self.window, self.overlap)]
        done, block = set(todo), self.block
        while todo:
            for i in range(0, len(todo), block):
                held = [(d, n * step, encode(texts[d][n * step:n * step + self.window], self.table)) for d, n in todo[i:i + block]]
                self._decode(held, found, texts, block)
            # a span that reaches into another window may be part of a longer one
            near = {(d, n) for d in {d for d, _ in todo} for _, a, b, *_ in found[d]
                    for n in range(max(0, (a - self.window) // step + 1), min(_windows(texts[d], self.window, self.overlap), (b - 1) // step + 1))}
            todo = sorted(near - done)
            done.update(todo)
            block = min(self.block, 64)
        return [reconcile(f, text, self.least) if f else [] for f, text in zip(found, texts)]

    def _decode(self, held, found, texts, block) -> None:
        x = np.full((self.window, block), PAD, np.uint8)      # always of this size: results do not depend on neighbours
        for i, (_, _, ids) in enumerate(held):
            x[:len(ids), i] = ids
        e = emissions(self.m, x)
        hit = np.flatnonzero(may_hold(e, self.m.trans)[:len(held)])
        if not len(hit):
            return
        e = np.ascontiguousarray(e[:, :, hit].transpose(0, 2, 1))
        tags = viterbi(e, self.m.trans)
        some = tags.any(0)
        if not some.any():
            return
        hit, tags = hit[some], tags[:, some]
        p, _, _ = posteriors(e[:, some], self.m.trans)
        for j, i in enumerate(hit):
            d, at, ids = held[i]
            for k, a, b in runs(tags[:len(ids), j]):
                sure = float((p[a:b, j, 1 + 2 * k] + p[a:b, j, 2 + 2 * k]).min())
                found[d].append((k, at + a, at + b, sure, a == 0 and at > 0, b == len(ids) and at + b < len(texts[d])))


def runs(tags: np.ndarray) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the tagged runs of one window."""
    kind = np.where(tags > 0, (tags - 1) // 2, -1)
    fresh = np.concatenate([[True], (kind[1:] != kind[:-1]) | ((tags[1:] > 0) & (tags[1:] % 2 == 1))])
    edges = np.append(np.flatnonzero(fresh), len(tags))
    return [(int(kind[a]), int(a), int(b)) for a, b in zip(edges[:-1], edges[1:]) if kind[a] >= 0]


def reconcile(found: list[tuple], text: str, least: float) -> list[tuple[int, int, int]]:
    """One set of disjoint spans for the whole text from the spans of all its windows, which are (kind, start, end,
    posterior, cut on the left, cut on the right)."""
    whole: list[list] = []
    for k, a, b, sure, left, right in sorted(found, key=lambda s: (s[0], s[1], s[2])):
        last = whole[-1] if whole else None
        if last and last[0] == k and a < last[2] and (left or last[5]):     # parts of one span
            if b >= last[2]:
                last[2], last[5] = b, right
            last[3] = max(last[3], sure)
        else:
            whole.append([k, a, b, sure, left, right])
    base = sorted((a, b) for _, a, b in base_spans(text))
    starts, reach = [a for a, _ in base], []
    for _, b in base:
        reach.append(max(b, reach[-1]) if reach else b)

    def free(a, b):
        i = bisect_right(starts, b - 1)
        return i == 0 or reach[i - 1] <= a

    kept = sorted({(a + len(v) - len(v.lstrip()), b - len(v) + len(v.rstrip()), k, sure) for k, a, b, sure, *_ in whole for v in [text[a:b]]
                   if sure >= least and v.strip() and holds_up(k, v.strip()) and free(a, b)}, key=lambda s: (s[1], s[0], s[2]))
    # weighted interval scheduling: best total weight of disjoint spans among the first i
    ends = [s[1] for s in kept]
    best, choice = [0.0], []
    for i, (a, b, k, sure) in enumerate(kept):
        before = bisect_right(ends, a, 0, i)
        take = best[before] + sure * (b - a)
        choice.append(before if take > best[-1] else None)
        best.append(max(best[-1], take))
    out, i = [], len(kept)
    while i:
        if choice[i - 1] is None:
            i -= 1
        else:
            a, b, k, _ = kept[i - 1]
            out.append((k, a, b))
            i = choice[i - 1]
    return out


_OUT = "doc_id long, spans array<struct<kind:string,start:long,end:long>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def _scan(model, options: dict, chars: int = 1 << 22):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model()
        tagger = None if m is None else Tagger(m, **options)
        names = KINDS + LIKE

        def done(ids, texts):
            added = tagger.spans(texts) if tagger else [[] for _ in texts]
            spans = [sorted(base_spans(t) + [(k + len(KINDS), a, b) for k, a, b in more]) for t, more in zip(texts, added)]
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([[{"kind": names[k], "start": a, "end": b} for k, a, b in s] for s in spans], pa.list_(_SPAN))],
                names=["doc_id", "spans"])

        ids, texts, size = [], [], 0
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                for d, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids.append(d)
                    texts.append(t or "")
                    size += len(texts[-1])
                    if size >= chars:
                        yield done(ids, texts)
                        ids, texts, size = [], [], 0
        if ids:
            yield done(ids, texts)
    return run


def learn(docs: DataFrame, max_rows: int = 4096, per_row: int = 6, **options) -> Model | None:
    """Model from the base spans of a bounded sample of ``docs``."""
    return fit(labelled_windows(docs, max_rows, per_row), **options)


def find(docs: DataFrame, model: Model | None, **options) -> DataFrame:
    """doc_id, spans (kind, start, end in code points; by kind, then start) of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scan(share(docs.sparkSession, model), options), _OUT)


def find_personal_data(docs: DataFrame) -> DataFrame:
    return find(docs, learn(docs))
