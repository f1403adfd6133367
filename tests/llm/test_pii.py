"""Personal data: base spans against the plain expressions, the tagger against finite differences and enumeration."""

import hashlib
import itertools
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest

from estatelake.llm import pii, queries

def words(rng, n):
    part = ["an", "ther", "in", "tion", "Le", "eau", "con", "ver", "ü", "ción", "st"]
    return " ".join("".join(rng.choice(part) for _ in range(rng.randrange(1, 4))) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
SCHEMA = "doc_id long, text string, spans string, key long, n_email long"


def plain(text):
    out = [(0, *m.span()) for m in re.finditer(EMAIL, text)]
    out += [(1, *m.span()) for m in re.finditer(IP, text) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(CARD, text):
        d = re.sub("[^0-9]", "", m.group())
        total = sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(int(c) for c in reversed(d)))
        if 13 <= len(d) <= 19 and total % 10 == 0:
            out.append((2, *m.span()))
    return out + [(3, *m.span()) for m in re.finditer(PHONE, text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


def card(rng):
    d = "4" + "".join(rng.choice("0123456789") for _ in range(14))
    return next(d + c for c in "0123456789" if pii.luhn(d + c))


def value(kind, rng):
    n = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    return [lambda: f"{rng.choice(['ann', 'bo', 'li.x', 'max'])}.{n(2)}@mail{n(1)}.example.com",
            lambda: ".".join(str(rng.randrange(256)) for _ in range(4)), lambda: card(rng),
            lambda: f"+1 ({n(3)}) 555-{n(4)}"][kind]()


def document(rng, make=lambda k, v: v):
    """(text, spans) with 0 to 3 values between words."""
    text, spans = words(rng, rng.randrange(5, 40)), []
    for _ in range(rng.randrange(4)):
        k = rng.randrange(4)
        v = make(k, value(k, rng))
        spans.append((k, len(text) + 1, len(text) + 1 + len(v)))
        text += f" {v} {words(rng, rng.randrange(5, 30))}"
    return text, spans


def test_base_spans_match_the_plain_expressions():
    rng = random.Random(1)
    for _ in range(6000):
        text = "".join(rng.choice(["a", "Z9", "@", ".", "-", "_", "+", "1", "25", "255", "256", " ", "(", ")", "4111 1111 1111 1111", "007", "x@y.z", "é", "\n",
                                   "+49 30 1234567", "10.0.0.1"]) for _ in range(rng.randrange(1, 25)))
        assert pii.base_spans(text) == plain(text), text


@pytest.mark.parametrize("unit", ["a", "a.", "1", "1.", "1 ", "@", "a@", "a@b", "+1 ", "+1(", "0", "1-", "a@b.c@"])
def test_base_spans_take_linear_time(unit):
    t0 = time.time()
    pii.base_spans(unit * (400_000 // len(unit)))
    assert time.time() - t0 < 5


def small_model(hidden=3):
    m = pii.start(hidden, 2)
    r = np.random.default_rng(3)
    m.trans[:] = r.normal(0, 0.5, m.trans.shape)
    return m, r


def test_gradient_matches_finite_differences():
    m, r = small_model()
    x, y = r.integers(0, pii.CLASSES, (6, 3)).astype(np.uint8), np.zeros((6, 3), int)
    y[1], y[2], y[4, 1] = 1, 2, 5
    loss, grad = pii.loss_and_gradient(m, x, y)
    for p, g in zip(m.params(), grad):
        for at in [np.unravel_index(np.abs(g).argmax(), p.shape)] + [tuple(r.integers(0, s) for s in p.shape) for _ in range(5)]:
            keep, both = p[at], []
            for step in (1e-5, -1e-5):
                p[at] = keep + step
                both.append(pii.loss_and_gradient(m, x, y)[0])
            p[at] = keep
            assert abs((both[0] - both[1]) / 2e-5 - g[at]) < 1e-6


def test_viterbi_and_posteriors_match_enumeration():
    _, r = small_model()
    m, _ = small_model()
    steps, bad = 4, pii.forbidden()
    e = r.normal(0, 2, (steps, 2, pii.TAGS))
    tags, (p, moves, z) = pii.viterbi(e, m.trans), pii.posteriors(e, m.trans)
    paths = [q for q in itertools.product(range(pii.TAGS), repeat=steps) if not any(bad[a, b] for a, b in zip(q, q[1:]))]
    total_moves = np.zeros_like(moves)
    for w in (0, 1):
        score = np.array([sum(e[t, w, k] for t, k in enumerate(q)) + sum(m.trans[a, b] for a, b in zip(q, q[1:])) for q in paths])
        assert tuple(tags[:, w]) == paths[score.argmax()]
        weight = np.exp(score - np.logaddexp.reduce(score))
        assert abs(z[w] - np.logaddexp.reduce(score)) < 1e-8
        for t in range(steps):
            for k in range(pii.TAGS):
                assert abs(p[t, w, k] - weight[[q[t] == k for q in paths]].sum()) < 1e-8
        for q, v in zip(paths, weight):
            for a, b in zip(q, q[1:]):
                total_moves[a, b] += v
    assert np.allclose(moves, total_moves)


def test_screen_never_loses_a_tag():
    m, r = small_model()
    e = r.normal(0, 1.5, (12, pii.TAGS, 4000)).astype(np.float32)
    e[:, 0] += r.uniform(0, 8, 4000)
    tagged = pii.viterbi(e.transpose(0, 2, 1), m.trans).any(0)
    may = pii.may_hold(e, m.trans)
    assert (may | ~tagged).all() and 0 < tagged.sum() and (~may).sum() > 200


def test_fast_emissions_equal_the_training_pass():
    m, r = small_model(5)
    x = r.integers(0, pii.CLASSES, (9, 4)).astype(np.uint8)
    sig = lambda v: 1 / (1 + np.exp(-v))
    want = np.zeros((9, 4, 10))
    for d, order in ((0, range(9)), (1, range(8, -1, -1))):
        s = c = np.zeros((4, 5))
        for t in order:
            z = m.wx[d][x[t]] + s @ m.wh[d] + m.b[d]
            c = sig(z[:, 5:10]) * c + sig(z[:, :5]) * np.tanh(z[:, 15:])
            s = sig(z[:, 10:15]) * np.tanh(c)
            want[t, :, 5 * d:5 * d + 5] = s
    assert np.allclose(pii.emissions(m.half(), x).transpose(0, 2, 1), want @ m.wo + m.bo, atol=1e-4)


@pytest.fixture(scope="module")
def model():
    rng = random.Random(2)
    texts = [document(rng)[0] for _ in range(400)]
    b = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["key", "text"])
    found = [w for r in next(pii._cut(6, 70)([b])).column(1).to_pylist() for w in r]
    return pii.fit([(w["text"], [(s["kind"], s["start"], s["end"]) for s in w["spans"]]) for w in found], steps=450)


def test_respelled_values_are_found_and_clean_text_is_left_alone(model):
    rng, tagger, hit, all_, extra = random.Random(77), pii.Tagger(model), 0, 0, 0
    docs = [document(rng, lambda k, v: pii.respell(k, v, rng)) for _ in range(250)]
    for (text, spans), got in zip(docs, tagger.spans([t for t, _ in docs])):
        known = set(got) | set(pii.base_spans(text))
        hit += sum(s in known for s in spans)
        all_ += len(spans)
        extra += sum(s not in spans for s in got)
    assert hit >= 0.85 * all_ and extra <= 0.05 * all_
    clean = [words(rng, 200) + f" {pii.decoy(rng)} " + words(rng, 50) for _ in range(200)]
    assert sum(map(len, tagger.spans(clean))) <= 2


def test_windows_do_not_change_the_spans(model):
    """A long text gives the same spans as its parts, wherever the windows' edges fall."""
    rng = random.Random(9)
    parts = [document(rng, lambda k, v: pii.respell(k, v, rng)) for _ in range(40)]
    text = "\n".join(t for t, _ in parts)
    few = [{(k, text[a:b]) for k, a, b in pii.Tagger(model, window=w, overlap=o).spans([text])[0]} for w, o in ((256, 40), (200, 60), (4096, 40))]
    assert all(len(a ^ few[2]) <= 0.1 * len(few[2]) for a in few[:2]) and len(few[2]) > 20


def test_reconcile_unites_and_chooses():
    text = "x" * 20 + "(415) 555-0100 and more of it" + "x" * 60
    part = [(3, 20, 28, 0.9, False, True), (3, 20, 34, 0.8, False, False)]
    assert pii.reconcile(part, text, 0.6) == [(3, 20, 34)] and pii.reconcile(part[:1], text, 0.6) == []
    text = text.replace("xx(415)", " 1(415)")
    whole = [(3, 19, 28, 0.9, False, True), (3, 22, 34, 0.8, True, False), (0, 30, 40, 0.99, False, False), (3, 19, 34, 0.1, False, False)]
    assert pii.reconcile(whole, text, 0.6) == [(3, 19, 34)]
    assert pii.reconcile([(1, 0, 7, 0.9, False, False)], "10.0.0.1 x", 0.5) == []          # meets a base span


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1, 2) for d, t in rows], SCHEMA)


def test_find_in_spark(spark, model):
    rng = random.Random(4)
    rows = [(i, document(rng)[0]) for i in range(60)] + [(None, "call +1 (415) 555-0100"), (None, None), (105, ""), (105, ""),
                                                        (107, "é" * 5 + " a@b.co"), (108, ("word " * 40000) + "10.0.0.1"),
                                                        (109, "a" * 200000)]
    got = pii.find(frame(spark, rows).repartition(3), model).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        base = [(pii.KINDS.index(s.kind), s.start, s.end) for s in r.spans if s.kind in pii.KINDS]
        by.setdefault(r.doc_id, []).append(base)
    for d, t in rows:
        assert sorted(plain(t or "")) in by[d]
    digest = queries.span_digest(pii.find(frame(spark, rows), None), list(pii.KINDS))
    r = digest.where("doc_id = 107").first()
    assert (r.n_email, r.spans, r.base_sha256) == (1, "email:6:12", hashlib.sha256(b"email:6:12").hexdigest())
    assert pii.find(frame(spark, []), model).count() == 0


def test_sample_is_bounded_and_folds_repeats(spark):
    rng = random.Random(6)
    same = "write to ann.10@mail1.example.com today"
    rows = [(1, same)] * 200 + [(i, document(rng)[0]) for i in range(100, 160)]
    got = pii.labelled_windows(frame(spark, rows), max_rows=30, per_row=6)
    assert got == pii.labelled_windows(frame(spark, rows).repartition(7), max_rows=30, per_row=6) and 0 < len(got) <= 180
    assert sum(t == same for t, _ in got) <= 3
    assert all(pii.base_spans(t)[:0] == [] and all(0 <= a < b <= len(t) for _, a, b in s) for t, s in got)
    assert pii.learn(frame(spark, [(1, "no such thing"), (2, None)])) is None
