"""Windows that are passed over cannot hold a span that stays."""

import random

import numpy as np

from estatelake.llm import pii


class Everywhere(pii.Tagger):
    """Decodes every window."""

    def spans(self, texts):
        live, pii.live = pii.live, lambda text, *sizes: list(range(pii._windows(text, *sizes))) if text else []
        try:
            return super().spans(texts)
        finally:
            pii.live = live


def texts(seed, n=60):
    rng = random.Random(seed)
    words = ["look", "at", "the", "dot", "map.", "Meet", "[at]", "ten", "(", "a.b", "@", "house", "9", "1998"]
    secrets = ["ann at host dot org", "bob [at] example [dot] org", "10[.]0[.]0[.]1", "4111.1111.1111.1111", "(555) 123-4567", "x (AT) y-z . com"]
    out = ["", "1", "at", "7" * 900, "@" * 500]
    for _ in range(n):
        parts = [rng.choice(words) for _ in range(rng.randrange(1, 400))]
        for _ in range(rng.randrange(4)):
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(secrets))
        out.append(" ".join(parts))
    return out


def test_windows_passed_over_hold_nothing(monkeypatch):
    # a model without training that tags much; what does not hold up is dropped
    m = pii.start(8, 3)
    m.bo[0] = -1
    rng = np.random.default_rng(5)
    m.trans[:] = rng.normal(0, 0.5, m.trans.shape)
    some = texts(1)
    for window, overlap in ((256, 40), (64, 24), (64, 40)):
        options = {"window": window, "overlap": overlap, "least": 0.0, "block": 64}
        assert pii.Tagger(m, **options).spans(some) == Everywhere(m, **options).spans(some)


def test_a_trained_model_decodes_few_windows(monkeypatch):
    plain = "the house has a garden and a view of the sea , and nothing else . " * 40
    windows = [(f"write to u{i}@host{i}.org or 10.0.0.{i} now", pii.base_spans(f"write to u{i}@host{i}.org or 10.0.0.{i} now")) for i in range(40)]
    m = pii.fit([*windows, (plain[:140], [])], steps=150)
    docs = [plain, plain + " mail ann at host dot org " + plain, plain + "10[.]0[.]0[.]7 " + plain]
    seen, decode = [], pii.Tagger._decode
    monkeypatch.setattr(pii.Tagger, "_decode", lambda self, held, *rest: (seen.append(len(held)), decode(self, held, *rest))[1])
    got = pii.Tagger(m).spans(docs)
    few = sum(seen)
    assert got == Everywhere(m).spans(docs)
    assert 0 < few <= 12 < sum(seen) - few
    assert pii.Tagger(m).spans([plain]) == [[]]


def test_live_windows():
    assert pii.live("", 256, 40) == [] and pii.live("x" * 5000, 256, 40) == []
    text = "x" * 1000 + "12" + "x" * 1000
    assert pii.live(text, 256, 40) == [n for n in range(10) if n * 216 <= 1000 and 1002 <= n * 216 + 256]
    assert pii.live("mail ann at\thost . org", 256, 40) == [0] and pii.live("look at the map", 256, 40) == []
