"""Rows that repeat an id or have none: each is judged by its own text."""

import random
from collections import Counter

import numpy as np
from pyspark.sql.classic.dataframe import DataFrame

import corpus_pipeline
from estatelake.llm import decontam, jaccard_join, langid, mixing
from fixtures import frame, words
from test_text_operators import brute_components, shingles


def shared_ids(seed=11):
    """A third without an id, an id of many texts, near copies across all of them."""
    rng = random.Random(seed)
    base = [words(rng, 80, 3000).split() for _ in range(4)]
    rows = []
    for i in range(60):
        w = list(base[i % 4])
        if i % 5:
            w[rng.randrange(80)] = f"edit{i}"
        text = " ".join(w) if i % 3 else words(rng, 40, 3000)
        rows.append((None if i % 3 == 1 else 7 if i % 4 == 0 else 100 + i, text, "en", "s"))
    rows += [(None, "", "en", "s"), (None, None, "en", "s"), (8, "", "en", "s"), (None, "lone text", "en", "s")]
    rng.shuffle(rows)
    return rows


def by_row(rows):
    """(rows in id order with NULL last, their components by place)."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    return order, brute_components([(k, t) for k, (_, t, *_) in enumerate(order)])


def test_components_of_every_row(spark):
    rows = shared_ids()
    order, comp = by_row(rows)
    want = Counter((order[k][0], n, order[c][0]) for k, (n, c) in comp.items())
    got = jaccard_join.row_components(frame(spark, rows).repartition(5), block=300)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert Counter(map(tuple, got.collect())) == want


def test_near_duplicates_keeps_one_row_of_a_component(spark):
    rows = shared_ids()
    order, comp = by_row(rows)
    got = corpus_pipeline.near_duplicates(spark, frame(spark, rows).repartition(5), "").collect()
    place = {t: c for k, (_, c) in comp.items() for t in [order[k][1]] if shingles(t)}
    # one row of each component with words, every row without
    assert Counter(place.get(r.text, "void") for r in got) == Counter({**{c: 1 for c in place.values()}, "void": 3})
    first = {c: order[c][0] for c in place.values()}
    assert all(r.doc_id == first[place[r.text]] for r in got if r.text in place)


def test_language_judges_every_row(spark):
    rows = [(i, f"the cat {i} sat on the mat", "en", "s") for i in range(20)]
    rows += [(5, "12 -- !", "en", "s"), (None, "--", "en", "s"), (None, "the cat", "en", "s")]
    got = Counter(r.text for r in corpus_pipeline.language(spark, frame(spark, rows), "").collect())
    assert got == Counter(t for _, t, *_ in rows if "the" in t)


def test_clean_drops_the_leaking_rows_only(spark):
    rng = random.Random(4)
    item = words(rng, 30, 900) + ". " + words(rng, 6, 900) + "."
    leak, fine = words(rng, 50, 900) + " " + item, words(rng, 90, 900)
    bench = spark.createDataFrame([(1, item), (2, words(rng, 30, 900))], "item_id long, text string")
    rows = [(None, leak, "en", "s"), (None, fine, "en", "s"), (3, leak, "en", "s"), (3, fine, "en", "s"), (4, fine, "en", "s")]
    got = Counter((r.doc_id, r.text) for r in decontam.clean(frame(spark, rows), bench).collect())
    assert got == Counter([(None, fine), (3, fine), (4, fine)])


def test_mix_takes_every_row_as_often_as_it_was_drawn(spark):
    """Sources of one hot id each, with equal and with different texts: their words equal the sum of the draws."""
    rng = random.Random(6)
    rows = [(5, words(rng, 9), "en", "c") for _ in range(300)]               # one id and size, 300 texts
    rows += [(None, words(rng, 9), "en", "c") for _ in range(200)] + [(6, "one two three", "en", "c")] * 100
    rows += [(100 + i, words(rng, 4), "en", "a" if i % 4 else "b") for i in range(120)]
    df = frame(spark, rows).repartition(4)
    want, goal = Counter(), {}
    for r in mixing.mix(df).collect():
        want[r.source] += r.taken
        goal[r.source] = r.target
    got, times = Counter(), Counter()
    for r in mixing.apply_mix(df).collect():
        got[r.source] += len(r.text.split())
        times[r.doc_id, r.text] += 1
    assert got == want and all(abs(got[s] - goal[s]) <= 9 for s in goal)
    assert 100 < times[6, "one two three"] < 200
    have = Counter((d, t) for d, t, *_ in rows)
    assert all(n <= 2 * have[k] for k, n in times.items())


def test_language_sample_reaches_the_driver_folded(spark, monkeypatch):
    """Rows that repeat a picked id count once towards max_rows, with the vector that sorts first."""
    rows = [(1, f"the cat {'abcdefgh'[i % 8]} sat", "en", "s") for i in range(200)] + [(2, "der hund liegt", "de", "s")]
    sent, plain = [], DataFrame.toPandas

    def counted(df):
        sent.append(plain(df))
        return sent[-1]

    monkeypatch.setattr(DataFrame, "toPandas", counted)
    model = langid.train(frame(spark, rows).repartition(4), max_rows=2)
    assert [len(p) for p in sent] == [2] and model.names == ["de", "en"]
    vectors = []
    for _, t, g, _ in rows:
        v = np.zeros(1 << langid.BITS, np.uint8)
        langid.presence(t, v, langid._letter_table())
        vectors.append((g, np.packbits(v).tobytes()))
    assert {np.packbits(m).tobytes() for m in model.landmarks} == {min(v for h, v in vectors if h == g) for g in ("en", "de")}
