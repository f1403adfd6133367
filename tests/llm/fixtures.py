"""Small document tables with the awkward cases every operator has to take."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, salt long, sig binary, _id long"


def words(rng, n, vocab=400):
    return " ".join(f"w{rng.randrange(vocab)}" for _ in range(n))


def corpus(seed=7):
    """(doc_id, text, lang, source): copies, near copies, shared passages, NULLs, empties, one long text."""
    rng = random.Random(seed)
    rows, base = [], words(rng, 120)
    passage = words(rng, 60)
    for i in range(60):
        rows.append((i, words(rng, rng.choice([3, 4, 5, 12, 13, 14, 40, 90])), rng.choice(["en", "de"]), f"s{i % 4}"))
    for i in range(60, 75):
        rows.append((i, base, "en", "s0"))                                  # exact copies
    for i in range(75, 90):
        w = base.split()
        w[rng.randrange(len(w))] = f"edit{i}"
        rows.append((i, " ".join(w), "en", "s0"))                           # near copies
    for i in range(90, 100):
        rows.append((i, f"{words(rng, 20)} {passage} {words(rng, 20)}", "de", "s1"))
    rows += [(100, None, None, None), (101, "", "en", "s2"), (102, " \t\n", "en", None), (103, "one", "en", "s2"),
             (104, "One\tone  one", "en", "s2"), (105, words(rng, 6000), "en", "s3"), (106, "same same " * 300, "en", "s3"),
             (107, "12 34 -- 56", "en", "s3"), (103, "one", "en", "s2")]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    """With extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(d, t, g, s, len(t or ""), 1, b"x", 2) for d, t, g, s in rows], SCHEMA)
