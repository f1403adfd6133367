"""Prefix trie against a trie that is walked node by node."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from estatelake.llm import prefix_trie
from estatelake.llm.oracles import OP11

SCHEMA = "conv_id long, turn long, role string, text string, d long, owner string, slice long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]


def brute(rows):
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append((turn is not None, turn or 0, digest(role or "", text or ""), (role or "", text or "")))
    own = {c: [t[-1] for t in sorted(v)] for c, v in by.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - c % 20, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, t in built.items():
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
    out = Counter()
    for node, cs in members.items():
        below = [u for u in members if u[:len(node)] == node]
        children = [u for u in below if len(u) == len(node) + 1]
        leaves = [u for u in below if not any(len(v) == len(u) + 1 and v[:len(u)] == u for v in below)]
        saved = sum((len(members[u]) - 1) * len(re.findall("[^\x20\x09-\x0d]+", u[-1][1])) for u in below if u)
        ends = ",".join(str(c) for c in sorted(cs) if len(built[c]) == len(node))
        out[min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), len(children), len(leaves), saved,
            hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


def conversations(seed, n=70, longest=6):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(120), n):
        for t in range(rng.randrange(1, longest)):
            rows.append((c, rng.choice([t, t, t, t, None, 0]), rng.choice(["user", "user", None, ""]),
                         rng.choice(["a", "a", "a b", "a\tb  c", "", None])))
    rows += [(None, 1, "user", "lost")] * 5 + [(40, 9, "user", "same same")] * 4
    rows += [(7, i, "user", f"word {i % 3}") for i in range(60)]
    rows += [(8, i, "user", f"word {i % 3}") for i in range(60)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,cells,slice_", [(1, 1 << 27, 1 << 16), (2, 64, 4), (3, 256, 1)])
def test_trie(spark, seed, cells, slice_):
    rows = conversations(seed)
    got = prefix_trie.conversation_trie(frame(spark, rows).repartition(5), max_cells=cells, slice_=slice_)
    assert Counter(tuple(r) for r in got.collect()) == brute(rows)


def test_trie_of_copies(spark):
    """Every conversation the same but one; absent family heads; conversations that end up without turns."""
    rows = [(c, t, "user", f"turn {t}") for c in range(60, 90) for t in range(3)] + [(500 + c, 0, "user", "only") for c in range(1, 12)]
    got = prefix_trie.conversation_trie(frame(spark, rows))
    assert Counter(tuple(r) for r in got.collect()) == brute(rows)


def test_trie_null_and_empty(spark):
    assert prefix_trie.conversation_trie(frame(spark, [])).count() == 0
    assert prefix_trie.conversation_trie(frame(spark, [(None, 0, "user", "x")])).count() == 0
    rows = [(-3, None, None, None), (-3, 1, "user", "x " * 20000), (0, 0, "user", "x " * 20000)]
    got = prefix_trie.conversation_trie(frame(spark, rows))
    signed = lambda c: -(-c % 20) if c < 0 else c % 20
    assert signed(-3) == -3 and got.where("depth = 0").first().n_convs == 2


def test_carries_join_partitions(spark):
    """One conversation over many range partitions has the sums of the same turns in one."""
    rows = [(5, i, "user", f"t{i}") for i in range(300)] + [(4, 0, "user", "t0"), (6, 0, "user", "t0")]
    keep = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        got = []
        for n in ("2", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got.append(Counter(tuple(r) for r in prefix_trie.prefix_sums(frame(spark, rows)).collect()))
        assert got[0] == got[1] and len(got[0]) == 302
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", keep)


def test_estimates_prove_singletons(spark):
    """No prefix of two conversations is ever marked as single, and a wide sketch marks nearly all the others."""
    rows, _ = prefix_trie.prefixes(frame(spark, conversations(4)))
    true = Counter((r.d, r.p1, r.p2) for r in rows.collect())
    for bits in (6, 14):
        marked = rows.mapInArrow(prefix_trie._classify(prefix_trie.share(spark, prefix_trie.sketch(rows, bits)), bits),
                                 prefix_trie._ROW + ", single boolean, tail boolean").collect()
        assert all(true[r.d, r.p1, r.p2] == 1 for r in marked if r.single)
        assert all(r.single for r in marked if r.tail)
    assert sum(r.single for r in marked) >= 0.95 * sum(n == 1 for k, n in true.items() if k[0] > 0)


def test_trie_sql(spark):
    import duckdb
    rows = conversations(5)
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    cur = con.execute(OP11)
    assert [c[0] for c in cur.description] == prefix_trie.conversation_trie(frame(spark, [])).columns
    assert Counter(cur.fetchall()) == brute(rows)
