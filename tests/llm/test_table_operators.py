"""Mixing, sharding, URL filters, chat formatting, oracles and the pipeline."""

import json
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as E
import corpus_pipeline
from estatelake.llm import chat, mixing, queries, sharding, url_filter
from estatelake.llm.oracles import ORACLES
from fixtures import corpus, frame
from test_text_operators import brute_components, shingles, split
from tools.oracle_check import canon


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    SF01 = "/root/testdata/sf0.01"
    sdf = queries.QUERIES[name](spark, SF01)
    rows = [tuple(r) for r in sdf.collect()]
    cur = duck.execute(ORACLES[name])
    cols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(cols)
    assert canon(sdf.columns, rows) == canon(cols, cur.fetchall())


def test_registered():
    assert {q.split("_")[0] for q in E.queries() if q.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in E.queries()


# -------------------------------------------------------------------------- mixing
def brute_targets(sizes, share=1.5, cap=2.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(order)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        got = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = [s for s in rest if got[s] > cap * sizes[s]]
        if not over:
            return fixed | got
        fixed |= {s: cap * sizes[s] for s in over}


def test_mix(spark):
    rows = corpus()
    df = frame(spark, rows)
    got = mixing.mix(df.repartition(3)).collect()
    size = Counter()
    for d, t, _, s in rows:
        size[s] += len(split(t))
    want, taken, biggest = brute_targets(size), Counter(), Counter()
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == size[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-9)
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
        biggest[r.source] = max(biggest[r.source], r.size)
    assert all(abs(taken[s] - want[s]) <= biggest[s] + 1e-6 for s in size)
    again = mixing.mix(df.repartition(7)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    mixed = mixing.apply_mix(df)
    assert mixed.columns == df.columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({k: v for k, v in Counter(
        {(r.doc_id): 0 for r in got}).items()} | _copies(got)) - Counter()


def _copies(got):
    c = Counter()
    for r in got:
        c[r.doc_id] += r.copies
    return c


def test_pivotal_keeps_sums_and_expectations(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "0L AS nth", "1 + id % 7 AS size", "id % 2 AS sid",
                                        "0.25D + (id % 2) * 0.5D AS p").cache()
    total = {r.sid: r.s for r in docs.groupBy("sid").agg({"size": "sum"}).withColumnRenamed("sum(size)", "s").collect()}
    for seed in (1, 2):
        got = docs.join(mixing.pivotal(docs, seed, leaf_rows=100, fan_in=4), ["doc_id", "nth"]).collect()
        assert len(got) == 3000 and {r.extra for r in got} == {0, 1}
        for sid, p in ((0, 0.25), (1, 0.75)):
            assert abs(sum(r.size * r.extra for r in got if r.sid == sid) - p * total[sid]) <= 7


def test_mix_edges(spark):
    assert mixing.mix(frame(spark, [])).count() == 0
    rows = [(1, None, None, None), (2, "", "en", "a")]
    assert {(r.size, r.taken, r.target) for r in mixing.mix(frame(spark, rows)).collect()} == {(0, 0, 0.0)}
    assert mixing.apply_mix(frame(spark, rows)).count() == 0


# ------------------------------------------------------------------------ sharding
def py_feistel(x, n, key):
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    b = max(1, -(-n // a))
    left, right = divmod(x, b)
    for r in range(sharding.ROUNDS):
        k1 = (key * 2654435761 + r * 40503 + 12345) % sharding.PRIME or 1
        k2 = (key * 97 + r * 7919 + 1013904223) % sharding.PRIME
        v = (right if r % 2 == 0 else left) % sharding.PRIME
        y = (v * k1 + k2) % sharding.PRIME
        z = (y * y + v) % sharding.PRIME
        f = (z * z + r + 1) % sharding.PRIME
        if r % 2 == 0:
            left = (left + f) % a
        else:
            right = (right + f) % b
    return left * b + right


@pytest.mark.parametrize("n", [1, 2, 10, 97, 1000])
def test_permutation(spark, n):
    got = sharding.permute(spark.range(n).withColumnRenamed("id", "row_number"), n, 5).collect()
    assert sorted(r.position for r in got) == list(range(n))
    for r in got:
        x = py_feistel(r.row_number, n, 5)
        while x >= n:
            x = py_feistel(x, n, 5)
        assert r.position == x
    if n == 1000:   # neighbours do not stay neighbours
        at = {r.row_number: r.position for r in got}
        assert sum(abs(at[i + 1] - at[i]) <= 2 for i in range(n - 1)) < 20


def test_shard(spark):
    rows = corpus() + [(None, "x", "en", "s")]
    got = sharding.shard(frame(spark, rows).repartition(6)).collect()
    want = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    by = defaultdict(list)
    for r in got:
        assert r.law == "rows" and r.grown_shard is None
        by[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert set(by) == set(range(24)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    again = sharding.shard(frame(spark, rows).repartition(2)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    assert sharding.shard(frame(spark, [])).count() == 0


# ----------------------------------------------------------------------------- URLs
PAGES = [
    (1, "https://A.Example.org/es/1?x", ""), (2, "http://a.example.org/en/12", ""), (3, "http://example.org/en/2#y", ""),
    (4, "https://b.com/fr/1", '<a href="https://c.com/q">'), (5, "https://d.com/de/1", "<A HREF='//c.com/'>"),
    (6, "https://c.com/en/1", "<a href=/local> <a href=http://b.com>"), (7, None, None), (8, "no scheme", None),
    (9, "http://e.net", '<a href="http://d.com/de/">'), (10, "http://f.net/x", "<a href='/y'>"), (10, "http://f.net/x", None),
    (None, "https://sub.d.com/en/", ""), (12, "http://org", ""), (13, "://x.org/a://b", ""), (14, "http://g.com/de", ""),
]


def brute_verdicts(pages, iterations=12, damping=0.85):
    def host(u):
        return re.split("[/?#]", u.split("://", 1)[1])[0].lower() if u and "://" in u else ""

    def path(u):
        if not u or "://" not in u:
            return ""
        return re.sub(r"^[^/?#]*", "", u.split("://", 1)[1]).split("?")[0].split("#")[0]

    def rule(h, p):
        fits = [(len(rh + rp), rh + rp, a) for a, rh, rp in url_filter.RULES
                if (h == rh or h.endswith("." + rh)) and p.startswith(rp)]
        return max(fits)[1:] if fits else (None, None)

    edges, seeds = Counter(), {"trust": Counter(), "distrust": Counter()}
    for _, u, html in pages:
        h = host(u)
        a = rule(h, path(u))[1]
        if a and h:
            seeds["trust" if a == "allow" else "distrust"][h] += 1
        for x in re.findall(r"""(?i)href[ \t\r\n]*=[ \t\r\n]*["']?([^"' \t\r\n>]+)""", html or ""):
            g = host("x:" + x if x.startswith("//") else x)
            if h and g and g != h:
                edges[h, g] += 1
    for h in {host(u) for _, u, _ in pages} - {""}:
        m = re.match(r"^[^.]+\.(.+\..+)$", h)
        if m:
            edges[h, m[1]] += 1
            edges[m[1], h] += 1
    rank = {}
    for kind, c in seeds.items():
        e = edges if kind == "trust" else Counter({(b, a): n for (a, b), n in edges.items()})
        s = {h: n / sum(c.values()) for h, n in c.items()}
        out = Counter()
        for (a, _), n in e.items():
            out[a] += n
        names, r = {x for p in e for x in p} | set(s), dict(s)
        for _ in range(iterations):
            got = Counter()
            for (a, b), n in e.items():
                got[b] += r.get(a, 0) * n / out[a]
            for h in names:
                if not out[h]:
                    got[h] += r.get(h, 0)
            r = {h: (1 - damping) * s.get(h, 0) + damping * got[h] for h in names}
        rank[kind] = r
    res = Counter()
    for i, u, _ in pages:
        h, p = host(u), path(u)
        name, a = rule(h, p)
        t, d = (rank[k].get(h, 0) for k in ("trust", "distrust"))
        res[i, h, p, name, a or ("block" if d > 0 and d >= t * (1 - 1e-9) else "allow")] += 1
    return res


def test_urls(spark):
    df = spark.createDataFrame([(i, u, h, "x") for i, u, h in PAGES], "page_id long, url string, html string, host string")
    got = url_filter.filter_urls(df).select("page_id", "host", "path", "rule", "verdict").collect()
    assert Counter(map(tuple, got)) == brute_verdicts(PAGES)
    by = {r.page_id: r for r in got}
    assert (by[1].rule, by[1].verdict) == ("example.org/es/", "block") and by[2].rule == "example.org/en/1"
    assert by[3].rule == "org/" and by[12].rule is None and by[9].verdict == "block"
    assert url_filter.filter_urls(df.limit(0)).count() == 0


# ----------------------------------------------------------------------------- chat
def test_tool_calls(spark):
    calls = spark.createDataFrame([
        (1, "a", 0, "add", {"x": "1", "y": "2"}), (1, "b", 2, "add", {"x": "$result:a", "y": "7"}),
        (1, "c", 4, "add", {"y": "3", "x": "4", "z": 'q"\n'}), (1, "d", 6, "note", {"t": "$result:c", "u": "$result:b", "on": "true"}),
        (2, "a", 0, "add", {"x": "$result:b"}), (2, "b", 1, "note", {"t": "$result:a"}), (2, "e", 3, "none", {"k": None}),
        (2, "f", 4, "note", {"t": "$result:gone"}), (2, "e", 9, "add", {}), (None, "x", 0, "add", {}), (3, None, 0, "add", {}),
    ], "conv_id long, call_id string, turn long, name string, args map<string,string>")
    results = spark.createDataFrame([(1, "a", 3, "later"), (1, "a", 1, "3"), (1, "b", 3, None), (2, "zz", 7, "lost"), (2, "e", 5, "é")],
                                    "conv_id long, call_id string, turn long, content string")
    schemas = spark.createDataFrame([("add", ["x", "y"], {"x": "integer", "y": "integer"}),
                                     ("note", ["t"], {"t": "string", "u": "string", "on": "boolean"})],
                                    "name string, required array<string>, types map<string,string>")
    rows = chat.link_calls(calls, results, schemas).collect()
    apart = ("no_id", "repeated", "repeated_result")
    assert Counter((r.conv_id, r.call_id, r.status) for r in rows if r.status in apart) == Counter([
        (None, "x", "no_id"), (3, None, "no_id"), (2, "e", "repeated"), (1, "a", "repeated_result")])
    got = {(r.conv_id, r.call_id): r for r in rows if r.status not in apart}
    assert len(got) == len(rows) - 4 and set(got) == {(1, "a"), (1, "b"), (1, "c"), (1, "d"), (2, "a"), (2, "b"), (2, "e"), (2, "f"), (2, "zz")}
    assert [got[1, c].level for c in "abcd"] == [0, 1, 0, 2]
    assert got[2, "a"].level is None and got[2, "b"].level is None
    assert got[1, "a"].valid and got[1, "a"].json == '{"arguments":{"x":1,"y":2},"id":"a","name":"add","result":"3"}'
    assert got[1, "b"].errors == "type x" and got[1, "b"].status == "linked" and json.loads(got[1, "b"].json)["result"] == ""
    assert got[1, "c"].errors == "unknown z" and got[1, "c"].status == "unanswered"
    assert json.loads(got[1, "c"].json) == {"arguments": {"x": 4, "y": 3, "z": 'q"\n'}, "id": "c", "name": "add", "result": None}
    assert json.loads(got[1, "d"].json)["arguments"] == {"on": True, "t": "$result:c", "u": "$result:b"}
    assert got[2, "a"].errors == "missing y,type x" and got[2, "e"].errors == "unknown tool"
    assert got[2, "f"].errors == "uncited result" and got[2, "f"].level == 0
    assert got[2, "zz"].status == "orphan" and got[2, "e"].turn == 3
    assert chat.link_calls(calls.limit(0), results.limit(0), schemas).count() == 0


CHAT_SCHEMA = "conv_id long, turn long, role string, text string, name string"
CHAT = [(1, 0, "user", None), (1, 1, "assistant", None), (None, 0, "user", "x"), (2, None, "user", "x"), (2, 3, None, "x"), (2, 5, "assistant", "no call"),
        (1, 0, "user", None), (1, 1, "assistant", "other"), (1, 1, "assistant", "other"), (None, 4, "assistant", "y"), (None, 4, "assistant", "y"),
        (3, 2, "tool", "z"), (3, 0, "system", "be brief " * 3000), (3, 2, "user", 'q"\\ \u00e9'), (None, None, None, None), (4, 1, "user", "late")]


def test_chat_loses_no_row(spark):
    df = spark.createDataFrame([(*r, "n") for r in CHAT], CHAT_SCHEMA).repartition(3)
    got = chat.format_chat(df).collect()
    assert Counter((r.conv_id, r.call_id, r.status) for r in got) == Counter({
        (1, "1-0", "linked"): 1, (1, "1-0", "repeated"): 1, (1, "1-0", "repeated_result"): 2, (None, None, "no_id"): 1, (2, None, "no_id"): 1,
        (2, None, "other"): 1, (2, "2-4", "orphan"): 1, (None, None, "orphan"): 2, (3, None, "other"): 1, (3, "3-0", "unanswered"): 1,
        (3, "3-2", "unanswered"): 1, (None, None, "other"): 1, (4, "4-1", "unanswered"): 1})
    assert len(got) + sum(r.status == "linked" for r in got) == len(CHAT)          # a linked row stands for two turns
    assert all((r.errors == "") == r.valid for r in got)
    assert chat.format_chat(df.limit(0)).count() == 0


def test_chat_sql(spark):
    import duckdb
    from estatelake.llm.oracles import OP3
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", CHAT)
    cur = con.execute(OP3)
    df = chat.format_chat(spark.createDataFrame([(*r, "n") for r in CHAT], CHAT_SCHEMA))
    assert Counter(tuple(r) for r in df.select(*[c[0] for c in cur.description]).collect()) == Counter(cur.fetchall())


def test_chat_long_chain_and_cycle(spark):
    """Call i cites call i - 1; two calls cite each other, a third waits behind them."""
    args = lambda *ids: {f"a{n}": f"$result:{i}" for n, i in enumerate(ids)}
    rows = [(1, f"c{i}", i, "t", args(f"c{i - 1}") if i else {}) for i in range(12)]
    rows += [(1, "x", 50, "t", args("y")), (1, "y", 51, "t", args("x")), (1, "z", 52, "t", args("x", "c0"))]
    calls = spark.createDataFrame(rows, "conv_id long, call_id string, turn long, name string, args map<string,string>")
    got = {r.call_id: r.level for r in chat.levels(calls).collect()}
    assert got == {**{f"c{i}": i for i in range(12)}, "x": None, "y": None, "z": None}


# ------------------------------------------------------------------------- pipeline
def test_pipeline(spark, tmp_path):
    """Stage by stage against brute force; run() equals the stages one after another."""
    rows = corpus()
    bench = [(1, next(t for d, t, *_ in rows if d == 90)[70:260])]
    docs = spark.createDataFrame([(d, t, g, s, len(t or "")) for d, t, g, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["language", "near_duplicates", "decontaminate", "mix", "shard"]

    def step(name, df):
        out = stage[name](spark, df, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    a = step("language", docs)
    assert Counter(r.doc_id for r in a.collect()) == Counter(d for d, t, *_ in rows if re.search("[a-z]", t or ""))
    b = step("near_duplicates", a)
    have = [(r.doc_id, r.text) for r in a.collect()]
    comp = brute_components(have)
    assert Counter(r.doc_id for r in b.collect()) == Counter(d for d, _ in have if comp[d][1] == d)
    c = step("decontaminate", b)
    item = shingles(bench[0][1], 3)
    leak = {r.doc_id for r in b.collect() if len(shingles(r.text, 3) & item) > len(item) / 2}
    assert leak and {r.doc_id for r in c.collect()} == {r.doc_id for r in b.collect()} - leak
    d = step("mix", c)
    assert all(x.columns == docs.columns for x in (a, b, c, d))
    times = Counter(r.doc_id for r in d.collect())
    assert set(times) <= {r.doc_id for r in c.collect()} and max(times.values()) <= 4
    e = step("shard", d)
    assert Counter(r.doc_id for r in e.collect()) == times
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert Counter(map(tuple, whole.collect())) == Counter(map(tuple, e.select(*whole.columns).collect()))
