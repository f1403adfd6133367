"""op8: joins of two sides that grow with the input are exchanged; nothing of them reaches the driver."""

from estatelake.llm import common, jaccard_join


def test_no_side_of_a_join_is_broadcast(spark, monkeypatch):
    # near copies whose prefixes meet in shingles of several components, so that the second step has pairs of its own
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[:50 - i % 3] + [f"x{i}"] * (i % 4))) for i in range(12)]
    rows += [(100 + i, " ".join([f"y{i}_{j}" for j in range(40)] + words[:12])) for i in range(12)]
    rows += [(200 + i, " ".join(f"z{j}" for j in range(30))) for i in range(3)] + [(300, None), (None, "a b c d e f")]
    plans = []

    def recorded(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return common.materialize(df, name)

    monkeypatch.setattr(jaccard_join, "materialize", recorded)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = jaccard_join.row_components(docs)
    plans.append(("result", out._jdf.queryExecution().executedPlan().toString()))
    got = {r["doc_id"]: r["component_id"] for r in out.collect()}
    assert len(got) == len(rows) and {got[200 + i] for i in range(3)} == {200} and got[None] is None
    assert {"pivot-pairs", "labels", "labelled", "mixed-postings", "cross-links", "named-classes", "result"} <= {n for n, _ in plans}
    assert [n for n, p in plans if "Broadcast" in p] == []
