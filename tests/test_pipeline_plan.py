"""Pipeline: of its joins only those with a row per source, class or partition may be broadcast."""

import corpus_pipeline
from estatelake.llm import common, decontam, mixing


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_join_of_the_pipeline_broadcasts_rows_of_documents_or_items(spark, monkeypatch):
    rows = [(i, " ".join(f"w{(i * 7 + j) % 90}" for j in range(30 + i)), "en", f"s{i % 3}", 0) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    items = spark.createDataFrame([(i, rows[i][1] + ". And so on.") for i in range(4)], "item_id long, text string")
    plans = {}

    def recorded(df, name):
        plans[name] = plan(df)
        return common.materialize(df, name)

    monkeypatch.setattr(decontam, "materialize", recorded)
    assert decontam.weighted_items(items).count() == 4
    assert plans["benchmark-impacts"].count("BroadcastExchange") == 1     # the longest item of each class
    for name, df in (("mix", mixing.mix(docs)), ("apply_mix", mixing.apply_mix(docs)), ("clean", decontam.clean(docs, items)),
                     ("language", corpus_pipeline.language(spark, docs, "")),
                     ("near_duplicates", corpus_pipeline.near_duplicates(spark, docs, "")),
                     ("again", corpus_pipeline.near_duplicates(spark, docs.unionAll(docs), ""))):
        plans[name] = plan(df)
        assert "Broadcast" not in plans[name] and "Join" in plans[name], name
