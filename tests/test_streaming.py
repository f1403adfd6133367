"""Streaming ingest: restart on the same checkpoint is exactly-once, and a
new drop is upserted incrementally."""

from pyspark.sql import functions as F

from conftest import SF001
from estatelake import vocab
from estatelake.session import shared_path
from estatelake.sources import tpch
from estatelake.sources.buckets import CommittedLake
from estatelake.streaming import ingest


def test_restart_is_exactly_once_and_incremental(spark):
    lst = tpch.listing(spark, SF001)
    cols = vocab.LISTING_TABLE_COLUMNS + ["listing_id"]
    base = lst.where(F.col("snapshot_date") < "1998-08-01").select(*cols)
    batch = lst.where(F.col("snapshot_date") >= "1998-08-01").select(*cols)
    drops, ckpt = shared_path(spark, "drops-t"), shared_path(spark, "ckpt-t")
    lake = CommittedLake(spark, shared_path(spark, "lake-t"))
    base.write.parquet(f"{drops}/night=1")
    ingest.ingest_drops(spark, drops, base.schema, lake, ckpt, "snapshot_month")
    n_hist_1 = lake.read("listings_history").count()
    ingest.ingest_drops(spark, drops, base.schema, lake, ckpt, "snapshot_month")   # restart, nothing new
    assert lake.read("listings_history").count() == n_hist_1 == base.count()
    batch.write.parquet(f"{drops}/night=2")
    ingest.ingest_drops(spark, drops, base.schema, lake, ckpt, "snapshot_month")   # new drop only
    assert lake.read("listings_history").count() == lst.count()
    assert lake.read("listings_latest").count() == lst.select("url").distinct().count()


def _listing(spark, rows):
    return spark.createDataFrame(
        [(u, d, float(p), 100.0, float(p) / 100, "c", "house") for u, d, p in rows],
        "url string, snapshot_date string, price double, surface_m2 double, price_per_m2 double, city string, "
        "property_type string").withColumn("snapshot_date", F.to_date("snapshot_date"))


def test_same_day_and_late_batches_lose_nothing(spark):
    from estatelake.plans.nightly import upsert_nightly
    lake = CommittedLake(spark, shared_path(spark, "lake-t"))
    upsert_nightly(lake, _listing(spark, [("a", "2024-02-01", 200)]), batch_id="1")
    upsert_nightly(lake, _listing(spark, [("b", "2024-02-01", 300)]), batch_id="2")      # same day
    upsert_nightly(lake, _listing(spark, [("a", "2024-01-01", 100)]), batch_id="3")      # late
    upsert_nightly(lake, _listing(spark, [("b", "2024-02-01", 300)]), batch_id="2")      # replay
    got = {r["url"]: r["price"] for r in lake.read("listings_latest").collect()}
    assert got == {"a": 200.0, "b": 300.0}
    assert lake.read("listings_history").count() == 3
    assert {str(r["snapshot_date"]): r["n"] for r in lake.read("market_summary_v2").collect()} == {
        "2024-02-01": 2, "2024-01-01": 1}


def test_rebuild_keeps_history_unfiltered(spark):
    from estatelake.plans.nightly import rebuild_analytics
    lake = CommittedLake(spark, shared_path(spark, "lake-t"))
    src = _listing(spark, [("a", "2024-02-01", 200000), ("b", "2024-02-01", 1), ("c", "2024-01-01", 250000)])
    rebuild_analytics(lake, src, run_date="2024-02-02")
    assert lake.read("listings_history").count() == 3
    assert {r["url"] for r in lake.read("listings_latest").collect()} == {"a"}


def test_a_drain_makes_the_summary_once(spark, monkeypatch):
    """However many epochs a drain has; between them and after a broken drain readers see it as it should be."""
    import statistics

    from estatelake.plans import nightly
    from estatelake.sources import buckets
    rows = [(f"u{i % 5}", f"2024-0{i % 3 + 1}-0{i % 2 + 1}", 100 * i + 7) for i in range(40)]
    drops, lake = shared_path(spark, "drops-t"), CommittedLake(spark, shared_path(spark, "lake-t"))
    frame = _listing(spark, rows)
    for i in range(4):
        frame.where(F.pmod(F.xxhash64("price"), F.lit(4)) == i).coalesce(1) \
            .write.mode("append").parquet(f"{drops}/night=1")

    def summary():
        return {str(r["snapshot_date"]): (r["n"], r["median_price_per_m2"]) for r in lake.read("market_summary_v2").collect()}

    def want(seen):
        days = {}
        for _, d, p in seen:
            days.setdefault(d, []).append(p / 100)
        return {d: (len(v), statistics.median(v)) for d, v in days.items()}

    made, between, quantiles, upsert = [], [], buckets.quantiles_of_counts, nightly.upsert_nightly
    monkeypatch.setattr(buckets, "quantiles_of_counts", lambda *a, **k: made.append(1) or quantiles(*a, **k))

    def watched(*a, **k):
        upsert(*a, **k)
        history = [(r["url"], str(r["snapshot_date"]), r["price"]) for r in lake.read("listings_history").collect()]
        n = len(made)
        between.append((summary(), want(history)))
        del made[n:]
    monkeypatch.setattr(ingest, "upsert_nightly", watched)
    ingest.ingest_drops(spark, drops, frame.schema, lake, history_partition="snapshot_month", max_files_per_trigger=1)
    assert len(between) == 4 and all(got == right for got, right in between)
    assert len(made) == 1 and summary() == want(rows) and not lake.due(lake.state(), nightly.SUMMARY) and len(made) == 1
    # a drain that broke off, then an ordinary night on one of its days
    upsert(lake, _listing(spark, [("x", "2024-01-01", 5)]), "snapshot_month", "broken", summarise=False)
    assert lake.due(lake.state(), nightly.SUMMARY) == ["2024-01"] and summary() == want([*rows, ("x", "2024-01-01", 5)])
    upsert(lake, _listing(spark, [("y", "2024-02-01", 9)]), "snapshot_month", "night")
    assert not lake.due(lake.state(), nightly.SUMMARY)
    assert summary() == want([*rows, ("x", "2024-01-01", 5), ("y", "2024-02-01", 9)])
