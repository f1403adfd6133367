"""One lake under rebuilds, nights in any order, replays, late and overlapping batches, failures and rival writers."""

import os
import random
import statistics
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from estatelake.plans import nightly
from estatelake.session import shared_path
from estatelake.sources import buckets
from estatelake.sources.buckets import CommittedLake, Conflict
from estatelake.sources.tables import Lake

SCHEMA = "url string, snapshot_date string, price double, surface_m2 double, price_per_m2 double, city string, property_type string, listing_id long"


def frame(spark, rows):
    """rows: (url, day, price, id)"""
    return spark.createDataFrame([(u, d, p, 100.0, p / 100, "c" + str(int(p) % 3), "house", i) for u, d, p, i in rows],
                                 SCHEMA).withColumn("snapshot_date", F.to_date("snapshot_date"))


def lake_of(spark, **options):
    return CommittedLake(spark, shared_path(spark, "lake-t"), **options)


def latest(rows):
    best = {}
    for r in rows:
        if r[0] is not None and (r[0] not in best or (r[1], r[3]) >= (best[r[0]][1], best[r[0]][3])):
            best[r[0]] = r
    return {u: (r[1], r[2]) for u, r in best.items()}


def summary(rows):
    groups = defaultdict(list)
    for u, d, p, _ in rows:
        if u is not None:
            groups[d, "c" + str(int(p) % 3)].append(p / 100)
    return {k: (len(v), statistics.median(v)) for k, v in groups.items()}


def check(lake, current, history):
    got = {r["url"]: (str(r["snapshot_date"]), r["price"]) for r in lake.read("listings_latest").collect()}
    assert got == current
    assert Counter((r["url"], str(r["snapshot_date"]), r["price"]) for r in lake.read("listings_history").collect()) == Counter(
        (u, d, p) for u, d, p, _ in history)
    got = {(str(r["snapshot_date"]), r["city"]): (r["n"], r["median_price_per_m2"]) for r in lake.read("market_summary_v2").collect()}
    assert got == summary(history)


def batch_of(rng, first, n, days=("2024-01-01", "2024-01-02", "2024-01-03", "2024-02-01")):
    return [(f"u{rng.randrange(60)}", rng.choice(days), float(rng.randrange(100_000, 900_000)), first + i) for i in range(n)]


@pytest.mark.parametrize("partition,bloom_bytes", [("snapshot_date", buckets.BLOOM_BYTES), ("snapshot_month", 0)])
def test_rebuild_and_nights_in_any_order(spark, monkeypatch, partition, bloom_bytes):
    monkeypatch.setattr(buckets, "BLOOM_BYTES", bloom_bytes)
    rng, lake = random.Random(3), lake_of(spark)
    base = batch_of(rng, 0, 120)
    nightly.rebuild_analytics(lake, frame(spark, base), history_partition=partition)
    newest = max(r[1] for r in base)
    current = [r for r in base if r[1] == newest]
    check(lake, latest(current), base)
    nights, history = {}, base
    for name in ("n1", "n2", "n1", "n3"):                       # n1 again, with other rows
        nights[name] = batch_of(rng, 1000 * (len(nights) + 1), 9)
        nightly.upsert_nightly(lake, frame(spark, nights[name]), partition, name)
        current = current + nights[name]
        history = base + [r for b in nights.values() for r in b]
        check(lake, latest(current), history)
    again = batch_of(rng, 9000, 40)
    nightly.rebuild_analytics(lake, frame(spark, again), history_partition=partition)
    current = [r for r in again if r[1] == max(x[1] for x in again)]
    check(lake, latest(current), again)
    more = [("u1", "2023-12-31", 5.0, 1), ("new", "2023-12-31", 7.0, 2)]
    nightly.upsert_nightly(lake, frame(spark, more), partition, "n4")
    check(lake, latest(current + more), again + more)
    assert lake.vacuum() > 0
    check(lake, latest(current + more), again + more)
    with pytest.raises(ValueError):
        nightly.upsert_nightly(lake, frame(spark, more), "snapshot_date" if partition != "snapshot_date" else "snapshot_month", "n5")


def size(root, versions):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(root) for f in files
               if f.endswith(".parquet") and any(f"_version={v}" in d for v in versions))


def test_one_percent_batch_writes_under_ten_percent(spark):
    lake, n = lake_of(spark), 40_000
    rows = spark.range(n).select(F.concat(F.lit("https://x/"), "id").alias("url"), F.lit("2024-01-01").cast("date").alias("snapshot_date"),
                                 F.sha2(F.col("id").cast("string"), 512).alias("title"), F.col("id").alias("listing_id"))
    one = lake.replace_current(lake.state(), rows)
    lake.commit(lake.state(), one)
    batch = rows.where("listing_id % 100 = 7").withColumn("snapshot_date", F.lit("2024-01-02").cast("date")).withColumn("title", F.lit("new"))
    two = lake.merge_current(lake.state(), batch)
    lake.commit(lake.state(), two)
    versions = lambda s: {v for e in s["buckets"].values() for v in [e["base"], *e["added"]]}
    root = lake.root.replace("file:", "") + "/listings_latest"
    before, added = size(root, versions(one)), size(root, versions(two) - versions(one))
    assert 0 < added < 0.1 * before and all(len(e["added"]) == 1 for e in two["buckets"].values())
    got = lake.read("listings_latest")
    assert got.count() == n and got.where("title = 'new'").count() == n // 100
    # beyond the share a bucket is rewritten once
    big = rows.where("listing_id % 2 = 0").withColumn("snapshot_date", F.lit("2024-01-03").cast("date")).withColumn("title", F.lit("newer"))
    three = lake.merge_current(lake.state(), big)
    lake.commit(lake.state(), three)
    assert all(not e["added"] for e in three["buckets"].values())
    got = Counter(r["title"] if len(r["title"]) < 9 else "old" for r in lake.read("listings_latest").select("title").collect())
    assert got == {"newer": n // 2, "new": n // 100, "old": n - n // 2 - n // 100}


def test_filters_let_base_rows_pass(spark):
    lake = lake_of(spark)
    rows = spark.range(30_000).select(F.concat(F.lit("k"), "id").alias("url"), F.lit(1).alias("snapshot_date"), F.col("id").alias("listing_id"))
    lake.commit(lake.state(), lake.replace_current(lake.state(), rows))
    lake.commit(lake.state(), lake.merge_current(lake.state(), rows.where("listing_id < 150").withColumn("snapshot_date", F.lit(2))))
    state = lake.state()
    touched = {b: e for b, e in state["buckets"].items() if e["added"]}
    blooms = lake._blooms(state, touched)
    keyed = rows.withColumn("_bucket", lake._bucket(state["n_buckets"])).withColumn("_maybe", lake._may_hold_column(touched))
    hit = keyed.join(blooms, (F.col("_bucket") == F.col("_b")) & (F.col("_maybe") == F.col("_block"))).where(buckets._all_bits(F.col("_bits"), "url"))
    assert hit.where("listing_id < 150").count() == 150 and hit.count() < 150 + 300


def test_rivals_and_failures(spark):
    lake = lake_of(spark)
    nightly.upsert_nightly(lake, frame(spark, [("a", "2024-01-01", 300.0, 1)]), batch_id="1")
    old = lake.state()
    mine = lake.merge_current(old, frame(spark, [("a", "2024-01-02", 400.0, 2)]))
    nightly.upsert_nightly(lake, frame(spark, [("b", "2024-01-01", 500.0, 3)]), batch_id="2")
    with pytest.raises(Conflict):
        lake.commit(old, mine)
    # a writer that died while it wrote its commit
    n = lake.state()["commit"]
    path = f"{lake.root.replace('file:', '')}/_commits/{n + 1:08d}"
    with open(path, "w") as f:
        f.write('{"commit": ')
    assert lake.state()["commit"] == n and {r["url"] for r in lake.read("listings_latest").collect()} == {"a", "b"}
    nightly.upsert_nightly(lake, frame(spark, [("c", "2024-01-01", 500.0, 4), (None, "2024-01-01", 1.0, 5)]), batch_id="3")
    assert lake.state()["commit"] == n + 2 and {r["url"] for r in lake.read("listings_latest").collect()} == {"a", "b", "c"}


def test_replaced_tables_take_numbers_of_their_own(spark):
    lake = Lake(spark, shared_path(spark, "lake-t"))
    df = lambda n: spark.range(n)
    lake.replace("t", df(3))
    lake._reserve("t")                                          # a rival that never finished
    lake.replace("t", df(4))
    assert lake.read("t").count() == 4 and lake.version("t") == 3
    lake.replace("t", lake.read("t").where("id > 0"))
    assert lake.read("t").count() == 3 and len(lake._versions("t")) == 3


def test_a_night_reads_its_batch_once(spark):
    lake, read = lake_of(spark), spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(p):
        read.add(1)
        return p
    rows = [(f"u{i}", f"2024-01-0{i % 4 + 1}", 100.0 + i, i) for i in range(30)]
    writes, write = [], lake._write
    lake._write = lambda state, name, *rest: writes.append(name) or write(state, name, *rest)
    nightly.upsert_nightly(lake, frame(spark, rows).withColumn("price", seen.asNondeterministic()("price")))
    # history is written first, from the source; all else is derived from what was written
    assert writes[0] == lake.history and read.value == len(rows)
    assert {r["url"]: (str(r["snapshot_date"]), r["price"]) for r in lake.read("listings_latest").collect()} == latest(rows)
