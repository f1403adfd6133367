"""The nightly flows, composed from operators and sinks (§3 of the survey).

* ``rebuild_analytics``: history/raw → clean → history, latest snapshot,
  daily summaries, sanity report.
* ``upsert_nightly``: batch → newest row per URL in the current table, history,
  the touched partitions of ``market_summary_v2``.
* ``analysis_tables``: normalise → drop rows without price → latest,
  history, v1 summary.

The first two work on one ``CommittedLake`` in any order, and each of them is one
commit: a reader sees current table, history and summaries of the same state.
History keeps its rows by batch id (``rebuild`` for those of a rebuild), so
batches never overwrite each other, whatever days they share, while a replayed
batch (a retried stream epoch, a rerun night under the same id) replaces its own
rows only. Beside history lie counts per (day, city, type, value): the summary of a
touched partition is made of these few columns, never of history's rows.
"""

from __future__ import annotations

import datetime as _dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..operators import market, resolve
from ..session import cut_lineage
from ..sources.buckets import CommittedLake
from ..sources.tables import Lake

REBUILD = "rebuild"
SUMMARY = "market_summary_v2"
SUMMARY_KEYS = ["snapshot_date", "city", "property_type"]


def rebuild_analytics(lake: CommittedLake, source: DataFrame, clean: bool = True,
                      run_date: _dt.date | str | None = None,
                      history_partition: str = "snapshot_date") -> DataFrame:
    """Rebuild: replaces history, current table and summaries by those of ``source`` and returns the one-row sanity
    report (also appended to the ``sanity_report`` table). History is partitioned by ``history_partition`` (a nightly
    date by default; a coarser derived column such as a month for long back-fills)."""
    prepared = market.prepare_rebuild(source, run_date)
    old = lake.state()
    state = {**old, "partition": history_partition}
    state = lake.add_batch(state, "history", lake.history, _with_partition(prepared, history_partition), REBUILD, alone=True)
    # the source is read once: history keeps every row, and all else is derived from what was written
    history = lake.read_batches(state, "history", lake.history)
    counters = market.sanity_counters(history)
    kept = market.plausible(history) if clean else history
    state = lake.replace_current(state, market.latest_snapshot(kept).drop(*_derived(history_partition)))
    state = lake.put_table(state, "market_daily_summary", market.market_summary_v3(kept))
    state = _summarised(lake, state, history, REBUILD, None)
    lake.commit(old, state)
    Lake(lake.spark, lake.root).report_from("sanity_report", counters.withColumn("rebuilt_at", F.current_timestamp()))
    return counters


def _derived(partition: str) -> list[str]:
    return [] if partition == "snapshot_date" else [partition]


def _with_partition(df: DataFrame, col: str) -> DataFrame:
    if col in df.columns:
        return df
    if col == "snapshot_month":
        return df.withColumn(col, F.date_format("snapshot_date", "yyyy-MM"))
    raise ValueError(col)


def _summarised(lake: CommittedLake, state: dict, rows: DataFrame, batch_id: str, before: dict | None, now: bool = True) -> dict:
    """State with the batch's value counts and the summaries of the partitions it touches; all partitions when there is
    no state before. The partitions that a replayed batch had touched count as well. Without ``now`` they are due."""
    part = state["partition"]
    keys = list(dict.fromkeys([part, *SUMMARY_KEYS]))
    counted = rows.where("url IS NOT NULL AND price_per_m2 IS NOT NULL").groupBy(*keys, "price_per_m2").agg(F.count(F.lit(1)).alias("n"))
    # a partition's counts lie in few files, and a large one is split over several tasks
    state = lake.add_batch(state, "counts", "market_counts", counted.hint("rebalance", part), batch_id, alone=before is None)
    touched = lake.read_batches(state, "counts", "market_counts", [batch_id]).select(part)
    if before and batch_id in before["counts"]:
        touched = touched.unionByName(lake.read_batches(before, "counts", "market_counts", [batch_id]).select(part))
    # partition names: a handful of days or months for a night, all of them for a rebuild
    values = [r[0] if r[0] is None else str(r[0]) for r in touched.distinct().collect()]
    how = {"counts": "market_counts", "keys": keys, "value": "price_per_m2", "weight": "n", "wanted": {"median_price_per_m2": 0.5}, "total": "n"}
    if not now:
        return lake.put_due(state, SUMMARY, values, how)
    if before is not None:
        values += [v for v in lake.due(state, SUMMARY) if v not in values]
    return lake.put_partitions(state, SUMMARY, lake.from_counts(state, how, values), values, alone=before is None)


def refresh_summaries(lake: CommittedLake) -> None:
    """Write the partitions of the summary that are due, as one commit."""
    old = lake.state()
    values = lake.due(old, SUMMARY)
    if values:
        made = lake.from_counts(old, old["due"][SUMMARY]["how"], values)
        lake.commit(old, lake.put_partitions(old, SUMMARY, made, values))


def upsert_nightly(lake: CommittedLake, batch: DataFrame, history_partition: str = "snapshot_date",
                   batch_id: str = "0", summarise: bool = True) -> None:
    """J2 with sinks, as one commit: the newest row per URL into ``listings_latest``, the batch into
    ``listings_history``, the touched partitions of ``market_summary_v2``. A batch that arrives late never replaces a newer row, and
    the same batch twice gives the same tables. Without ``summarise`` the touched partitions are due: readers make them
    from the counts until ``refresh_summaries`` or a later batch writes them."""
    # the table's columns, plus the source row id when there is one (it
    # breaks same-day ties between snapshots of one URL deterministically)
    extra = ["listing_id"] if "listing_id" in batch.columns else []
    batch = resolve.select_fixed(batch, vocab.LISTING_TABLE_COLUMNS + extra,
                                 {"snapshot_date": "date", "price": "double", "surface_m2": "double",
                                  "bedrooms": "int", "bathrooms": "int", "year_built": "int",
                                  "price_per_m2": "double"})
    batch = batch.where(F.col("url").isNotNull())
    old = lake.state()
    if old["partition"] not in (None, history_partition):
        raise ValueError(f"history is partitioned by {old['partition']}, not by {history_partition}; rebuild it to change that")
    rows = _with_partition(batch, history_partition)
    state = lake.add_batch({**old, "partition": history_partition}, "history", lake.history, rows, batch_id)
    # the batch is read once: history keeps every row, and all else takes the columns it needs from what was written
    rows = lake.read_batches(state, "history", lake.history, [batch_id]).select(*rows.columns)
    # the current table and the summaries do not depend on each other: their jobs fill each other's gaps
    with ThreadPoolExecutor(max_workers=2) as pool:
        current = pool.submit(lake.merge_current, state, rows.select(*batch.columns))
        summary = pool.submit(_summarised, lake, state, rows, batch_id, old, summarise)
    current, state = current.result(), summary.result()
    mine = {n: s for n, s in current["schemas"].items() if n in (lake.current, f"{lake.current}_bloom")}
    lake.commit(old, {**state, "n_buckets": current["n_buckets"], "buckets": current["buckets"], "schemas": {**state["schemas"], **mine}})


def analysis_tables(lake: Lake, details: DataFrame) -> None:
    """Normalise → drop rows without price → latest, history, v1 summary."""
    norm = cut_lineage(market.drop_missing(resolve.normalize_listing(details), ["price"]))
    lake.replace("analysis_latest", norm)
    lake.append("analysis_history", norm)
    lake.replace("market_summary_v1", market.market_summary_v1(norm))
