"""A lake of tables that are committed together: the current table by key
buckets, history by batches, summaries by partitions.

* **Commits.** Every write adds files under a version of its own; nothing is
  rewritten in place. A commit is one JSON document (which versions are live),
  created without overwriting: of two writers that take the same number one
  fails and nothing of it is seen. Readers take the newest complete commit, so
  current table, history and summaries always belong together, and a failed
  write leaves no trace but orphaned files (``vacuum``).
* **Current table.** Rows lie in buckets by the hash of their key. A bucket has a
  base version and maybe later ones with the newest rows of a batch. A batch only
  adds to the buckets it touches; a bucket is rewritten when the rows added since
  its base pass ``compact_share`` of the base. So a batch of one percent writes about
  one percent of the bytes, whatever its keys are.
* **Bloom filters.** With each addition goes a blocked Bloom filter of its keys, by bucket. A
  reader sends base rows that no filter may hold straight through; only the
  others meet the added rows to find the newest per key. Filters are broadcast while
  they are under ``BLOOM_BYTES`` (their size is in the commit); beyond it the reader's rows are all compared.
* **History** is one folder by (version, partition). A batch id that comes again
  replaces its own rows; a rebuild replaces all. **Counts** (value counts that
  summaries are made of) follow the same rule.
* **Summaries** keep a version per partition, so a batch replaces the partitions it touched. A commit may mark
  partitions as due instead: readers make these from the counts until a later commit writes them.

Driver: per commit one entry per bucket, batch and partition; never rows or keys.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.dedupe import top1
from ..operators.stats import quantiles_of_counts
from ..session import cut_lineage

HASHES = 4
BLOCK_BITS = 32768            # of one bitmap aggregate
KEYS_PER_BLOCK = 2048         # 16 bits a key: under 0.3 % false alarms
BLOOM_BYTES = 32 << 20
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


class Conflict(Exception):
    """Another writer committed first."""


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions) if conditions else F.lit(False)


class CommittedLake:
    """``current``: name of the current table, ``key``: its key; ``order``: columns that decide the newest row, the
    last one wins (NULL loses)."""

    def __init__(self, spark: SparkSession, root: str, current: str = "listings_latest", history: str = "listings_history",
                 key: str = "url", order: Sequence[str] = ("snapshot_date", "listing_id"), compact_share: float = 0.25):
        self.spark, self.root = spark, root.rstrip("/")
        self.current, self.history, self.key, self.order, self.compact_share = current, history, key, tuple(order), compact_share

    # ------------------------------------------------------------ commits
    def _fs(self, path: str):
        sc = self.spark.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(sc._jsc.hadoopConfiguration()), p

    def _read_text(self, path: str) -> str:
        fs, p = self._fs(path)
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _numbers(self) -> list[int]:
        fs, p = self._fs(f"{self.root}/_commits")
        return sorted((int(f.getPath().getName()) for f in fs.listStatus(p)), reverse=True) if fs.exists(p) else []

    def state(self) -> dict:
        """The newest complete commit. A commit that its writer did not finish counts as not there."""
        for n in self._numbers():
            try:
                got = json.loads(self._read_text(f"{self.root}/_commits/{n:08d}"))
            except ValueError:
                continue
            return got
        return {"commit": 0, "buckets": {}, "n_buckets": 0, "history": {}, "counts": {}, "summaries": {}, "partition": None, "plain": {},
                "schemas": {}}

    def commit(self, old: dict, new: dict) -> None:
        """Publish ``new``, which was made from ``old``."""
        numbers = self._numbers()
        if self.state()["commit"] != old["commit"]:
            raise Conflict(f"commit {old['commit']} is not the newest any more")
        number = max([*numbers, 0]) + 1
        fs, p = self._fs(f"{self.root}/_commits/{number:08d}")
        try:
            out = fs.create(p, False)
        except Exception as e:  # the file exists: another writer took the number
            raise Conflict(f"commit {number} is taken") from e
        try:
            out.write(bytearray(json.dumps({**new, "commit": number}).encode()))
        finally:
            out.close()

    @staticmethod
    def version() -> str:
        return f"v{uuid.uuid4().hex[:16]}"

    # ------------------------------------------------------------ current table
    def _bucket(self, n: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(n)).cast("int")

    def _newest(self, rows: DataFrame, dealt_by: Sequence[str] = ()) -> DataFrame:
        """``dealt_by``: functions of the key by which the rows are dealt already."""
        order = [F.col(c).desc_nulls_last() for c in (*self.order, "_fresh") if c in rows.columns]
        return top1(rows, [*dealt_by, self.key], order)

    def _files(self, state: dict, name: str) -> DataFrame:
        """All files of ``name``, live or not, with the columns of the commit: batches may differ in their columns."""
        return self.spark.read.schema(StructType.fromJson(state["schemas"][name])).parquet(f"{self.root}/{name}")

    def _live(self, state: dict, name: str, pairs: dict[str, list[int]]) -> DataFrame:
        """Rows of ``name`` in the given buckets of each version; other files are pruned by their folder names."""
        where = [(F.col("_version") == v) & F.col("_bucket").isin(b) for v, b in pairs.items()]
        return self._files(state, name).where(_any(where))

    @staticmethod
    def _by_version(buckets: dict, pick: Callable[[dict], list[str]]) -> dict[str, list[int]]:
        out: dict[str, list[int]] = {}
        for b, entry in buckets.items():
            for v in pick(entry):
                out.setdefault(v, []).append(int(b))
        return out

    def read_current(self, state: dict | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """The newest row per key (of the given buckets)."""
        state = state or self.state()
        mine = {b: e for b, e in state["buckets"].items() if buckets is None or int(b) in set(buckets)}
        if not mine:
            raise ValueError(f"{self.current} has no rows yet")
        rows = self._live(state, self.current, self._by_version(mine, lambda e: [e["base"], *e["added"]]))
        touched = {b: e for b, e in mine.items() if e["added"]}
        if not touched:
            return rows.drop("_version", "_bucket")
        clean = [int(b) for b, e in mine.items() if not e["added"]]
        # a version may be the base of one bucket and an addition to another
        base_pairs = self._by_version(mine, lambda e: [e["base"]])
        in_base = _any([(F.col("_version") == v) & F.col("_bucket").isin(b) for v, b in base_pairs.items()])
        passed = rows.where(F.col("_bucket").isin(clean))
        rest = rows.where(~F.col("_bucket").isin(clean)).withColumn("_fresh", F.when(in_base, 0).otherwise(1))
        blooms = self._blooms(state, touched)
        if blooms is not None:
            rest = rest.withColumn("_maybe", self._may_hold_column(touched))
            rest = rest.join(F.broadcast(blooms), (F.col("_bucket") == F.col("_b")) & (F.col("_maybe") == F.col("_block")), "left")
            hit = _all_bits(F.col("_bits"), self.key)
            rest = rest.withColumn("_meets", (F.col("_fresh") == 1) | F.coalesce(hit, F.lit(False))).drop("_b", "_block", "_bits", "_maybe")
            through = rest.where("NOT _meets").drop("_fresh", "_meets")
            passed = passed.unionByName(through)
            rest = rest.where("_meets").drop("_meets")
        merged = self._newest(self._order_of_additions(rest, touched)).drop("_fresh")
        return passed.unionByName(merged).drop("_version", "_bucket")

    def _order_of_additions(self, rows: DataFrame, touched: dict) -> DataFrame:
        """``_fresh``: 0 for base rows, else the number of the commit, so that of equal rows the later batch wins."""
        places: dict[str, int] = {}
        for e in touched.values():
            for v in e["added"]:
                places[v] = max(places.get(v, 0), e["places"][v])
        when = F.when(F.col("_fresh") == 0, F.lit(0))
        for v, n in places.items():
            when = when.when(F.col("_version") == v, F.lit(n))
        return rows.withColumn("_fresh", when.otherwise(F.lit(0)))

    # ------------------------------------------------------------ Bloom filters
    def _may_hold_column(self, touched: dict) -> Column:
        """Block of a key in its bucket's filter. All filters of a bucket have the bucket's number of blocks."""
        blocks = F.create_map(*[F.lit(x) for b, e in touched.items() for x in (int(b), e["blocks"])])
        return F.pmod(F.xxhash64(self.key, F.lit(1)), F.element_at(blocks, F.col("_bucket"))).cast("int")

    def _blooms(self, state: dict, touched: dict) -> DataFrame | None:
        """(_b, _block, _bits) of the touched buckets, the filters of a bucket's additions united; None when they
        would be too large to broadcast."""
        if sum(len(e["added"]) * e["blocks"] for e in touched.values()) * BLOCK_BITS // 8 > BLOOM_BYTES:
            return None
        pairs = self._by_version(touched, lambda e: e["added"])
        bits = self._live(state, f"{self.current}_bloom", pairs)
        return bits.groupBy(F.col("_bucket").alias("_b"), "_block").agg(F.bitmap_or_agg("_bits").alias("_bits"))

    def _bloom(self, rows: DataFrame, blocks: dict[int, int]) -> DataFrame:
        """Filters of added rows with their ``_bucket``: one bitmap per (bucket, block)."""
        n = F.create_map(*[F.lit(x) for b, k in blocks.items() for x in (b, k)])
        block = F.pmod(F.xxhash64(self.key, F.lit(1)), F.element_at(n, F.col("_bucket"))).cast("int")
        at = F.explode(F.array(*[_bit(self.key, i) for i in range(HASHES)]))
        return rows.select("_bucket", block.alias("_block"), at.alias("_at")).groupBy("_bucket", "_block").agg(
            F.bitmap_construct_agg("_at").alias("_bits"))

    # ------------------------------------------------------------ writing
    def _write(self, state: dict, name: str, rows: DataFrame, version: str, partition: Sequence[str]) -> dict:
        """Add files of one version; the state knows their columns."""
        rows = rows.withColumn("_version", F.lit(version))
        rows.write.mode("append").option("partitionOverwriteMode", "static").partitionBy("_version", *partition).parquet(f"{self.root}/{name}")
        known = StructType.fromJson(state["schemas"][name]) if name in state["schemas"] else StructType()
        for f in rows.schema.fields:
            if f.name not in known.names:
                known = known.add(f.name, f.dataType, True)
        return {**state, "schemas": {**state["schemas"], name: known.jsonValue()}}

    def _sizes(self, state: dict, version: str, buckets: list[int]) -> dict[int, int]:
        """Rows per bucket, one entry per bucket."""
        rows = self._live(state, self.current, {version: buckets}).groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"))
        return {r["_bucket"]: r["n"] for r in rows.collect()}

    @staticmethod
    def _fresh_entry(version: str, rows: int) -> dict:
        return {"base": version, "rows": rows, "added": [], "more": 0, "places": {}, "blocks": 1}

    def replace_current(self, state: dict, rows: DataFrame, rows_per_bucket: int = 1 << 20) -> dict:
        """State with the newest row per key of ``rows`` as the whole current table."""
        rows = cut_lineage(self._newest(rows.where(F.col(self.key).isNotNull())))
        version, n = self.version(), max(16, -(-rows.count() // rows_per_bucket))
        state = self._write(state, self.current, rows.withColumn("_bucket", self._bucket(n)).repartition(n, "_bucket"), version, ["_bucket"])
        sizes = self._sizes(state, version, list(range(n)))
        return {**state, "n_buckets": n, "buckets": {str(b): self._fresh_entry(version, k) for b, k in sizes.items()}}

    def merge_current(self, state: dict, batch: DataFrame) -> dict:
        """State after the newest row per key of table and ``batch``; NULL keys are rejected."""
        if not state["n_buckets"]:
            return self.replace_current(state, batch)
        n, version, buckets = state["n_buckets"], self.version(), dict(state["buckets"])
        batch = self._newest(batch.where(F.col(self.key).isNotNull()))
        batch = cut_lineage(batch.withColumn("_bucket", self._bucket(n)))
        arriving = {r["_bucket"]: r["n"] for r in batch.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
        full = [b for b, k in arriving.items()
                if str(b) not in buckets or buckets[str(b)]["more"] + k > self.compact_share * buckets[str(b)]["rows"]]
        adding = {b: k for b, k in arriving.items() if b not in set(full)}
        parts = []
        if adding:
            # as many blocks as the additions to a bucket may need before it is rewritten
            blocks = {b: max(1, -(-int(buckets[str(b)]["rows"] * self.compact_share) // KEYS_PER_BLOCK)) for b in adding}
            added = batch.where(F.col("_bucket").isin(list(adding)))
            state = self._write(state, f"{self.current}_bloom", self._bloom(added, blocks), version, ["_bucket"])
            parts.append(added.repartition("_bucket"))
        if full:
            whole = batch.where(F.col("_bucket").isin(full)).withColumn("_fresh", F.lit(1))
            old = [b for b in full if str(b) in buckets]
            if old:
                before = self.read_current(state, old).withColumn("_fresh", F.lit(0)).withColumn("_bucket", self._bucket(n))
                whole = before.unionByName(whole, allowMissingColumns=True)
            # at most two rows per key, so one exchange by bucket serves both the choice and the files
            parts.append(self._newest(whole.repartition("_bucket"), ["_bucket"]).drop("_fresh"))
        if not parts:
            return state
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        state = self._write(state, self.current, rows, version, ["_bucket"])
        sizes = self._sizes(state, version, full) if full else {}
        buckets |= {str(b): self._fresh_entry(version, sizes[b]) for b in full}
        for b, k in adding.items():
            e = buckets[str(b)]
            buckets[str(b)] = {**e, "added": [*e["added"], version], "more": e["more"] + k,
                               "places": {**e["places"], version: state["commit"] + 1}, "blocks": blocks[b]}
        return {**state, "buckets": buckets}

    # ------------------------------------------------------------ history, counts, summaries
    def add_batch(self, state: dict, which: str, name: str, rows: DataFrame, batch_id: str, alone: bool = False) -> dict:
        """State in which ``rows`` are the rows of ``batch_id`` in ``name``, and the only ones with ``alone``."""
        version = self.version()
        state = self._write(state, name, rows, version, [state["partition"]])
        return {**state, which: {**({} if alone else state[which]), batch_id: version}}

    def read_batches(self, state: dict, which: str, name: str, batch_ids: Sequence[str] | None = None) -> DataFrame:
        live = [v for b, v in state[which].items() if batch_ids is None or b in batch_ids]
        return self._files(state, name).where(F.col("_version").isin(live)).drop("_version")

    def put_partitions(self, state: dict, name: str, rows: DataFrame, values: Sequence, alone: bool = False) -> dict:
        """State in which ``rows`` are the given partitions of summary ``name``."""
        version = self.version()
        state = self._write(state, name, rows, version, [state["partition"]])
        old = {} if alone else state["summaries"].get(name, {})
        new = {NULL_PARTITION if v is None else str(v): version for v in values}
        due = [] if alone else [v for v in self.due(state, name) if (NULL_PARTITION if v is None else v) not in new]
        left = {n: d for n, d in state.get("due", {}).items() if n != name}
        return {**state, "summaries": {**state["summaries"], name: {**old, **new}},
                "due": {**left, name: {**state["due"][name], "values": due}} if due else left}

    def put_due(self, state: dict, name: str, values: Sequence, how: dict) -> dict:
        """State in which the given partitions of summary ``name`` are due: to be made of the counts, by
        ``quantiles_of_counts`` with the arguments ``how`` (``counts``: name of the counts)."""
        due = state.get("due", {}).get(name, {"values": []})["values"]
        return {**state, "due": {**state.get("due", {}), name: {"how": how, "values": due + [
            v if v is None else str(v) for v in values if (v if v is None else str(v)) not in due]}}}

    def due(self, state: dict, name: str) -> list:
        return state.get("due", {}).get(name, {"values": []})["values"]

    def from_counts(self, state: dict, how: dict, values: Sequence) -> DataFrame:
        """The given partitions of a summary, made of the counts."""
        how = dict(how)
        counts, part = self.read_batches(state, "counts", how.pop("counts")), F.col(state["partition"])
        some = part.cast("string").isin([v for v in values if v is not None]) | (part.isNull() if None in values else F.lit(False))
        return quantiles_of_counts(counts.where(some), **how)

    def read_summary(self, name: str, state: dict | None = None) -> DataFrame:
        state = state or self.state()
        due = self.due(state, name)
        if due:
            made = self.from_counts(state, state["due"][name]["how"], due)
            late = {NULL_PARTITION if v is None else v for v in due}
            kept = {v: n for v, n in state["summaries"].get(name, {}).items() if v not in late}
            if not kept:
                return made
            rest = {**state, "due": {}, "summaries": {**state["summaries"], name: kept}}
            return self.read_summary(name, rest).unionByName(made)
        live: dict[str, list[str]] = {}
        for value, version in state["summaries"][name].items():
            live.setdefault(version, []).append(value)
        part = F.coalesce(F.col(state["partition"]).cast("string"), F.lit(NULL_PARTITION))
        where = _any([(F.col("_version") == v) & part.isin(values) for v, values in live.items()])
        return self._files(state, name).where(where).drop("_version")

    def put_table(self, state: dict, name: str, rows: DataFrame) -> dict:
        """State in which ``rows`` are the whole table ``name``."""
        version = self.version()
        rows.write.parquet(f"{self.root}/{name}/{version}")
        return {**state, "plain": {**state["plain"], name: version}}

    def read_table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}/{self.state()['plain'][name]}")

    # ------------------------------------------------------------ readers by name
    def read(self, name: str) -> DataFrame:
        state = self.state()
        if name == self.current:
            return self.read_current(state)
        if name == self.history:
            return self.read_batches(state, "history", name)
        return self.read_summary(name, state) if name in state["summaries"] or self.due(state, name) else self.read_table(name)

    def exists(self, name: str) -> bool:
        state = self.state()
        return bool(state["buckets"] if name == self.current else state["history"] if name == self.history
                    else name in state["summaries"] or self.due(state, name) or name in state["plain"])

    def vacuum(self) -> int:
        """Delete the files of versions that the newest commit does not use, and older commits. Run it when no reader
        or writer is at work. Returns the number of folders deleted."""
        state = self.state()
        live = {v for e in state["buckets"].values() for v in [e["base"], *e["added"]]}
        live |= set(state["history"].values()) | set(state["counts"].values()) | set(state["plain"].values())
        live |= {v for s in state["summaries"].values() for v in s.values()}
        gone = 0
        fs, root = self._fs(self.root)
        for table in fs.listStatus(root):
            for f in fs.listStatus(table.getPath()) if table.isDirectory() else ():
                name = f.getPath().getName()
                old = table.getPath().getName() == "_commits" and int(name) < state["commit"]
                dead = f.isDirectory() and not name.startswith("_commit") and name.split("=")[-1] not in live
                if old or dead:
                    fs.delete(f.getPath(), True)
                    gone += 1
        return gone


def _bit(key: str, i: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(10 + i)), F.lit(BLOCK_BITS))


def _all_bits(bits: Column, key: str) -> Column:
    """Whether all of a key's bits are set in a bitmap (byte ``n / 8``, lowest bit first)."""
    def one(i):
        at = _bit(key, i)
        byte = F.conv(F.hex(F.substring(bits, (F.floor(at / 8) + 1).cast("int"), 1)), 16, 10).cast("int")
        return byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), (at % 8).cast("int"))) != 0
    return reduce(lambda a, b: a & b, [one(i) for i in range(HASHES)])
