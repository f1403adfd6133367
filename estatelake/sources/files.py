"""File-zone sources.

* Files are found by the reader itself (recursive lookup plus a name pattern);
  no list of paths passes through the driver. Names and prefixes are tested
  on the decoded ``_metadata.file_path``, so blanks in folders are fine.
* CSV drops with different headers (``url`` / ``URL`` / ``link`` / ``href``,
  extra columns) are parsed in ONE scan, written out once: every record is read as positional
  string columns, as many as the widest header line has commas (an upper bound
  found in the first line of each file), each file's header is its first record,
  and data records are mapped to names through a file-level header table joined
  back on the file path (one row per file — small, broadcast by AQE when
  under the threshold). Quoted fields may hold newlines and doubled quotes, so a file
  is read by one task; a day has many files, none of them large.
* Unreadable files are skipped (``ignoreCorruptFiles``); files without a URL
  column are skipped; keep-first dedupe is a top-1 window ordered by
  (source file, row id).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DataType, DateType, DoubleType, IntegerType, LongType, NullType, NumericType, ShortType, StringType,
                               StructField, StructType, TimestampNTZType, TimestampType)

from .. import vocab
from ..operators.dedupe import first_by_url
from ..session import cut_lineage

def list_files(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """(path, name, size, mtime) of every file under ``root`` matching
    ``glob``, recursively."""
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
          .option("pathGlobFilter", glob).option("ignoreMissingFiles", "true").load(root))
    return df.select(F.col("path"), F.element_at(F.split("path", "/"), -1).alias("name"),
                     F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))


def csv_reader(spark: SparkSession):
    """RFC 4180 quoting: newlines and doubled quotes inside quoted fields."""
    return spark.read.option("multiLine", "true").option("escape", '"')


def decoded_path() -> Column:
    """The scanned file's path without URI escapes ('+' is literal in paths)."""
    raw = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return F.regexp_replace(F.url_decode(raw), r"^file:/*", "/")


def header_width(spark: SparkSession, root: str, glob: str = "*.csv") -> int:
    """Upper bound on the columns of any file: commas in its first line, plus one."""
    lines = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
             .option("ignoreCorruptFiles", "true").text(root)
             .select("value", F.col("_metadata.file_path").alias("path"),
                     F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("id"))
             .where("at = 0"))
    first = lines.groupBy("path").agg(F.min_by("value", "id").alias("line"))
    return (first.agg(F.max(F.regexp_count("line", F.lit(",")))).first()[0] or 0) + 1


def read_csv_any_header(spark: SparkSession, root: str, glob: str = "*.csv",
                        skip_prefixes: Sequence[str] = ()) -> DataFrame:
    """Union-by-name of the CSV files under ``root`` with heterogeneous headers, one scan.

    Files whose lower-cased name starts with one of ``skip_prefixes`` are left out.
    Returns one string column per distinct header name (first-seen order)
    plus ``__source_file`` (decoded path) and ``__row`` (row id, increasing within a file).
    Empty header names are dropped; duplicate names keep the first column.
    """
    width = header_width(spark, root, glob)
    schema = StructType([StructField(f"_c{i}", StringType()) for i in range(width)])
    raw = (csv_reader(spark).schema(schema).option("header", "false").option("mode", "PERMISSIVE")
           .option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
           .option("ignoreCorruptFiles", "true").csv(root)
           .withColumn("__source_file", decoded_path())
           .withColumn("__row", F.monotonically_increasing_id()))
    name = F.lower(F.element_at(F.split("__source_file", "/"), -1))
    for p in skip_prefixes:
        raw = raw.where(~name.startswith(p))
    # the files' records are parsed once; headers and data are both taken from what was written
    raw = cut_lineage(raw.select("__source_file", "__row", F.array(*[F.col(f"_c{i}") for i in range(width)]).alias("__vals")))
    vals = F.col("__vals")
    # a file's header is its first record: two narrow columns tell which, one record a file is fetched
    first = raw.groupBy("__source_file").agg(F.min("__row").alias("__hdr_row"))
    headers = first.join(raw.select(F.col("__row").alias("__hdr_row"), vals.alias("__header")), "__hdr_row")
    headers = (headers.withColumn("__header", F.transform("__header", lambda v: F.trim(v)))
               .withColumn("__lheader", F.transform("__header", lambda v: F.lower(v))))
    # Header names are metadata: one small list on the driver. Names equal
    # up to case are one column (Spark resolves names case-insensitively);
    # the first-seen spelling is kept.
    names_df = (headers.select(F.posexplode("__header").alias("pos", "name"))
                .where(F.col("name").isNotNull() & (F.col("name") != ""))
                .groupBy(F.lower("name").alias("lname"))
                .agg(F.min_by("name", "pos").alias("name"), F.min("pos").alias("pos"))
                .orderBy("pos", "lname"))
    names = [(r["lname"], r["name"]) for r in names_df.collect()]
    data = raw.join(headers, "__source_file").where(F.col("__row") != F.col("__hdr_row"))
    cols = []
    for lname, name in names:
        pos = F.array_position(F.col("__lheader"), lname)
        cols.append(F.when(pos > 0, F.element_at(vals, F.greatest(pos, F.lit(1)).cast("int")))
                    .alias(name))
    return data.select(*cols, "__source_file", "__row")


def url_column_of(df: DataFrame) -> list[str]:
    """Columns usable as the URL, in table order."""
    return [c for c in df.columns if c.lower() in vocab.URL_COLUMN_NAMES]


def looks_like_kind(url, kind: str):
    """whether a legacy URL names the kind, by the fixed markers of the vocabulary."""
    low = F.lower(F.coalesce(url, F.lit("")))
    return F.exists(F.array(*[F.lit(m) for m in vocab.KIND_URL_MARKERS[kind]]), lambda m: F.contains(low, m))


def consolidate_urls(spark: SparkSession, day_dir: str, kind: str) -> DataFrame:
    """S3 (+P3, F9, A9): every CSV under ``day_dir/<kind>/`` (modern) and
    ``day_dir/<other dir>/`` (legacy, rows filtered by kind) → one URL per
    listing, first occurrence by (file path, row)."""
    df = read_csv_any_header(spark, day_dir)
    ucols = url_column_of(df)
    if not ucols:
        raise LookupError(f"{day_dir}: no file has a URL column (kind {kind})")
    # per file, the first header name that is a URL column wins
    url = F.coalesce(*[F.col(c) for c in ucols])
    root = "/" + re.sub(r"^[a-z]+:/*", "", day_dir).strip("/") if "://" not in day_dir or day_dir.startswith("file:") \
        else day_dir.rstrip("/")
    src = F.col("__source_file")
    is_modern = src.startswith(f"{root}/{kind}/")
    other = F.lit(False)
    for k in vocab.KIND_URL_MARKERS:
        if k != kind:
            other = other | src.startswith(f"{root}/{k}/")
    out = df.select(url.alias("url"), src.alias("__source_file"), F.col("__row"),
                    *[c for c in df.columns if c not in ucols + ["__source_file", "__row"]])
    keep = is_modern | (~other & looks_like_kind(F.col("url"), kind))
    return first_by_url(out.where(keep & F.col("url").isNotNull()), ["__source_file", "__row"])


DETAIL_EXCLUDE_PREFIXES = ("partial_urls_", "urls_", "stats_")


def compact_details(spark: SparkSession, kind_dir: str) -> DataFrame:
    """S4 (+A10): details CSVs of a kind (URL/stat CSVs excluded by name,
    case-insensitive) → full-row distinct. Files without a ``url`` column
    contribute nothing."""
    df = read_csv_any_header(spark, kind_dir, skip_prefixes=DETAIL_EXCLUDE_PREFIXES)
    ucol = next((c for c in df.columns if c.lower() == "url"), None)
    if ucol is None:
        raise LookupError(f"{kind_dir}: no details file has a url column")
    data_cols = [c for c in df.columns if c not in ("__source_file", "__row")]
    return df.where(F.col(ucol).isNotNull()).select(*data_cols).distinct()


def newest_file(spark: SparkSession, root: str, glob: str = "*", by: str = "path") -> DataFrame:
    """The newest artifact under ``root`` — by lexicographic path (dated
    directories) or by modification time; one row (empty when none)."""
    f = list_files(spark, root, glob)
    key = F.col("path") if by == "path" else F.struct("mtime", "path")
    return f.select(F.max_by("path", key).alias("path")).where(F.col("path").isNotNull())


def towns_seed(spark: SparkSession, path: str) -> DataFrame:
    """A seed CSV of towns; without a ``town`` column, headers are
    trimmed and the first column becomes ``town``."""
    df = spark.read.option("header", "true").csv(path)
    if "town" in df.columns:
        return df
    trimmed = [c.strip() for c in df.columns]
    df = df.toDF(*trimmed)
    return df.withColumnRenamed(trimmed[0], "town")


def crawl_frontier(towns: DataFrame, template: str, max_pages: int) -> DataFrame:
    """Town × page → search-page URL. ``max_pages`` 0 → 1 page, n > 0 →
    n pages, negative → 50. ``&page=`` when the URL already has a query,
    else ``?page=``."""
    n = 1 if max_pages == 0 else (max_pages if max_pages > 0 else 50)
    base = F.replace(F.lit(template), F.lit("{town}"), F.trim(F.col("town")))
    sep = F.when(base.contains("?"), F.lit("&page=")).otherwise(F.lit("?page="))
    return towns.select(F.trim("town").alias("town"), base.alias("base"),
                        F.explode(F.sequence(F.lit(1), F.lit(n))).alias("page")).select(
        "town", "page", F.concat("base", sep, F.col("page").cast("string")).alias("url"))


def load_input_urls(spark: SparkSession, csv_path: str | None, parquet_path: str | None
                    ) -> DataFrame:
    """URL list from a consolidated CSV (``url`` column, or the only
    column), else from Parquet by the same rule; NULLs dropped."""
    for fmt, p in (("csv", csv_path), ("parquet", parquet_path)):
        if not p:
            continue
        try:
            df = (csv_reader(spark).option("header", "true").csv(p) if fmt == "csv"
                  else spark.read.parquet(p))
        except AnalysisException as e:   # a missing source: try the next one
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        if "url" in df.columns:
            return df.select(F.col("url").cast("string")).dropna()
        if len(df.columns) == 1:
            return df.select(F.col(df.columns[0]).cast("string").alias("url")).dropna()
    raise FileNotFoundError(f"no URL list at {csv_path} or {parquet_path}")


def read_details(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A kind's details Parquet with a literal ``kind`` column."""
    df = spark.read.parquet(path).withColumn("kind", F.lit(kind))
    if df.isEmpty():
        raise ValueError(f"{path}: no {kind} rows")
    return df


def common_type(types: Sequence[DataType]) -> DataType:
    """Least type that holds all of ``types``: integers widen to the longest, with any fraction to double, dates with
    times to timestamp; everything else meets in text."""
    kinds = {t for t in types if not isinstance(t, NullType)}
    if len(kinds) <= 1:
        return kinds.pop() if kinds else StringType()
    whole = [ByteType(), ShortType(), IntegerType(), LongType()]
    if kinds <= set(whole):
        return max(kinds, key=whole.index)
    if all(isinstance(t, NumericType) for t in kinds):
        return DoubleType()
    if all(isinstance(t, (DateType, TimestampType, TimestampNTZType)) for t in kinds):
        return TimestampType() if TimestampType() in kinds else TimestampNTZType()
    return StringType()


def union_tolerant(inputs: Sequence[DataFrame | Callable[[], DataFrame] | None]) -> DataFrame:
    """Schema-tolerant union all by name (upper and lower case are one name). Inputs are frames or functions that
    read one; those that are None or fail are left out, and if none is left the last failure is raised. Columns that some
    inputs lack are NULL there; a column of different types gets the least common one before the union."""
    frames, failure = [], None
    for f in inputs:
        try:
            df = f() if callable(f) else f
            if df is not None:
                df.schema  # noqa: B018 - a path or footer that cannot be read fails here
                frames.append(df)
        except (PySparkException, Py4JJavaError, OSError) as e:
            failure = e
    if not frames:
        raise FileNotFoundError("union of no frames") from failure
    names, types = {}, {}
    for df in frames:
        for c in df.schema.fields:
            names.setdefault(c.name.lower(), c.name)
            types.setdefault(c.name.lower(), []).append(c.dataType)
    goal = {k: common_type(t) for k, t in types.items()}
    cast = lambda df: df.select(*[F.col(f"`{c}`").cast(goal[c.lower()]).alias(names[c.lower()]) for c in df.columns])
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(cast, frames))


def page_number_from_name(name) -> F.Column:
    """Page number of ``partial_urls_page_<page>_<town>_<run>.csv``."""
    return F.split_part(name, F.lit("_"), F.lit(4)).try_cast("int")


def duplicate_page_runs(pages: DataFrame, run: str, page: str, urls: str, stop_after: int | None = None) -> DataFrame:
    """Per run, pages in page order; ``dup_run`` counts how many pages in
    a row repeated the previous page's URL *set* (0 when it changed). With ``stop_after`` a run ends before its first
    page that is the ``stop_after``-th repeat in a row.

    ``pages`` holds one row per (run, page) with its URLs; their order and repeats do not matter. A run may have any number of
    pages: pages are range-partitioned by (run, page), counted within a partition, and what a partition's
    first pages continue comes from a scan over one summary row per partition and run."""
    spark = pages.sparkSession
    tasks = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    same = F.sha2(F.to_json(F.array_sort(F.array_distinct(urls))), 256)
    placed = pages.withColumn("_fp", F.coalesce(same, F.lit(""))).repartitionByRange(tasks, run, page, "_fp") \
        .sortWithinPartitions(run, page, "_fp").withColumn("_part", F.spark_partition_id())
    placed = cut_lineage(placed)
    w = Window.partitionBy("_part", run).orderBy(page, "_fp")
    d = placed.withColumn("_chg", F.coalesce(F.col("_fp") != F.lag("_fp").over(w), F.lit(True)).cast("int"))
    d = d.withColumn("_island", F.sum("_chg").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    d = d.withColumn("_at", F.row_number().over(Window.partitionBy("_part", run, "_island").orderBy(page, "_fp")) - 1)
    # one row per partition and run: the first and last set, the length of the last island, whether it is the only one
    seg = d.groupBy("_part", run).agg(F.min_by("_fp", "_island").alias("first"), F.max_by("_fp", "_island").alias("last"),
                                      F.max(F.struct("_island", "_at")).alias("tail"))
    along = Window.partitionBy(run).orderBy("_part")
    seg = seg.withColumn("joins", F.coalesce(F.col("first") == F.lag("last").over(along), F.lit(False)))
    chain = F.sum(F.when(F.col("joins") & (F.col("tail._island") == 1), 0).otherwise(1)).over(along)
    seg = seg.withColumn("chain", chain).withColumn("open", F.sum(F.col("tail._at") + 1).over(Window.partitionBy(run, "chain").orderBy("_part")))
    seg = seg.withColumn("carry", F.when(F.col("joins"), F.lag("open").over(along)).otherwise(0))
    r = seg.select(F.col("_part").alias("_p"), F.col(run).alias("_r"), "carry")
    d = d.join(F.broadcast(r), (F.col("_part") == F.col("_p")) & F.col(run).eqNullSafe(F.col("_r")))     # a row per partition and run
    d = d.withColumn("dup_run", (F.col("_at") + F.when(F.col("_island") == 1, F.col("carry")).otherwise(0)).cast("int"))
    d = d.select(*pages.columns, "dup_run")
    if stop_after is None:
        return d
    ends = d.where(F.col("dup_run") >= stop_after).groupBy(F.col(run).alias("_r")).agg(F.min(page).alias("_end"))
    d = d.join(ends, F.col(run).eqNullSafe(F.col("_r")), "left")
    return d.where(F.col("_end").isNull() | (F.col(page) < F.col("_end"))).select(*pages.columns, "dup_run")


def source_chain(lake, table: str, parquet_root: str, schema) -> DataFrame:
    """The history table when it exists, else the newest Parquet drop
    under ``parquet_root`` (by path), else an empty frame of ``schema``."""
    if lake.exists(table):
        return lake.read(table)
    spark = lake.spark
    try:
        newest = newest_file(spark, parquet_root, "*.parquet", by="path").first()
    except AnalysisException as e:   # no drops at all
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        newest = None
    if newest and newest["path"]:
        drop_dir = newest["path"].rsplit("/", 1)[0]
        return spark.read.parquet(drop_dir)
    return spark.createDataFrame([], schema)


def first_urls(df: DataFrame, n: int) -> DataFrame:
    """O2: the input cap — the first ``n`` URLs in URL order (a top-n sort:
    per-partition top-n, then one merge of n rows per partition)."""
    return df.where(F.col("url").isNotNull()).orderBy("url").limit(n)
