"""Chat formatting: tool-call linking (DataFrame functions only).

``link_calls`` joins calls and results by identifier, orders the calls of a
conversation topologically by the results they cite, validates arguments
against schemas and writes each call with its result as canonical JSON.

* Linking: hash join on (conv_id, call_id). Of several results for one call
  the earliest turn (then smallest text) stands. A result without a call is
  an ``orphan``; a call without a result is ``unanswered``.
* Order: an argument value ``$result:<call_id>`` cites a result. Level 0 calls
  cite nothing; each further level is found by joining the citations still open
  with the calls placed last, until nothing more can be placed. Only calls that
  are still open are written again. Calls on a cycle have a NULL level. The order of a conversation is (level, turn,
  call_id), three columns, so no conversation is ever collected into a task.
* Validation: required names present, no unknown names, values of the stated
  type (``string``, ``integer``, ``boolean``). ``errors`` lists the faults in
  code point order; an unknown tool is one fault.
* Canonical JSON: keys in code point order, no blanks, integers and booleans
  bare when the schema says so and the value is of that form.
* No row is lost: a linked row stands for its call and its result, every other
  input row leaves a row of its own with what it holds and a ``status``:
  ``repeated`` (a call whose conv_id and call_id an earlier one has),
  ``repeated_result`` (a result beside the one that stands), ``no_id`` (a call with a NULL conv_id or
  call_id; a result with one is an orphan), ``other`` (a turn of any other role). None of these is valid but
  orphans; ``errors`` names the status.

Cases: NULL text is the empty string, NULL ids never link (SQL equality); which of repeated calls stands: earliest
turn, then name, then arguments; rows that agree in all of it are interchangeable; citations of calls that do not
exist are listed as errors and do not hold the call back; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..session import shared_path
from .common import WORD, materialize

CITES = "$result:"


def quoted(s: Column) -> Column:
    """A JSON string literal."""
    j = F.to_json(F.array(s))
    return F.substring(j, F.lit(2), F.char_length(j) - 2)


def first_and_rest(df: DataFrame, keys: list[str], order: list[Column], name: str) -> tuple[DataFrame, DataFrame]:
    """(one row per key, the smallest by ``order``; all other rows). The first is found by a map-side combined aggregate, the
    others by rows' own numbers, so a key that most rows share stays spread. Keys are not NULL."""
    df = materialize(df.withColumn("_place", F.monotonically_increasing_id()), name)
    first = df.groupBy(*keys).agg(F.min_by("_place", F.struct(*order, "_place")).alias("_place")).select("_place")
    return df.join(first, "_place", "left_semi").drop("_place"), df.join(first, "_place", "left_anti").drop("_place")


def citations(args: Column) -> Column:
    """Call ids that argument values cite."""
    v = F.filter(F.map_values(args), lambda x: x.startswith(CITES))
    return F.array_distinct(F.transform(v, lambda x: F.substring(x, F.lit(len(CITES) + 1), F.char_length(x))))


def levels(calls: DataFrame) -> DataFrame:
    """conv_id, call_id, level (NULL on or behind a cycle), n_missing."""
    spark = calls.sparkSession
    key, cite = ["conv_id", "call_id"], ["conv_id", "cite"]
    ids = calls.select(*key)
    cited = calls.select(*key, F.explode(citations(F.col("args"))).alias("cite"))
    known = cited.join(ids.select("conv_id", F.col("call_id").alias("cite"), F.lit(True).alias("known")), cite, "left")
    known = materialize(known, "chat-citations")
    missing = known.where("known IS NULL").groupBy(*key).agg(F.count(F.lit(1)).alias("n_missing"))
    edges = known.where("known").select(*key, "cite")
    waits = materialize(edges.groupBy(*key).agg(F.count(F.lit(1)).alias("open")), "chat-open")
    # one folder per level; a level's calls are written once
    root = shared_path(spark, "chat-levels")
    ids.join(waits, key, "left_anti").write.parquet(f"{root}/level=0")
    step, schema = 0, ids.schema
    while True:
        last = spark.read.schema(schema).parquet(f"{root}/level={step}")
        met = edges.join(last.withColumnRenamed("call_id", "cite"), cite).groupBy(*key).agg(F.count(F.lit(1)).alias("met"))
        waits = materialize(waits.join(met, key, "left").select(*key, (F.col("open") - F.coalesce("met", F.lit(0))).alias("open")), "chat-open")
        if waits.where("open = 0").isEmpty():
            break
        step += 1
        waits.where("open = 0").select(*key).write.parquet(f"{root}/level={step}")
        waits = waits.where("open > 0")
    placed = spark.read.schema(StructType([*schema.fields, StructField("level", IntegerType())])).parquet(root)
    return ids.join(placed, key, "left").join(missing, key, "left").select(*key, "level", F.coalesce("n_missing", F.lit(0)).alias("n_missing"))


def _type_ok(kind: Column, value: Column) -> Column:
    return (F.when(kind == "integer", value.rlike(r"^-?(0|[1-9][0-9]*)$"))
            .when(kind == "boolean", value.isin("true", "false"))
            .otherwise(F.lit(True)))


def fault_list(args: Column, required: Column, types: Column) -> Column:
    """Sorted faults of one argument map against a schema."""
    names = F.map_keys(args)
    lacking = F.transform(F.array_except(required, names), lambda n: F.concat(F.lit("missing "), n))
    unknown = F.transform(F.array_except(names, F.map_keys(types)), lambda n: F.concat(F.lit("unknown "), n))
    wrong = F.transform(F.filter(names, lambda n: types[n].isNotNull() & ~_type_ok(types[n], args[n])),
                        lambda n: F.concat(F.lit("type "), n))
    return F.array_sort(F.concat(lacking, unknown, wrong))


def canonical_args(args: Column, types: Column) -> Column:
    def one(n):
        bare = types[n].isin("integer", "boolean") & _type_ok(types[n], args[n])
        return F.concat(quoted(n), F.lit(":"), F.when(bare, args[n]).otherwise(quoted(args[n])))
    names = F.array_sort(F.map_keys(args))
    return F.concat(F.lit("{"), F.array_join(F.transform(names, one), ","), F.lit("}"))


def _record(args: Column, call_id: Column, name: Column, result: Column) -> Column:
    null = F.lit("null")
    return F.concat(F.lit('{"arguments":'), F.coalesce(args, null), F.lit(',"id":'), F.coalesce(quoted(call_id), null),
                    F.lit(',"name":'), F.coalesce(quoted(name), null), F.lit(',"result":'), F.coalesce(quoted(result), null), F.lit("}"))


def _apart(df: DataFrame, status: str, args: Column, name: Column, result: Column, valid: bool = False) -> DataFrame:
    """Rows that take no part in linking, each by itself."""
    return df.select("conv_id", "call_id", F.lit(None).cast("int").alias("level"), "turn", F.lit(status).alias("status"),
                     F.lit(valid).alias("valid"), F.lit("" if valid else status).alias("errors"),
                     _record(args, F.col("call_id"), name, result).alias("json"))


def link_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame, others: DataFrame | None = None) -> DataFrame:
    """One row per call, with its result; one per result that does not stand with a call; one per row of ``others``.

    ``calls``: conv_id, call_id, turn, name, args (map of strings);
    ``results`` and ``others``: conv_id, call_id, turn, content;
    ``schemas``: name, required (array), types (map); one row per tool.
    """
    key, known, unknown = ["conv_id", "call_id"], "conv_id IS NOT NULL AND call_id IS NOT NULL", "conv_id IS NULL OR call_id IS NULL"
    nothing, plain = F.lit(None).cast("string"), F.create_map().cast("map<string,string>")
    schemas = schemas.select("name", "required", "types", F.lit(True).alias("has_schema"))
    calls = calls.select(*key, "turn", "name", F.transform_values("args", lambda k, v: F.coalesce(v, F.lit(""))).alias("args"))
    content = lambda df: df.select(*key, "turn", F.coalesce("content", F.lit("")).alias("content"))
    results = content(results)
    # maps cannot be compared, so their sorted entries break ties
    first, again = first_and_rest(calls.where(known), key, [F.col("turn"), F.col("name"), F.array_sort(F.map_entries("args"))], "chat-calls")
    first = materialize(first, "chat-first")
    answer, more = first_and_rest(results.where(known), key, [F.col("turn"), F.col("content")], "chat-results")
    out = (first.join(levels(first), key).join(schemas, "name", "left")
           .join(answer.withColumnRenamed("turn", "result_turn"), key, "full"))
    types = F.coalesce("types", plain)
    faults = F.when(F.col("has_schema"), fault_list(F.col("args"), F.col("required"), types)) \
        .when(F.col("name").isNotNull(), F.array(F.lit("unknown tool"))).otherwise(F.array().cast("array<string>"))
    faults = F.when(F.col("n_missing") > 0, F.concat(faults, F.array(F.lit("uncited result")))).otherwise(faults)
    status = (F.when(F.col("turn").isNull() & F.col("name").isNull(), "orphan")
              .when(F.col("content").isNull(), "unanswered").otherwise("linked"))
    out = out.select(*key, "level", F.coalesce("turn", "result_turn").alias("turn"),
                     status.alias("status"), (F.size(faults) == 0).alias("valid"), F.array_join(faults, ",").alias("errors"),
                     _record(canonical_args(F.col("args"), types), F.col("call_id"), F.col("name"), F.col("content")).alias("json"))
    typed = lambda df: df.join(schemas, "name", "left")
    for rows, kind in ((again, "repeated"), (calls.where(unknown), "no_id")):
        out = out.unionByName(_apart(typed(rows), kind, canonical_args(F.col("args"), types), F.col("name"), nothing))
    out = out.unionByName(_apart(more, "repeated_result", nothing, nothing, F.col("content")))
    out = out.unionByName(_apart(results.where(unknown), "orphan", nothing, nothing, F.col("content"), valid=True))
    return out if others is None else out.unionByName(_apart(content(others), "other", nothing, nothing, F.col("content")))


def _schema(name: str, required: list[str], types: dict[str, str]) -> Column:
    return F.struct(F.lit(name).alias("name"), F.array(*[F.lit(r) for r in required]).alias("required"),
                    F.create_map(*[F.lit(x) for kv in types.items() for x in kv]).alias("types"))


def chat_tables(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Calls, results, schemas and other turns read off a plain transcript: a system turn is
    a call of ``configure``, a user turn a call of ``answer`` that cites the
    conversation's opening call, an assistant turn the result of the call one turn before, a turn of any other role
    neither."""
    spark: SparkSession = conversations.sparkSession
    c = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    cid = lambda t: F.concat(F.col("conv_id").cast("string"), F.lit("-"), t.cast("string"))
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("string")
    base = [F.lit("text"), F.col("text"), F.lit("turn"), F.col("turn").cast("string"), F.lit("words"), words]
    opening = [F.lit("context"), F.coalesce(F.concat(F.lit(CITES), cid(F.lit(0))), F.lit(""))]
    args = (F.when(F.col("role") == "system", F.create_map(*base))
            .when(F.col("turn") == 0, F.create_map(*base)).otherwise(F.create_map(*base, *opening)))
    calls = c.where(F.col("role").isin("system", "user")).select(
        "conv_id", cid(F.col("turn")).alias("call_id"), "turn",
        F.when(F.col("role") == "system", "configure").otherwise("answer").alias("name"), args.alias("args"))
    results = c.where("role = 'assistant'").select("conv_id", cid(F.col("turn") - 1).alias("call_id"), "turn",
                                                   F.col("text").alias("content"))
    others = c.where("role IS NULL OR role NOT IN ('system', 'user', 'assistant')").select(
        "conv_id", F.lit(None).cast("string").alias("call_id"), "turn", F.col("text").alias("content"))
    schemas = spark.range(1).select(F.inline(F.array(
        _schema("configure", ["text"], {"text": "string", "turn": "integer"}),
        _schema("answer", ["text", "turn"],
                {"text": "string", "turn": "integer", "words": "integer", "context": "string"}))))
    return calls, results, schemas, others


def format_chat(conversations: DataFrame) -> DataFrame:
    return link_calls(*chat_tables(conversations))
