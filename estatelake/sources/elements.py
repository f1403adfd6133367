"""Page elements as intervals, without a parser: tags become rows of
(page, place), running depths pair them, and an element is the interval from its
tag to the tag that ends it. Text and containment are then array and interval
questions. Spark expressions only; one shuffle by page, in which a page's
tags stay together (a page is one row of the input, so its size is bounded by it).

* Rows, cells and items may lack their end tags, as HTML allows: within one
  table or list (told apart by the running depth of such scopes) an element
  ends at the next tag that ends its kind.
* Any other element ends at the end tag of the same name and depth; if there is
  none, at the next end tag of any name; if there is none either, with the page.

Cases: NULL html has no elements; comments, scripts and styles are dropped, an
unclosed one up to the end of the page; end tags without a start are passed over;
repeated page ids are pages of their own until something is grouped by page_id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab

# No part of these runs far past the next "<" in vain, so they take linear time on any text.
DROP = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b[^>]*+>.*?(?:</\1\s*>|\z)|<[!?][^>]*+>"
# A quoted value may hold tags, in up to 1,000 characters.
_TAG = r"""</?([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>"'=]++|=\s*+"[^"]{0,1000}+"|=\s*+'[^']{0,1000}+'|["'=])*+)>"""
TOKEN = _TAG + r"(?:[^<]|<(?![a-zA-Z/!?]))*+"
CLASS = r"""(?is)(?:^|\s)class\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
SCOPES = ["table", "ul", "ol", "dl"]
CELLS = ["td", "th"]
PART = 8 << 20      # bytes of html, and TAG for each tag, that one task pairs; its sorts take some twenty times that
TAG = 100


def decode_references(c: Column) -> Column:
    """Character references: the named ones of page text, and all numeric ones of the basic plane."""
    def numeric(c, pattern, base):
        found = F.array_distinct(F.regexp_extract_all(c, F.lit(rf"&#{pattern};"), 1))
        one = lambda n: F.decode(F.unhex(F.lpad(n if base == 16 else F.hex(n.cast("long")), 4, "0")), "UTF-16BE")
        mark = "&#x" if base == 16 else "&#"
        return F.when(c.contains("&#"), F.aggregate(found, c, lambda acc, n: F.replace(acc, F.concat(F.lit(mark), n, F.lit(";")), one(n)))).otherwise(c)

    c = numeric(numeric(c, "([0-9]{1,4})", 10), "x([0-9a-fA-F]{1,4})", 16)
    for name, ch in vocab.CHARACTER_REFERENCES:
        c = F.replace(c, F.lit(f"&{name};"), F.lit(ch))
    return c


def _tidy(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(decode_references(text), "   ", "   "), r"\s+", " "))


def _tasks(pages: DataFrame) -> int:
    """Tasks for the tags of ``pages``: as many as its size asks for, so a task's memory does not grow with the input."""
    html = F.coalesce("html", F.lit(""))
    tags = F.length(html) - F.length(F.replace(html, F.lit("<"), F.lit("")))
    size = pages.agg(F.sum(F.octet_length(html) + TAG * tags)).first()[0] or 0
    return max(1, -(-size // PART))


def tokens(pages: DataFrame) -> DataFrame:
    """_page (a number of its own), page_id, pos, name, closing, cls, text after the tag: one row per tag."""
    page = pages.select(F.monotonically_increasing_id().alias("_page"), "page_id",
                        F.regexp_replace(F.coalesce("html", F.lit("")), DROP, " ").alias("_html"))
    t = page.select("_page", "page_id", F.posexplode(F.regexp_extract_all("_html", F.lit(TOKEN), F.lit(0))).alias("pos", "_token"))
    attrs = F.regexp_extract("_token", _TAG, 2)
    cls = [F.nullif(F.regexp_extract("_attrs", CLASS, i), F.lit("")) for i in (1, 2, 3)]
    t = t.select("_page", "page_id", "pos", F.lower(F.regexp_extract("_token", _TAG, 1)).alias("name"),
                 F.col("_token").startswith("</").alias("closing"), attrs.alias("_attrs"),
                 _tidy(F.regexp_replace("_token", "^" + _TAG, "")).alias("text"))
    return t.withColumn("cls", F.when(~F.col("closing"), F.lower(F.coalesce(*cls, F.lit(""))))).drop("_attrs")


def _running_depth(t: DataFrame, keys: list[str], step: Column, out: str) -> DataFrame:
    """Depth after each tag; end tags without a start do not count."""
    w = Window.partitionBy(*keys).orderBy("pos")
    t = t.withColumn("_sum", F.sum(step).over(w))
    return t.withColumn(out, F.col("_sum") - F.least(F.lit(0), F.min("_sum").over(w))).drop("_sum")


def _next(keys: list[str], where: Column) -> Column:
    """Place of the next tag that meets a condition: the last one so far, read backwards."""
    w = Window.partitionBy(*keys).orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, -1)
    return F.last(F.when(where, F.col("pos")), ignorenulls=True).over(w)


def _listed(t: DataFrame) -> DataFrame:
    """Adds ``end`` and ``parent`` of cells, terms and items: parent is the open row of a cell, the dl of a term."""
    name, closing = F.col("name"), F.col("closing")
    scope = name.isin(SCOPES)
    t = _running_depth(t, ["_page"], F.when(scope, F.when(closing, -1).otherwise(1)).otherwise(0), "_depth")
    # a scope's own tags belong to its inside
    t = t.withColumn("_level", F.col("_depth") + F.when(scope & closing, 1).otherwise(0))
    level = ["_page", "_level"]
    earlier = Window.partitionBy(*level).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    opener = lambda what: F.last(F.when(scope | (name == what), F.struct("pos", ((name == what) & ~closing).alias("ok"))),
                                 ignorenulls=True).over(earlier)
    t = t.withColumns({"_row": opener("tr"), "_list": opener("dl"), "_cell_end": _next(level, scope | name.isin(*CELLS, "tr")),
                       "_item_end": _next(level, scope | (name == "li")), "_term_end": _next(level, scope | name.isin("dt", "dd"))})
    end = F.when(name.isin(CELLS), F.col("_cell_end")).when(name == "li", F.col("_item_end")).when(name.isin("dt", "dd"), F.col("_term_end"))
    parent = F.when(name.isin(CELLS) & F.col("_row.ok"), F.col("_row.pos")).when(name.isin("dt", "dd") & F.col("_list.ok"), F.col("_list.pos")) \
        .when(name == "li", F.col("pos"))
    return t.withColumns({"list_end": end, "parent": F.when(~closing, parent)}).drop(
        "_depth", "_level", "_row", "_list", "_cell_end", "_item_end", "_term_end")


def _paired(t: DataFrame) -> DataFrame:
    """Adds ``end`` of every element by its end tag."""
    closing = F.col("closing")
    t = _running_depth(t, ["_page", "name"], F.when(closing, -1).otherwise(1), "_depth")
    t = t.withColumn("_depth", F.col("_depth") + F.when(closing, 1).otherwise(0))
    t = t.withColumns({"_own": _next(["_page", "name", "_depth"], closing), "_any": _next(["_page"], closing)})
    return t.withColumn("end", F.coalesce("_own", "_any")).drop("_depth", "_own", "_any")


def page_elements(pages: DataFrame, classes: Sequence[str] = (), names: Sequence[str] = ()) -> DataFrame:
    """One row per page that has a tag: page_id, texts (after each tag, in order), listed (cells, terms and items) and
    marked (elements whose class contains one of ``classes`` or whose name is one of ``names``), both in document order."""
    t = tokens(pages).repartition(_tasks(pages), "_page")
    t = _listed(t)
    marked = F.lit(False)
    if classes or names:
        t = _paired(t)
        for c in classes:
            marked = marked | F.col("cls").contains(c)
        marked = ~F.col("closing") & (marked | F.col("name").isin(list(names)))
        mark = F.struct("pos", "end", "name", "cls")
    else:
        mark = F.struct("pos", F.lit(None).cast("int").alias("end"), "name", "cls")
    every = lambda cond, s: F.sort_array(F.collect_list(F.when(cond, s)))
    return t.groupBy("_page", "page_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]).alias("texts"),
        every(F.col("parent").isNotNull(), F.struct("pos", F.col("list_end").alias("end"), "name", "parent")).alias("listed"),
        every(marked, mark).alias("marked")).drop("_page")


def text_of(texts: Column, element: Column) -> Column:
    """Text inside an element, the parts joined by a blank."""
    n = F.coalesce(element["end"], F.size(texts)) - element["pos"]
    return F.array_join(F.filter(F.slice(texts, element["pos"] + 1, n), lambda s: s != ""), " ")


def label_value_pairs(elements: DataFrame) -> DataFrame:
    """page_id, label, value, ord: table rows (first and last cell), then dt / dd in pairs, then 'Label: Value' items, each in
    document order."""
    each = elements.select("page_id", "texts", F.explode("listed").alias("e"))
    each = each.select("page_id", "e.name", "e.parent", "e.pos", text_of(F.col("texts"), F.col("e")).alias("text"))
    place = lambda kind, at: (F.lit(kind).cast("long") * (1 << 40) + F.col(at)).alias("ord")
    cells = each.where(F.col("name").isin(CELLS)).groupBy("page_id", "parent").agg(
        F.count(F.lit(1)).alias("n"), F.min_by("text", "pos").alias("label"), F.max_by("text", "pos").alias("value"))
    rows = cells.where("n >= 2").select("page_id", "label", "value", place(0, "parent"))
    terms = each.where(F.col("name").isin("dt", "dd")).withColumn(
        "nth", F.row_number().over(Window.partitionBy("page_id", "parent", "name").orderBy("pos")))
    terms = terms.groupBy("page_id", "parent", "nth").agg(
        F.max(F.when(F.col("name") == "dt", F.col("text"))).alias("label"), F.max(F.when(F.col("name") == "dd", F.col("text"))).alias("value"),
        F.min("pos").alias("pos")).where("label IS NOT NULL AND value IS NOT NULL").select("page_id", "label", "value", place(1, "pos"))
    items = each.where((F.col("name") == "li") & F.col("text").contains(":")).select(
        "page_id", F.trim(F.substring_index("text", ":", 1)).alias("label"),
        F.trim(F.substr(F.col("text"), F.instr("text", ":") + 1)).alias("value"), place(2, "pos"))
    return rows.unionByName(terms).unionByName(items)
