"""Queries, each with its SQL oracle, for operators that would otherwise only run inside others, on inputs that reach
their branches (NULLs, aliases, spec maps, ranges, empty columns), and page queries over pages with listing markup.

The marked pages are the rows of ``pages`` whose id is a listing's, with a rendered head (heading, prices, links, spec
table, definition list, list items, ``h4`` fields) put before the page's own html.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import flags
from ..operators import categories, guards, market, ml, resolve, training
from ..session import shared_path
from ..sources import elements, files, pages, tpch
from ..sources.tables import Lake, write_csv
from .catalog import _events_pages, _metric_round, query, r4, round_doubles
from .oracle import EV_PAGES, LISTING_CTE, oracle, with_ctes
from .oracle import r4 as sql_r4


def register(name: str, sql: str):
    """A query and its oracle."""
    oracle(name, with_ctes(LISTING_CTE, sql))
    return query(name)


def _k(n: int):
    return F.col("listing_id") % n


# ------------------------------------------------------------------ sources and tables
@register("S7_input_urls", "SELECT url FROM listing WHERE listing_id % 3 = 0 UNION ALL SELECT url FROM listing WHERE listing_id % 3 = 1")
def s7(spark, sf_dir):
    lst = tpch.listing(spark, sf_dir)
    csv, parquet = shared_path(spark, "urls-csv"), shared_path(spark, "urls-parquet")
    write_csv(lst.where(_k(3) == 0).select("listing_id", "url"), csv)
    # the only column, whatever its name; the CSV is missing
    lst.where(_k(3) == 1).select(F.col("url").alias("found")).write.parquet(parquet)
    return files.load_input_urls(spark, csv, None).unionByName(files.load_input_urls(spark, csv + "-absent", parquet))


@register("S9_table_scan", "SELECT listing_id, url, price FROM listing")
def s9(spark, sf_dir):
    lake = Lake(spark, shared_path(spark, "lake"))
    lake.replace("t", tpch.listing(spark, sf_dir).select("listing_id", "url", "price"))
    return lake.read("t")


@register("S13_append", "SELECT listing_id, url FROM listing UNION ALL SELECT listing_id, url FROM listing WHERE listing_id % 2 = 0")
def s13(spark, sf_dir):
    lake = Lake(spark, shared_path(spark, "lake"))
    rows = tpch.listing(spark, sf_dir).select("listing_id", "url")
    lake.append("t", rows)
    lake.append("t", rows.where(_k(2) == 0))
    return lake.read("t")


@register("S14_create_if_absent", """SELECT 'empty' AS step, 0 AS n
UNION ALL SELECT 'kept', count(*) FROM listing UNION ALL SELECT 'clone', 0""")
def s14(spark, sf_dir):
    lake = Lake(spark, shared_path(spark, "lake"))
    rows = tpch.listing(spark, sf_dir).select("listing_id", "url")
    step = lambda name, df: df.agg(F.lit(name).alias("step"), F.count(F.lit(1)).alias("n"))
    lake.ensure("t", rows.schema)
    first = spark.createDataFrame(step("empty", lake.read("t")).collect(), "step string, n long")
    lake.append("t", rows)
    lake.ensure("t", rows.schema)           # exists: left as it is
    lake.ensure("clone", lake.read("t").limit(0).schema)
    return first.unionByName(step("kept", lake.read("t"))).unionByName(step("clone", lake.read("clone")))


# ----------------------------------------------------------------- schema reconciliation
@register("P1_alias_resolver", "SELECT listing_id, city AS a, postal_code AS b, price AS c, url AS d FROM listing")
def p1(spark, sf_dir):
    df = tpch.listing(spark, sf_dir).select("listing_id", F.col("price").alias("Vraagprijs (EUR)"), F.col("url").alias("x_link"),
                                            F.col("city").alias(" Gemeente "), F.col("postal_code").alias("my_ZIP_code"))
    pick = {"a": (["city", "gemeente"], []), "b": (["zip"], ["postal", "zip"]), "c": (["price"], ["price", "prijs"]),
            "d": (["url"], ["url", "link", "href"])}
    return df.select("listing_id", *[F.col(f"`{resolve.resolve_column(df.columns, *v)}`").alias(k) for k, v in pick.items()])


_DUTCH = {"url": "Link", "title": "Headline", "description": "Omschrijving", "price": "Vraagprijs", "city": "Gemeente",
          "postal_code": "Postcode", "property_type": "Typology", "bedrooms": "Aantal slaapkamers",
          "bathrooms": "Badkamers", "surface_m2": "Bewoonbare oppervlakte", "year_built": "Bouwjaar", "energy_label": "PEB waarde"}


@register("P2_alias_dictionary", """SELECT listing_id, url, title, 'text ' || listing_id AS description, price, city, postal_code,
property_type, bedrooms, bathrooms, surface_m2, year_built, energy_label FROM listing""")
def p2(spark, sf_dir):
    lst = tpch.listing(spark, sf_dir).withColumn("description", F.concat(F.lit("text "), F.col("listing_id").cast("string")))
    df = lst.select("listing_id", *[F.col(c).alias(n) for c, n in _DUTCH.items()])
    return df.select("listing_id", *[F.col(f"`{resolve.resolve_field(df, f)}`").alias(f) for f in vocab.ALIASES])


@register("P5_required_columns", """SELECT url, DATE '2024-05-01' AS snapshot_date, CAST(NULL AS VARCHAR) AS city,
CAST(NULL AS VARCHAR) AS title, is_rent, CAST(NULL AS DOUBLE) AS surface_m2 FROM listing""")
def p5(spark, sf_dir):
    df = market.prepare_rebuild(tpch.listing(spark, sf_dir).select("url", "price"), run_date="2024-05-01")
    return df.select("url", "snapshot_date", "city", "title", "is_rent", "surface_m2")


@register("P6_fixed_projection", """SELECT snapshot_date, url, title, city, postal_code, region, property_type, price, surface_m2,
bedrooms, bathrooms, year_built, energy_label, price_per_m2, CAST(NULL AS INT) AS absent FROM listing""")
def p6(spark, sf_dir):
    return resolve.select_fixed(tpch.listing(spark, sf_dir), vocab.LISTING_TABLE_COLUMNS + ["absent"], {"absent": "int"})


@register("P7_numeric_coercion", """SELECT listing_id, CASE listing_id % 5 WHEN 0 THEN CAST(listing_id AS DOUBLE)
WHEN 2 THEN listing_id + 0.5 WHEN 4 THEN -CAST(listing_id AS DOUBLE) END AS x, CAST(bedrooms AS DOUBLE) AS bedrooms FROM listing""")
def p7(spark, sf_dir):
    k = F.col("listing_id").cast("string")
    text = (F.when(_k(5) == 0, F.concat(F.lit(" "), k)).when(_k(5) == 1, F.lit("n/a")).when(_k(5) == 2, F.concat(k, F.lit(".5")))
            .when(_k(5) == 3, F.concat(k, F.lit("d"))).otherwise(F.concat(F.lit("-"), k)))
    df = tpch.listing(spark, sf_dir).select("listing_id", text.alias("x"), "bedrooms")
    return resolve.coerce_numeric(df, ["x", "bedrooms", "absent"])


@register("P9_guarded_price_per_m2", f"""SELECT listing_id, CASE WHEN listing_id % 4 = 3 THEN {sql_r4('price / 50')} END AS ppm2
FROM listing""")
def p9(spark, sf_dir):
    s = F.when(_k(4) == 0, 0.0).when(_k(4) == 1, -5.0).when(_k(4) == 3, 50.0)
    return tpch.listing(spark, sf_dir).select("listing_id", r4(market.price_per_m2("price", s)).alias("ppm2"))


@register("P11_fill_zero", """SELECT listing_id, CASE WHEN listing_id % 3 = 0 THEN 0 ELSE bedrooms END AS bedrooms,
CASE WHEN listing_id % 5 = 0 THEN 0 ELSE bathrooms END AS bathrooms, surface_m2 FROM listing""")
def p11(spark, sf_dir):
    return resolve.fill_zero(tpch.listing(spark, sf_dir).select(
        "listing_id", F.when(_k(3) != 0, F.col("bedrooms")).alias("bedrooms"),
        F.when(_k(5) != 0, F.col("bathrooms")).alias("bathrooms"), "surface_m2"))


@register("P12_search_blob", "SELECT listing_id, concat_ws(' ', title, city, property_type) AS blob FROM listing")
def p12(spark, sf_dir):
    df = tpch.listing(spark, sf_dir).select("listing_id", "title", "price", "city", "property_type")
    return df.select("listing_id", resolve.string_blob(df).alias("blob"))


# --------------------------------------------------------------------------- predicates
@register("F1_drop_missing", "SELECT listing_id, price FROM listing WHERE listing_id % 5 <> 0 AND surface_m2 IS NOT NULL")
def f1(spark, sf_dir):
    df = tpch.listing(spark, sf_dir).withColumn("price", F.when(_k(5) != 0, F.col("price")))
    return market.drop_missing(df, ["price", "surface_m2"]).select("listing_id", "price")


@register("F7_non_null_target", """SELECT listing_id, 'per m2' AS target FROM listing WHERE price_per_m2 IS NOT NULL
UNION ALL SELECT listing_id, 'price' FROM listing WHERE listing_id % 4 <> 0""")
def f7(spark, sf_dir):
    lst = tpch.listing(spark, sf_dir)
    a = guards.quantile_trim(lst, mode="none").select("listing_id", F.lit("per m2").alias("target"))
    no_area = lst.select("listing_id", F.when(_k(4) != 0, F.col("price")).alias("price"),
                         F.lit(None).cast("double").alias("price_per_m2"))
    return a.unionByName(guards.quantile_trim(no_area, mode="none").select("listing_id", F.lit("price").alias("target")))


@register("F9_kind_predicate", """SELECT listing_id, listing_id % 4 < 3 AS apartment, listing_id % 4 = 3 AS house FROM listing""")
def f9(spark, sf_dir):
    tail = F.element_at(F.array(F.lit("/Apartment/1"), F.lit("/apartment?x=1"), F.lit("?t=apartment&p=2"), F.lit("/house/1")),
                        (_k(4) + 1).cast("int"))
    url = F.concat(F.lit("https://x.example"), tail)
    return tpch.listing(spark, sf_dir).select("listing_id", files.looks_like_kind(url, "apartments").alias("apartment"),
                                              files.looks_like_kind(url, "houses").alias("house"))


@register("J4_conditional_rescale", f"""SELECT listing_id, {sql_r4('price / 1000 * 1000')} AS scaled, {sql_r4('price')} AS kept
FROM listing""")
def j4(spark, sf_dir):
    lst = tpch.listing(spark, sf_dir).select("listing_id", (F.col("price") / 1000).alias("scaled"), F.col("price").alias("kept"))
    return round_doubles(guards.unit_guard_v1(guards.unit_guard_v1(lst, "scaled"), "kept"))


@register("A16_any_non_null", """SELECT count(surface_m2) > 0 AS surface, false AS nothing FROM listing""")
def a16(spark, sf_dir):
    df = tpch.listing(spark, sf_dir).withColumn("nothing", F.when(F.col("listing_id") < 0, 1))
    return df.agg(F.count(F.lit(1))).select(guards.any_non_null(df, "surface_m2").alias("surface"),
                                            guards.any_non_null(df, "nothing").alias("nothing"))


@register("A17_best_model", """SELECT arg_min(model, rmse) AS best FROM (
SELECT city AS model, avg(price) AS rmse FROM listing GROUP BY city)""")
def a17(spark, sf_dir):
    scores = tpch.listing(spark, sf_dir).groupBy(F.col("city").alias("model")).agg(F.avg("price").alias("rmse"))
    return ml.best_model(scores)


# --------------------------------------------------------------------------- extraction
@register("X14_surface_backfill", """SELECT listing_id, CASE listing_id % 6 WHEN 0 THEN 85.0 + listing_id % 10 WHEN 1 THEN 40.0 + listing_id % 50
WHEN 2 THEN 120.5 WHEN 3 THEN 95.0 WHEN 4 THEN 77.0 END AS surface FROM listing""")
def x14(spark, sf_dir):
    n = lambda e: e.cast("string")
    specs = (F.when(_k(6) == 1, F.create_map(F.lit("Bedrooms"), F.lit("3"), F.lit("Living-Area:"), n(40 + _k(50))))
             .when(_k(6) == 2, F.create_map(F.lit("Woonopp."), F.lit("120,5"))))
    df = tpch.listing(spark, sf_dir).select(
        "listing_id", F.when(_k(6) == 0, n(85 + _k(10))).when(_k(6) == 1, F.lit("4")).alias("surface_m2"), specs.alias("specs"),
        F.when(_k(6) == 3, "Loft of 85 - 95 m² near the park").when(_k(6) == 4, "77m2").when(_k(6) == 5, "no area").alias("description"))
    return df.select("listing_id", training.surface_backfill(df).alias("surface"))


@register("X27_label_number", """SELECT listing_id, CASE WHEN listing_id % 4 <> 3 THEN CAST(bedrooms AS DOUBLE) END AS bedrooms FROM listing""")
def x27(spark, sf_dir):
    pair = lambda a, b, i: F.struct(F.lit(a).alias("label"), b.alias("value"), F.lit(i).alias("ord"))
    b = F.col("bedrooms").cast("string")
    pairs = (F.when(_k(4) == 0, F.array(pair("area", F.lit("90"), 0), pair("slaapkamers", F.concat(b, F.lit(" kamers")), 1)))
             .when(_k(4) == 1, F.array(pair("bedrooms", F.lit("none"), 0), pair("chambres", b, 1)))
             .when(_k(4) == 2, F.array(pair("bedrooms", b, 0), pair("bedrooms", F.lit("99"), 1)))
             .otherwise(F.array(pair("bathrooms", b, 0))))
    labels = F.array(*[flags.normalize_label(F.lit(x)) for x in vocab.BEDROOM_LABELS])
    return tpch.listing(spark, sf_dir).select("listing_id", flags.label_lookup_number(pairs, labels).alias("bedrooms"))


# -------------------------------------------------------------------------------- pages
def marked_pages(spark, sf_dir) -> DataFrame:
    s = lambda c: F.col(c).cast("string")
    p = F.floor("price").cast("string")
    area = F.floor("surface_m2").cast("string")
    head = F.concat(
        F.lit("<h1>"), F.coalesce("title", F.lit("")), F.lit('</h1><div class="detail__header_title_main">House for sale</div>'),
        F.lit('<div class="detail__header_price_data">EUR '), p, F.lit('</div><div class="detail__header_address">Main street '),
        s("postal_code"), F.lit(" "), s("city"), F.lit('</div><a href="/en/detail/house/for-sale/'), s("postal_code"), F.lit("/"),
        s("listing_id"), F.lit('?x=1">d</a><a href="#top">t</a><a href="/classified/search?q">s</a><a href=\'/classified/'),
        s("listing_id"), F.lit("'>c</a><table>"),
        F.coalesce(F.concat(F.lit("<tr><th>Living area:</th><td>"), area, F.lit(" m²</td></tr>")), F.lit("")),
        F.lit("<tr><td>Bedrooms<td>"), s("bedrooms"), F.lit("</table><dl><dt>Construction year<dd>"), s("year_built"),
        F.lit("</dl><dl><dt>City</dt><dd>"), s("city"), F.lit("</dd></dl><ul><li>Energy label: "), s("energy_label"),
        F.lit("<li>Postal code : "), s("postal_code"), F.lit("<li>Bathrooms: "), s("bathrooms"),
        F.lit("</ul><h4>Number of bedrooms</h4> <p>"), s("bedrooms"), F.lit("</p><h4>Livable surface</h4><p>"),
        F.coalesce(F.concat(area, F.lit(" m²")), F.lit("")), F.lit("</p><h4>Build Year</h4>\n<p><b>"), s("year_built"), F.lit("</b></p>"))
    own = tpch.table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("own"))
    lst = tpch.listing(spark, sf_dir)
    return own.join(lst, F.col("page_id") == F.col("listing_id")).select("page_id", "url", F.concat(head, "own").alias("html"))


_MARKED = "listing JOIN pages p ON p.page_id = listing_id"


@register("H1_marked_listing_links", f"""SELECT page_id, 'https://www.example.be/en/detail/house/for-sale/' || postal_code || '/' || listing_id AS url
FROM {_MARKED} UNION ALL SELECT page_id, 'https://www.example.be/classified/' || listing_id FROM {_MARKED}""")
def h1m(spark, sf_dir):
    return pages.outlinks(marked_pages(spark, sf_dir), base="https://www.example.be")


@register("F10_link_lists", f"""SELECT page_id, 'https://www.example.be/classified/' || listing_id AS url FROM {_MARKED}
UNION ALL SELECT page_id, 'https://www.example.be/classified/search' FROM {_MARKED}""")
def f10(spark, sf_dir):
    return pages.outlinks(marked_pages(spark, sf_dir), include=["/classified/"], exclude=["/detail/"], base="https://www.example.be")


@register("H2_marked_label_pairs", f"""SELECT page_id, 'living area' AS label, floor(surface_m2)::BIGINT || ' m²' AS value FROM {_MARKED} WHERE surface_m2 IS NOT NULL
UNION ALL SELECT page_id, 'bedrooms', bedrooms::VARCHAR FROM {_MARKED} UNION ALL SELECT page_id, 'construction year', year_built::VARCHAR FROM {_MARKED}
UNION ALL SELECT page_id, 'city', city FROM {_MARKED} UNION ALL SELECT page_id, 'energy label', energy_label FROM {_MARKED}
UNION ALL SELECT page_id, 'postal code', postal_code FROM {_MARKED} UNION ALL SELECT page_id, 'bathrooms', bathrooms::VARCHAR FROM {_MARKED}""")
def h2m(spark, sf_dir):
    return pages.label_pairs(marked_pages(spark, sf_dir)).select("page_id", "label", "value")


@register("H4_marked_listing_records", f"""SELECT page_id, DATE '2025-01-01' AS snapshot_date, listing.url, coalesce(title, '') AS title, city, postal_code,
split_part(listing.url, '/', 6) AS property_type, NOT is_rent AS is_sale, CAST(floor(price) AS DOUBLE) AS price, surface_m2, bedrooms, bathrooms,
year_built, energy_label FROM {_MARKED}""")
def h4m(spark, sf_dir):
    return pages.listing_records(marked_pages(spark, sf_dir), run_date="2025-01-01")


@register("H3_marked_price_text", f"""SELECT page_id, 'EUR ' || floor(price)::BIGINT AS price_text FROM {_MARKED}""")
def h3m(spark, sf_dir):
    page = elements.page_elements(marked_pages(spark, sf_dir), classes=("price", "value"))
    return page.select("page_id", pages.price_text(F.col("texts"), F.col("marked")).alias("price_text"))


@register("H5_marked_legacy_records", f"""SELECT page_id, listing.url, 'House' AS property_type, 'EUR ' || floor(price)::BIGINT AS price,
'Main street ' || postal_code || ' ' || city AS address, postal_code, list_last(string_split(city, ' ')) AS city, bedrooms::VARCHAR AS bedrooms,
coalesce(floor(surface_m2)::BIGINT || ' m²', '') AS surface_livable, year_built::VARCHAR AS year_built, CAST(NULL AS VARCHAR) AS toilets FROM {_MARKED}""")
def h5m(spark, sf_dir):
    df = pages.legacy_records(marked_pages(spark, sf_dir))
    return df.select("page_id", "url", "property_type", "price", "address", "postal_code", "city", "bedrooms", "surface_livable",
                     "year_built", "toilets")


# ------------------------------------------------------------------------------- models
@register("M2_preprocessed_numerics", f"""SELECT listing_id, {sql_r4('(coalesce(surface_m2, m) - avg(coalesce(surface_m2, m)) OVER ()) / stddev_samp(coalesce(surface_m2, m)) OVER ()')} AS surface,
{sql_r4('(bedrooms - avg(bedrooms) OVER ()) / stddev_samp(bedrooms) OVER ()')} AS bedrooms
FROM listing, (SELECT median(surface_m2) AS m FROM listing)""")
def m2(spark, sf_dir):
    lst = tpch.listing(spark, sf_dir)
    model = Pipeline(stages=ml.preprocessing_stages(lst, ["surface_m2", "bedrooms"], [])).fit(lst)
    v = vector_to_array("features")
    return model.transform(lst).select("listing_id", r4(v[0]).alias("surface"), r4(v[1]).alias("bedrooms"))


@register("M7_model_registry", "SELECT 'price' AS target, 2 AS n_versions, false AS latest_is_log")
def m7(spark, sf_dir):
    lst = market.training_range(tpch.listing(spark, sf_dir))
    reg = ml.Registry(spark, shared_path(spark, "models"))
    model = ml.fit_model(lst, "price", "linear", ["surface_m2"], [], log_target=True)
    for is_log in (True, False):            # saved in the same second
        reg.save(model, "linear", "price", {}, is_log)
    m = reg.manifest().groupBy("target").agg(F.count_distinct("ts").cast("int").alias("n_versions"))
    return m.select("target", "n_versions", reg.latest("price").select("target_is_log").scalar().alias("latest_is_log"))


@register("M8_routed_linear_scoring", f"""SELECT listing_id AS request_id, CASE WHEN listing_id % 4 <> 0 AND surface_m2 IS NOT NULL THEN 'price' ELSE 'price_per_m2' END AS target,
{sql_r4('CASE WHEN listing_id % 4 <> 0 AND surface_m2 IS NOT NULL THEN a1 + b1 * bedrooms ELSE a2 + b2 * bedrooms END')} AS prediction
FROM listing, (SELECT regr_slope(price, bedrooms) AS b1, regr_intercept(price, bedrooms) AS a1, regr_slope(price_per_m2, bedrooms) AS b2,
regr_intercept(price_per_m2, bedrooms) AS a2 FROM listing WHERE surface_m2 BETWEEN 10 AND 1000)""")
def m8(spark, sf_dir):
    lst = tpch.listing(spark, sf_dir)
    train = market.training_range(lst)
    reg = ml.Registry(spark, shared_path(spark, "models"))
    for target in ("price", "price_per_m2"):
        reg.save(ml.fit_model(train, target, "linear", ["bedrooms"], [], log_target=False), "linear", target, {}, False)
    req = lst.select(F.col("listing_id").alias("request_id"), F.when(_k(4) != 0, F.col("surface_m2")).alias("surface_m2"), "bedrooms")
    return round_doubles(ml.auto_predict(resolve.scoring_rows(req), reg).select("request_id", "target", "prediction"))


oracle("W3_stop_after_repeats", with_ctes(EV_PAGES, """
SELECT run, page, dup_run FROM ed e WHERE NOT EXISTS (SELECT 1 FROM ed x WHERE x.run = e.run AND x.dup_run >= 10 AND x.page <= e.page)"""))


@query("W3_stop_after_repeats")
def w3s(spark, sf_dir):
    return files.duplicate_page_runs(_events_pages(spark, sf_dir), "run", "page", "urls", stop_after=10).select("run", "page", "dup_run")


@register("U1_least_common_types", """SELECT listing_id, CAST(CASE WHEN snapshot_date < DATE '1998-08-01' THEN floor(price) ELSE surface_m2 END AS DOUBLE) AS amount,
CASE WHEN snapshot_date < DATE '1998-08-01' THEN postal_code ELSE CAST(bedrooms AS VARCHAR) END AS code FROM listing""")
def u1t(spark, sf_dir):
    """Drops of one column as whole numbers and fractions, and as text and numbers; one drop cannot be read."""
    lst = tpch.listing(spark, sf_dir)
    old = lst.where("snapshot_date < DATE'1998-08-01'").select("listing_id", F.floor("price").cast("long").alias("amount"), F.col("postal_code").alias("Code"))
    new = lst.where("snapshot_date >= DATE'1998-08-01'").select("listing_id", F.col("surface_m2").alias("AMOUNT"), F.col("bedrooms").alias("code"))
    root = shared_path(spark, "typed-drops")
    old.write.parquet(f"{root}/a")
    new.write.parquet(f"{root}/b")
    read = lambda n: (lambda: spark.read.parquet(f"{root}/{n}"))
    return files.union_tolerant([read("a"), read("missing"), None, read("b")]).select("listing_id", "amount", F.col("code").alias("code"))


# -------------------------------------------------------------------------------- models
_CATS = ["postal_code", "city", "property_type", "energy_label", "region"]


@register("M2_category_indices", ", " + ", ".join(
    f"k_{c} AS (SELECT {c} AS v, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS i FROM listing WHERE {c} IS NOT NULL GROUP BY {c})" for c in _CATS)
    + " SELECT listing_id, " + ", ".join(f"(SELECT i FROM k_{c} WHERE v = coalesce(listing.{c}, (SELECT v FROM k_{c} WHERE i = 0))) AS {c}__i" for c in _CATS)
    + " FROM listing")
def m2c(spark, sf_dir):
    """Mode filling and category indices, the dictionary made and joined by Spark."""
    d = tpch.listing(spark, sf_dir).select("listing_id", *_CATS)
    out = categories.encode(d, _CATS, categories.category_index(d, _CATS))
    return out.select("listing_id", *[f"{c}__i" for c in _CATS])


def _all_features(spark, sf_dir):
    d = market.training_range(tpch.listing(spark, sf_dir))
    return d, *ml.select_feature_columns(d, "price")


@query("M4_linear_cv_all_features")
def m4a(spark, sf_dir):
    d, num, cat = _all_features(spark, sf_dir)
    return _metric_round(ml.cross_validate(d, "price", "linear", num, cat, k=5, key="listing_id"))


@query("A14_linear_cv_all_features")
def a14a(spark, sf_dir):
    d, num, cat = _all_features(spark, sf_dir)
    return _metric_round(ml.mean_metrics(ml.cross_validate(d, "price", "linear", num, cat, k=5, key="listing_id")))


@query("M5_linear_holdout_all_features")
def m5a(spark, sf_dir):
    d, num, cat = _all_features(spark, sf_dir)
    return _metric_round(ml.holdout(d, "price", "linear", num, cat, key="listing_id"))
