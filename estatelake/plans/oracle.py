"""Independent SQL oracles (DuckDB dialect) for the registered queries.

Each oracle recomputes its query from the raw driver tables with its own SQL,
sharing only the fixed rendering rules of the derived ``listing`` view
(see ``sources/tpch.py``). Floating outputs are rounded to 4 decimals on
both sides, since summation order and quantile interpolation may differ in
the last bit between engines.
"""

from __future__ import annotations

LISTING_CTE = """
lb AS (
  SELECT o.o_orderkey AS k, o.o_custkey AS ck, o.o_totalprice AS tp, o.o_orderdate AS od,
         ['apartment','house','villa','residence'][c.c_custkey % 4 + 1] AS pt,
         (c.c_custkey % 5 = 0) AS rent,
         CAST(1000 + c.c_custkey % 9000 AS VARCHAR) AS pc,
         lower(n.n_name) AS ct, n.n_regionkey AS nr,
         CASE WHEN o.o_orderkey % 11 <> 0 THEN CAST(5 + (o.o_orderkey * 37) % 1100 AS DOUBLE) END AS sf
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
),
listing AS (
  SELECT k AS listing_id,
         CAST(od AS DATE) AS snapshot_date,
         'https://x.example/en/detail/' || pt || '/for-' || CASE WHEN rent THEN 'rent' ELSE 'sale' END
           || '/' || pc || '/' || ct || '/' || CAST(ck AS VARCHAR) AS url,
         CASE WHEN k % 17 <> 0 THEN pt || CASE WHEN rent THEN ' for rent in ' ELSE ' for sale in ' END || ct END AS title,
         ct AS city, pc AS postal_code, 'region_' || CAST(nr AS VARCHAR) AS region,
         CASE WHEN k % 13 <> 0 THEN pt END AS property_type,
         CAST(tp AS DOUBLE) AS price, sf AS surface_m2,
         CAST(k % 6 AS INTEGER) AS bedrooms, CAST(1 + k % 3 AS INTEGER) AS bathrooms,
         CAST(1900 + k % 125 AS INTEGER) AS year_built,
         ['A+','A','B','C','D','E','F','G'][k % 8 + 1] AS energy_label,
         CASE WHEN sf > 0 THEN tp / sf END AS price_per_m2,
         rent AS is_rent, NOT rent AS is_sale
  FROM lb
)"""

# Rebuild preparation of the listing (numeric pass-through, type inference
# where missing, rent flag where NULL, postal digits, guarded €/m²).
PREP_CTE = LISTING_CTE + """,
prep AS (
  SELECT listing_id, snapshot_date, url, title, city, region,
         regexp_extract(postal_code, '\\d+') AS postal_code,
         CASE WHEN price > 0 THEN price END AS price,
         CASE WHEN surface_m2 > 0 THEN surface_m2 END AS surface_m2,
         COALESCE(NULLIF(property_type, ''),
           CASE WHEN lower(COALESCE(url, '') || ' ' || COALESCE(title, '')) LIKE '%apartment%' THEN 'Apartment'
                WHEN lower(COALESCE(url, '') || ' ' || COALESCE(title, '')) LIKE '%residence%' THEN 'Residence'
                WHEN lower(COALESCE(url, '') || ' ' || COALESCE(title, '')) LIKE '%house%' THEN 'House'
                WHEN lower(COALESCE(url, '') || ' ' || COALESCE(title, '')) LIKE '%villa%' THEN 'Villa'
                ELSE 'Other' END) AS property_type,
         bedrooms, bathrooms, year_built, energy_label, is_rent, is_sale,
         CASE WHEN surface_m2 > 0 AND price > 0 THEN price / surface_m2 END AS price_per_m2
  FROM listing
),
cleaned AS (
  SELECT * FROM prep
  WHERE price IS NOT NULL AND surface_m2 IS NOT NULL AND surface_m2 BETWEEN 10 AND 1000
    AND (price_per_m2 IS NULL OR price_per_m2 BETWEEN 500 AND 50000)
)"""


def r4(expr: str) -> str:
    """Half-up rounding to 4 decimals with plain IEEE arithmetic."""
    return f"(floor(({expr}) * 10000.0 + 0.5) / 10000.0)"


def with_ctes(ctes: str, body: str) -> str:
    return "WITH " + ctes.strip() + "\n" + body.strip()


ORACLES: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = sql.strip()


oracle("A3_market_summary_v3", with_ctes(PREP_CTE, f"""
SELECT snapshot_date, city, property_type, count(url) AS n,
       {r4("median(price)")} AS median_price,
       {r4("median(price_per_m2)")} AS median_eur_m2
FROM cleaned GROUP BY snapshot_date, city, property_type
"""))

oracle("A1_market_summary_v1", with_ctes(LISTING_CTE + """,
norm AS (
  SELECT snapshot_date, city, postal_code, property_type,
         CAST(trunc(abs(price)) AS DOUBLE) AS price, surface_m2
  FROM listing
),
n2 AS (
  SELECT *, CASE WHEN surface_m2 > 0 THEN price / surface_m2 END AS price_per_m2
  FROM norm WHERE price IS NOT NULL
)""", f"""
SELECT snapshot_date, city, postal_code, property_type, count(*) AS n_listings,
       {r4("avg(price)")} AS avg_price, {r4("median(price)")} AS med_price,
       {r4("avg(price_per_m2)")} AS avg_ppm2
FROM n2 GROUP BY snapshot_date, city, postal_code, property_type
"""))

oracle("A2_market_summary_v2", with_ctes(LISTING_CTE, f"""
SELECT snapshot_date, city, property_type, count(*) AS n,
       {r4("median(price_per_m2)")} AS median_price_per_m2
FROM listing WHERE price_per_m2 IS NOT NULL
GROUP BY snapshot_date, city, property_type
"""))

oracle("A4_dashboard_summary_top500", with_ctes(PREP_CTE, f"""
SELECT snapshot_date, city, property_type, count(*) AS n,
       {r4("median(price)")} AS median_price, {r4("median(price_per_m2)")} AS median_eur_m2
FROM cleaned GROUP BY ALL
ORDER BY snapshot_date DESC NULLS LAST, n DESC, city ASC NULLS LAST, property_type ASC NULLS LAST
LIMIT 500
"""))

oracle("A5_sanity_counters", with_ctes(PREP_CTE, """
SELECT count(*) AS total_rows,
       count(*) FILTER (WHERE price IS NULL) AS missing_price,
       count(*) FILTER (WHERE surface_m2 IS NULL) AS missing_m2,
       count(*) FILTER (WHERE surface_m2 < 10 OR surface_m2 > 1000) AS bad_m2,
       count(*) FILTER (WHERE price_per_m2 < 500 OR price_per_m2 > 50000) AS bad_eur_m2,
       count(*) FILTER (WHERE price IS NOT NULL AND surface_m2 IS NOT NULL
                          AND surface_m2 BETWEEN 10 AND 1000
                          AND (price_per_m2 IS NULL OR price_per_m2 BETWEEN 500 AND 50000))
         AS kept_after_sanity
FROM prep
"""))

oracle("O1_latest_sample_top200", with_ctes(PREP_CTE, f"""
SELECT listing_id, snapshot_date, url, {r4("price")} AS price, {r4("surface_m2")} AS surface_m2,
       {r4("price_per_m2")} AS price_per_m2, property_type
FROM cleaned WHERE snapshot_date = (SELECT max(snapshot_date) FROM cleaned)
ORDER BY snapshot_date DESC, url ASC, listing_id ASC
LIMIT 200
"""))

oracle("J3_latest_snapshot_rows", with_ctes(PREP_CTE, """
SELECT listing_id, snapshot_date, url, city
FROM cleaned WHERE snapshot_date = (SELECT max(snapshot_date) FROM cleaned)
"""))

oracle("F2_plausible_rows", with_ctes(PREP_CTE, f"""
SELECT listing_id, snapshot_date, url, {r4("price")} AS price, {r4("surface_m2")} AS surface_m2,
       {r4("price_per_m2")} AS price_per_m2, property_type, postal_code
FROM cleaned
"""))

oracle("F3_clip_plausible_ranges", with_ctes(LISTING_CTE, """
SELECT listing_id,
       CASE WHEN price < 50000 THEN NULL ELSE price END AS price,
       CASE WHEN surface_m2 < 10 OR surface_m2 > 1000 THEN NULL ELSE surface_m2 END AS surface_m2
FROM listing
"""))

oracle("F5_training_range_filter", with_ctes(LISTING_CTE, """
SELECT listing_id, price, surface_m2 FROM listing
WHERE price IS NOT NULL AND surface_m2 IS NOT NULL AND surface_m2 BETWEEN 10 AND 1000
"""))

oracle("W1_keep_latest_per_url", with_ctes(LISTING_CTE, """
SELECT listing_id, url, snapshot_date, price FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY snapshot_date DESC NULLS LAST,
                                                        listing_id DESC) AS rn
  FROM listing WHERE url IS NOT NULL) WHERE rn = 1
"""))

oracle("W2_light_dedupe", with_ctes(PREP_CTE, """
SELECT listing_id, url, snapshot_date, city, postal_code, property_type, price, surface_m2 FROM (
  SELECT *, row_number() OVER (
      PARTITION BY url, snapshot_date, city, postal_code, property_type
      ORDER BY price DESC NULLS LAST, surface_m2 DESC NULLS LAST, listing_id DESC) AS rn
  FROM prep) WHERE rn = 1
"""))

oracle("A9_first_occurrence_by_url", with_ctes(LISTING_CTE, """
SELECT url, listing_id, snapshot_date FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY listing_id) AS rn
  FROM listing WHERE url IS NOT NULL) WHERE rn = 1
"""))

oracle("A10_distinct_rows", with_ctes(LISTING_CTE, """
SELECT DISTINCT url, city, postal_code, property_type FROM listing
"""))

oracle("J1_delete_matching_urls", with_ctes(LISTING_CTE, """
SELECT b.listing_id, b.url FROM listing b
WHERE b.snapshot_date < DATE '1998-08-01'
  AND NOT EXISTS (SELECT 1 FROM listing n WHERE n.snapshot_date >= DATE '1998-08-01' AND n.url = b.url)
"""))

oracle("J2_upsert_latest", with_ctes(LISTING_CTE + """,
base AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY snapshot_date DESC, listing_id DESC) rn
                 FROM listing WHERE snapshot_date < DATE '1998-08-01') WHERE rn = 1),
batch AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY snapshot_date DESC, listing_id DESC) rn
                 FROM listing WHERE snapshot_date >= DATE '1998-08-01') WHERE rn = 1)""", """
SELECT listing_id, url, snapshot_date, price FROM base
WHERE NOT EXISTS (SELECT 1 FROM batch WHERE batch.url = base.url)
UNION ALL
SELECT listing_id, url, snapshot_date, price FROM batch
"""))


# ---------------------------------------------------------------- parsers
RB_CTE = """
rb AS (
  SELECT o_orderkey AS k, CAST(floor(o_totalprice) AS BIGINT) AS P, o_orderkey % 100 AS C,
         5 + (o_orderkey * 37) % 1100 AS S, o_orderkey % 10 AS D, o_orderkey % 6 AS B,
         1900 + o_orderkey % 125 AS Y
  FROM orders
)"""


def th(n: str, sep: str) -> str:
    sep_sql = "chr(160)" if sep == "nbsp" else f"'{sep}'"
    return (f"(CASE WHEN {n} >= 1000 THEN CAST({n} // 1000 AS VARCHAR) || {sep_sql} || "
            f"lpad(CAST({n} % 1000 AS VARCHAR), 3, '0') ELSE CAST({n} AS VARCHAR) END)")


def pick(n: int, variants: list[str]) -> str:
    whens = " ".join(f"WHEN k % {n} = {i} THEN {v}" for i, v in enumerate(variants))
    return f"(CASE {whens} END)"


PRICE_TEXT = pick(6, [
    f"'€ ' || {th('P', '.')}",
    "'EUR ' || CAST(P AS VARCHAR)",
    f"{th('P', ' ')} || ' €'",
    f"'EUR ' || {th('P', ',')}",
    f"'€' || {th('P', '.')} || ',' || lpad(CAST(C AS VARCHAR), 2, '0')",
    f"{th('P', 'nbsp')} || ' EUR'",
])
SURFACE_TEXT = pick(5, [
    "CAST(S AS VARCHAR) || ' m²'",
    "CAST(S AS VARCHAR) || ',' || CAST(D AS VARCHAR) || ' m²'",
    "CAST(S AS VARCHAR) || '.' || CAST(D AS VARCHAR) || ' m2'",
    "CAST(S AS VARCHAR) || ' sqm'",
    f"{th('S', '.')} || ',' || CAST(D AS VARCHAR) || ' m²'",
])
SD = "((S * 10 + D) / 10.0)"


def rb_query(name: str, body: str) -> None:
    oracle(name, with_ctes(RB_CTE, body))


rb_query("X2_price_text_to_euros", f"SELECT k, {PRICE_TEXT} AS text, P AS value FROM rb")

rb_query("X4_price_from_free_text", f"""
SELECT k, 'Vraagprijs ' || {PRICE_TEXT} || ' (kosten koper)' AS text,
       CASE WHEN k % 6 IN (2, 5) THEN NULL ELSE P END AS value
FROM rb""")

_CUED_TEXT = (f"(CASE WHEN k % 8 < 6 THEN {PRICE_TEXT} WHEN k % 8 = 6 "
              f"THEN '€' || CAST(P // 1000 AS VARCHAR) || 'k' "
              f"ELSE 'about ' || CAST(P // 1000 AS VARCHAR) || ' k' END)")
_CUED_TRUTH = ("(CASE WHEN k % 8 >= 6 THEN CAST((P // 1000) * 1000 AS DOUBLE) "
               "WHEN k % 6 = 4 THEN (P * 100 + C) / 100.0 ELSE CAST(P AS DOUBLE) END)")
rb_query("X15_price_with_currency_cue", f"""
SELECT k, 'Vraagprijs ' || {_CUED_TEXT} || ' (kosten koper)' AS text, {r4(_CUED_TRUTH)} AS value
FROM rb""")

_PORTAL_TEXT = pick(6, [
    f"'€ ' || {th('P', '.')}",
    f"'EUR ' || {th('P', ',')}",
    f"{th('P', ' ')} || ' €'",
    "CAST(P // 1000 AS VARCHAR) || 'k'",
    "'€ ' || CAST(P // 100000 AS VARCHAR) || '.' || CAST((P // 10000) % 10 AS VARCHAR) || 'M'",
    f"'Prijs: ' || {th('P', '.')} || ' euro, ' || CAST(k % 5 + 1 AS VARCHAR) || ' slaapkamers'",
])
rb_query("X22_detail_page_price", f"""
SELECT k, {_PORTAL_TEXT} AS text,
       CASE WHEN k % 6 = 3 THEN (P // 1000) * 1000.0
            WHEN k % 6 = 4 THEN ((P // 100000) * 10 + (P // 10000) % 10) / 10.0 * 1000000.0
            ELSE CAST(P AS DOUBLE) END AS value
FROM rb""")

rb_query("X3_surface_text_to_m2", f"""
SELECT k, {SURFACE_TEXT} AS text,
       CASE WHEN k % 5 IN (1, 2, 4) THEN {SD} ELSE CAST(S AS DOUBLE) END AS value
FROM rb""")

rb_query("X5_surface_from_free_text", f"""
SELECT k, 'Living area ' || {SURFACE_TEXT} || ' with garden' AS text,
       CASE WHEN k % 5 = 3 THEN NULL
            WHEN k % 5 = 4 AND S >= 1000 THEN ((S % 1000) * 10 + D) / 10.0
            WHEN k % 5 IN (1, 2, 4) THEN {SD} ELSE CAST(S AS DOUBLE) END AS value
FROM rb""")

rb_query("X21_surface_with_ranges", f"""
SELECT k, {pick(5, [
    "CAST(S AS VARCHAR) || ' m²'",
    "CAST(S AS VARCHAR) || ',' || CAST(D AS VARCHAR) || ' m²'",
    f"{th('S', '.')} || ' m²'",
    "CAST(S AS VARCHAR) || '–' || CAST(S + 5 AS VARCHAR) || ' m²'",
    "CAST(S AS VARCHAR) || ' to ' || CAST(S + 10 AS VARCHAR) || ' m2'"])} AS text,
       CASE k % 5 WHEN 1 THEN {SD} WHEN 3 THEN (2 * S + 5) / 2.0 WHEN 4 THEN CAST(S + 5 AS DOUBLE)
            ELSE CAST(S AS DOUBLE) END AS value_mid,
       CASE k % 5 WHEN 1 THEN {SD} WHEN 3 THEN CAST(S + 5 AS DOUBLE) WHEN 4 THEN CAST(S + 10 AS DOUBLE)
            ELSE CAST(S AS DOUBLE) END AS value_max
FROM rb""")

rb_query("X13_number_or_range", f"""
SELECT k, {pick(4, ["CAST(S AS VARCHAR)", "CAST(S AS VARCHAR) || '–' || CAST(S + 5 AS VARCHAR)",
                    "CAST(S AS VARCHAR) || ',' || CAST(D AS VARCHAR)", th('S', ' ')])} AS text,
       CASE k % 4 WHEN 1 THEN (2 * S + 5) / 2.0 WHEN 2 THEN {SD} ELSE CAST(S AS DOUBLE) END AS value
FROM rb""")

rb_query("X6_rebuild_price_parser", f"""
SELECT k, {pick(4, [th('P', '.'),
                    f"'€ ' || {th('P', '.')} || ',' || lpad(CAST(C AS VARCHAR), 2, '0')",
                    "CAST(P AS VARCHAR)", "'n/a'"])} AS text,
       CASE k % 4 WHEN 1 THEN (P * 100 + C) / 100.0 WHEN 3 THEN NULL
            ELSE CAST(P AS DOUBLE) END AS value
FROM rb""")

rb_query("X7_rebuild_surface_parser", f"""
SELECT k, {pick(4, ["CAST(S AS VARCHAR) || ' m²'",
                    "CAST(S AS VARCHAR) || ',' || CAST(D AS VARCHAR) || 'm2'",
                    "CAST(S AS VARCHAR) || ' - ' || CAST(S + 10 AS VARCHAR)", "'unknown'"])} AS text,
       CASE k % 4 WHEN 1 THEN {SD} WHEN 3 THEN NULL ELSE CAST(S AS DOUBLE) END AS value
FROM rb""")

rb_query("X20_extract_all_numbers", f"""
SELECT k, 'Prijs € ' || {th('P', '.')} || ', ' || CAST(B AS VARCHAR) || ' slaapkamers, '
          || CAST(S AS VARCHAR) || ',' || CAST(D AS VARCHAR) || ' m², bouwjaar ' || CAST(Y AS VARCHAR) AS text,
       [CAST(P AS DOUBLE), CAST(B AS DOUBLE), {SD}, CAST(Y AS DOUBLE)] AS numbers
FROM rb""")


# ---------------------------------------------------------------- flags / urls
LST2_CTE = LISTING_CTE + """,
lst AS (
  SELECT *, CASE WHEN listing_id % 9 = 0 THEN replace(url, '/detail/', '/info/')
                 WHEN listing_id % 7 = 0 THEN replace(url, '/for-', '/')
                 ELSE url END AS url2
  FROM listing
)"""


def _type_of(text: str) -> str:
    return (f"(CASE WHEN {text} LIKE '%apartment%' THEN 'Apartment' "
            f"WHEN {text} LIKE '%residence%' THEN 'Residence' "
            f"WHEN {text} LIKE '%house%' THEN 'House' "
            f"WHEN {text} LIKE '%villa%' THEN 'Villa' ELSE 'Other' END)")


oracle("X8_infer_property_type", with_ctes(LST2_CTE, f"""
SELECT listing_id,
       COALESCE(NULLIF(property_type, ''),
                {_type_of("lower(COALESCE(url2, '') || ' ' || COALESCE(title, ''))")}) AS filled_type,
       {_type_of("lower(' ' || COALESCE(title, ''))")} AS title_type
FROM lst"""))

oracle("X9_rent_flag_from_url", with_ctes(LST2_CTE, """
SELECT listing_id, url2,
       CASE WHEN lower(url2) LIKE '%/for-rent/%' THEN true
            WHEN lower(url2) LIKE '%/for-sale/%' THEN false END AS is_rent
FROM lst"""))

_RENT = "/for-rent/|for rent|te huur|à louer|zur miete|zu vermieten"
_SALE = "/for-sale/|for sale|te koop|à vendre|zum verkauf|verkauf"
_BLOB = pick(7, ["'Te huur: '", "'À vendre - '", "'Zum Verkauf '", "'for rent '", "''",
                 "'Te koop '", "'Zu vermieten '"]).replace("k %", "listing_id %")
oracle("X10_rent_sale_flags", with_ctes(LST2_CTE + f""",
fl AS (
  SELECT listing_id, price,
         regexp_matches(lower(COALESCE(url2, '')), '{_RENT}')
           OR regexp_matches(lower({_BLOB} || COALESCE(title, '')), '{_RENT}') AS r,
         regexp_matches(lower(COALESCE(url2, '')), '{_SALE}')
           OR regexp_matches(lower({_BLOB} || COALESCE(title, '')), '{_SALE}') AS s
  FROM lst
)""", """
SELECT listing_id, r AS is_rent, s OR (NOT r AND NOT s AND COALESCE(price >= 50000, false)) AS is_sale
FROM fl"""))

oracle("X11_postal_digits", with_ctes(LISTING_CTE, """
SELECT listing_id,
       CASE WHEN listing_id % 5 = 0 THEN 'Brussel' ELSE 'B-' || postal_code || ' ' || city END AS text,
       NULLIF(regexp_extract(CASE WHEN listing_id % 5 = 0 THEN 'Brussel'
                                  ELSE 'B-' || postal_code || ' ' || city END, '\\d+'), '') AS postal_code
FROM listing"""))

oracle("X12_day_from_text", """
SELECT o_orderkey AS k,
       CASE o_orderkey % 3 WHEN 0 THEN CAST(o_orderdate AS VARCHAR)
                           WHEN 1 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR)
                           ELSE 'not a date' END AS text,
       CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day
FROM orders""")

_PC = "CAST(postal_code AS DOUBLE)"
_X16_PRICE = pick(7, [_PC, f"{_PC} + 0.3", f"{_PC} + 0.7", "price", "price", "price", "price"]
                  ).replace("k %", "listing_id %")
oracle("X16_postal_code_as_price", with_ctes(LISTING_CTE, f"""
SELECT listing_id, {r4(_X16_PRICE)} AS price,
       CASE listing_id % 3 WHEN 0 THEN postal_code WHEN 1 THEN postal_code || '.0'
            ELSE postal_code || ',0' END AS postal_text,
       COALESCE({_X16_PRICE} BETWEEN 1000 AND 9999 AND abs({_PC} - ({_X16_PRICE})) < 0.5, false) AS is_postal
FROM listing"""))

oracle("X19_normalize_label", """
SELECT o_orderkey AS k,
       CASE o_orderkey % 5 WHEN 0 THEN 'bewoonbare opp' WHEN 1 THEN 'living area'
            WHEN 2 THEN 'surface & m2' WHEN 3 THEN 'bouwjaar' ELSE 'energy label' END AS label
FROM orders""")

oracle("X23_url_path_fields", with_ctes(LST2_CTE + """,
pp AS (
  SELECT listing_id, list_filter(string_split(url2, '/'), lambda x: x <> '') AS parts FROM lst
),
pi AS (SELECT listing_id, parts, COALESCE(list_position(parts, 'detail'), 0) AS i FROM pp)""", """
SELECT listing_id,
       CASE WHEN i > 0 THEN parts[i + 1] END AS property_type,
       CASE WHEN i > 0 THEN COALESCE(parts[i + 2], '') LIKE '%sale%' END AS is_sale,
       CASE WHEN i > 0 THEN parts[i + 3] END AS postal_code,
       CASE WHEN i > 0 THEN parts[i + 4] END AS city
FROM pi"""))

oracle("X24_year_in_range", with_ctes(RB_CTE + """,
yy AS (SELECT k, CASE k % 4 WHEN 0 THEN 1750 + k % 100 WHEN 1 THEN 2020 + k % 10 ELSE Y END AS raw
       FROM rb)""", """
SELECT k, raw, CASE WHEN raw BETWEEN 1800 AND 2026 THEN CAST(raw AS INTEGER) END AS year_built FROM yy"""))

oracle("X25_energy_class", """
SELECT o_orderkey AS k,
       CASE o_orderkey % 6 WHEN 0 THEN 'A+' WHEN 1 THEN 'B' WHEN 2 THEN 'A' WHEN 3 THEN 'A+'
            WHEN 4 THEN NULL ELSE 'C' END AS energy_label
FROM orders""")

oracle("X26_pad_postal_code", """
SELECT o_orderkey AS k,
       CASE o_orderkey % 3 WHEN 0 THEN lpad(CAST(o_custkey % 9999 + 1 AS VARCHAR), 4, '0')
            WHEN 1 THEN NULL ELSE lpad(CAST(o_orderkey % 100 AS VARCHAR), 4, '0') END AS postal_code
FROM orders""")

oracle("X28_address_split", with_ctes(LISTING_CTE, """
SELECT listing_id,
       CASE listing_id % 4 WHEN 0 THEN postal_code WHEN 1 THEN postal_code WHEN 2 THEN NULL
            ELSE CAST(listing_id % 50 AS VARCHAR) END AS postal_code,
       CASE WHEN listing_id % 4 = 2 THEN NULL ELSE city END AS city
FROM listing"""))

oracle("X29_flag_to_yes_no", with_ctes(LISTING_CTE, """
SELECT listing_id, CASE WHEN listing_id % 7 <> 0 AND is_rent THEN 'Yes' ELSE 'No' END AS is_rent,
       property_type
FROM listing"""))

oracle("X30_log_target_round_trip", with_ctes(LISTING_CTE, f"""
SELECT listing_id, {r4("ln(1 + price)")} AS log_price, {r4("exp(ln(1 + price)) - 1")} AS price_back
FROM listing"""))


# ---------------------------------------------------------------- guards, trims
KP_CTE = LISTING_CTE + """,
kp AS (SELECT *, price / 1000.0 AS price_k FROM listing),
sk AS (SELECT median(price_k) AS med, quantile_cont(price_k, 0.9) AS q90, max(price_k) AS mx FROM kp),
se AS (SELECT median(price) AS med, quantile_cont(price, 0.9) AS q90, max(price) AS mx FROM kp)"""

oracle("A6_unit_guard_v1", with_ctes(KP_CTE, f"""
SELECT listing_id,
       {r4("CASE WHEN sk.med <= 2000 AND sk.q90 <= 9000 AND sk.mx <= 10000 THEN price_k * 1000.0 ELSE price_k END")} AS price_k,
       {r4("CASE WHEN se.med <= 2000 AND se.q90 <= 9000 AND se.mx <= 10000 THEN price * 1000.0 ELSE price END")} AS price
FROM kp, sk, se"""))

oracle("A7_unit_guard_v2", with_ctes(KP_CTE, f"""
SELECT listing_id,
       {r4("CASE WHEN sk.q90 <> 0 AND sk.q90 < 10000 AND sk.mx < 100000 THEN round_even(price_k * 1000.0, 0) ELSE price_k END")} AS price_k,
       {r4("CASE WHEN se.q90 <> 0 AND se.q90 < 10000 AND se.mx < 100000 THEN round_even(price * 1000.0, 0) ELSE price END")} AS price
FROM kp, sk, se"""))

oracle("A7_unit_guard_report", with_ctes(KP_CTE, f"""
SELECT {r4("med")} AS median, {r4("q90")} AS q90, {r4("mx")} AS max,
       COALESCE(q90 <> 0 AND q90 < 10000 AND mx < 100000, false) AS applied
FROM sk"""))

oracle("A8_exact_quantiles", f"""
SELECT {r4("quantile_cont(o_totalprice, 0.05)")} AS q05, {r4("quantile_cont(o_totalprice, 0.25)")} AS q25,
       {r4("quantile_cont(o_totalprice, 0.5)")} AS q50, {r4("quantile_cont(o_totalprice, 0.75)")} AS q75,
       {r4("quantile_cont(o_totalprice, 0.9)")} AS q90, {r4("quantile_cont(o_totalprice, 0.95)")} AS q95,
       {r4("max(o_totalprice)")} AS max
FROM orders""")

oracle("F8_quantile_trim", with_ctes(LISTING_CTE + """,
b AS (SELECT quantile_cont(price_per_m2, 0.05) AS lo, quantile_cont(price_per_m2, 0.95) AS hi FROM listing)""", f"""
SELECT listing_id, {r4("price_per_m2")} AS price_per_m2
FROM listing, b WHERE price_per_m2 >= lo AND price_per_m2 <= hi"""))

NORM_CTE = LISTING_CTE + """,
norm AS (
  SELECT CAST(trunc(abs(price)) AS DOUBLE) AS price, surface_m2, bedrooms, bathrooms, postal_code, city,
         property_type, year_built, energy_label,
         COALESCE(is_sale, regexp_matches(lower(url), '/for-sale/')) AS is_sale
  FROM listing
),
base AS (SELECT * FROM norm WHERE is_sale AND price IS NOT NULL AND surface_m2 IS NOT NULL),
cnt AS (SELECT count(*) FILTER (WHERE price > 10000 AND surface_m2 > 10) AS strict,
               count(*) FILTER (WHERE price > 1000 AND surface_m2 > 10) AS relaxed,
               count(*) AS minimal FROM base)"""

oracle("F6_fallback_cascade_counts", with_ctes(NORM_CTE, "SELECT strict, relaxed, minimal FROM cnt"))

oracle("M9_training_set_v1", with_ctes(NORM_CTE, f"""
SELECT {r4("price")} AS price, {r4("surface_m2")} AS surface_m2,
       COALESCE(bedrooms, 0) AS bedrooms, COALESCE(bathrooms, 0) AS bathrooms,
       postal_code, city, property_type, year_built, energy_label
FROM base, cnt
WHERE CASE WHEN cnt.strict > 0 THEN price > 10000 AND surface_m2 > 10
           WHEN cnt.relaxed > 0 THEN price > 1000 AND surface_m2 > 10 ELSE true END"""))

_SCAN = r"(?i)([0-9]{1,3}(?:[.,][0-9]{1,2})?)\s*(?:[-–—]\s*([0-9]{1,3}(?:[.,][0-9]{1,2})?))?\s*(?:m2|m²|sqm|m)"
oracle("M10_training_set_v2", with_ctes(LISTING_CTE + f""",
d0 AS (SELECT *, CASE WHEN listing_id % 2 = 0 THEN 'Nice flat of ' || CAST(30 + listing_id % 90 AS VARCHAR)
                      || ' m² near the park' END AS description FROM listing),
g AS (SELECT quantile_cont(price, 0.9) AS q90, max(price) AS mx FROM d0),
d1 AS (SELECT d0.* REPLACE (CASE WHEN g.q90 <> 0 AND g.q90 < 10000 AND g.mx < 100000
                                 THEN round_even(price * 1000.0, 0) ELSE price END AS price) FROM d0, g),
d2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY snapshot_date DESC NULLS LAST,
                                                   listing_id DESC) AS rn
                      FROM d1 WHERE url IS NOT NULL) WHERE rn = 1),
d3 AS (SELECT *, COALESCE(surface_m2,
                          CASE WHEN TRY_CAST(replace(regexp_extract(description, '{_SCAN}', 1), ',', '.') AS DOUBLE) > 5
                               THEN TRY_CAST(replace(regexp_extract(description, '{_SCAN}', 1), ',', '.') AS DOUBLE) END) AS sf2
       FROM d2),
d4 AS (SELECT listing_id, url, snapshot_date, price,
              CASE WHEN sf2 <= 5 THEN NULL ELSE sf2 END AS surface_m2 FROM d3 WHERE price > 0),
d5 AS (SELECT *, CASE WHEN surface_m2 > 0 THEN price / surface_m2 END AS price_per_m2 FROM d4),
b AS (SELECT quantile_cont(price_per_m2, 0.05) AS lo, quantile_cont(price_per_m2, 0.95) AS hi FROM d5)""", f"""
SELECT listing_id, url, snapshot_date, {r4("price")} AS price, {r4("surface_m2")} AS surface_m2,
       {r4("price_per_m2")} AS price_per_m2
FROM d5, b WHERE price_per_m2 >= lo AND price_per_m2 <= hi AND price_per_m2 IS NOT NULL"""))

oracle("M11_training_frame_v3", with_ctes(LISTING_CTE + """,
lt AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY snapshot_date DESC NULLS LAST,
                                                   listing_id DESC) AS rn
                      FROM listing WHERE url IS NOT NULL) WHERE rn = 1)""", """
SELECT city, postal_code, property_type, CASE WHEN is_rent THEN 'Yes' ELSE 'No' END AS is_rent,
       CAST(bedrooms AS DOUBLE) AS bedrooms, CAST(bathrooms AS DOUBLE) AS bathrooms,
       surface_m2, price
FROM lt WHERE price IS NOT NULL AND surface_m2 IS NOT NULL AND surface_m2 BETWEEN 10 AND 1000"""))

_X16 = ("({p} BETWEEN 1000 AND 9999 AND abs(TRY_CAST(replace(trim(postal_code), ',', '.') AS DOUBLE)"
        " - {p}) < 0.5)")
REPAIR_CTE = LISTING_CTE + f""",
rin AS (
  SELECT listing_id, url, snapshot_date, city, postal_code, property_type, surface_m2,
         CASE WHEN listing_id % 10 = 0 THEN NULL WHEN listing_id % 10 = 1 THEN CAST(postal_code AS DOUBLE)
              ELSE price / 1000.0 END AS p0,
         CASE WHEN listing_id % 10 IN (0, 1) THEN floor(price / 1000.0) END AS text_price
  FROM listing
),
r2 AS (SELECT *, COALESCE(CASE WHEN COALESCE({_X16.format(p="p0")}, false) THEN NULL ELSE p0 END,
                          text_price) AS p2 FROM rin)"""

oracle("X17_repair_price", with_ctes(REPAIR_CTE, f"SELECT listing_id, {r4('p2')} AS price FROM r2"))

oracle("X18_repair_listings", with_ctes(REPAIR_CTE + f""",
st AS (SELECT median(p2) AS med, quantile_cont(p2, 0.9) AS q90, max(p2) AS mx FROM r2),
r3 AS (SELECT r2.*, CASE WHEN st.med <= 2000 AND st.q90 <= 9000 AND st.mx <= 10000 THEN p2 * 1000.0
                         ELSE p2 END AS p3 FROM r2, st),
r4 AS (SELECT *, CASE WHEN COALESCE({_X16.format(p="p3")}, false) THEN NULL ELSE p3 END AS p4 FROM r3),
r5 AS (SELECT listing_id, url, snapshot_date, city, postal_code, property_type,
              CASE WHEN p4 < 50000 THEN NULL ELSE p4 END AS price,
              CASE WHEN surface_m2 < 10 OR surface_m2 > 1000 THEN NULL ELSE surface_m2 END AS surface_m2
       FROM r4),
r6 AS (SELECT *, price / CASE WHEN surface_m2 <> 0 THEN surface_m2 END AS price_per_m2 FROM r5)""", f"""
SELECT listing_id, url, snapshot_date, {r4("price")} AS price, {r4("surface_m2")} AS surface_m2,
       {r4("price_per_m2")} AS price_per_m2
FROM (SELECT *, row_number() OVER (PARTITION BY url, snapshot_date, city, postal_code, property_type
                                   ORDER BY price DESC NULLS LAST, surface_m2 DESC NULLS LAST,
                                            listing_id DESC) AS rn FROM r6)
WHERE rn = 1"""))

oracle("F4_training_sanity", with_ctes(LISTING_CTE, f"""
SELECT listing_id, {r4("price - 5000.0")} AS price,
       {r4("CASE WHEN surface_m2 - 5.0 <= 5 THEN NULL ELSE surface_m2 - 5.0 END")} AS surface_m2
FROM listing WHERE price - 5000.0 > 0"""))


# ---------------------------------------------------------------- pages
def decode(x: str) -> str:
    for ent, ch in [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"),
                    ("&amp;", "&")]:
        x = f"replace({x}, '{ent}', '{ch}')"
    return x


_HREF = r"""(?is)<a\s[^>]*?href\s*=\s*["'']?([^"''\s>]+)"""
_BASE = "https://www.example.be"


def _links(include: list[str] | None) -> str:
    inc = ""
    if include is not None:
        inc = " AND (" + " OR ".join(f"contains(href, '{s}')" for s in include) + ")"
    exc = " AND ".join(f"NOT contains(url, '{s}')" for s in
                       ["/search", "/map", "/news", "/about", "/contact"])
    return f"""
WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '{_HREF}', 1)) AS href FROM pages),
l2 AS (SELECT page_id, {decode("href")} AS href FROM l),
l3 AS (
  SELECT page_id, split_part(CASE WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.-]*://') THEN href
                                  WHEN starts_with(href, '//') THEN 'https:' || href
                                  WHEN starts_with(href, '/') THEN '{_BASE}' || href
                                  ELSE '{_BASE}/' || href END, '?', 1) AS url
  FROM l2 WHERE href <> '' AND NOT starts_with(href, '#'){inc}
)
SELECT DISTINCT page_id, url FROM l3 WHERE {exc}"""


oracle("H1_listing_links", _links(["/detail/", "/classified/", "/en/for-sale/", "/en/for-rent/"]))
oracle("H1_page_outlinks", _links(None))


def _element_text(inner: str) -> str:
    t = decode(f"regexp_replace({inner}, '<[^>]*>', ' ', 'g')")
    return f"trim(regexp_replace(translate({t}, chr(160) || chr(8239), '  '), '\\s+', ' ', 'g'))"


_H1 = "(?is)<h1[^>]*>(.*?)</h1>"
_OG = r"""(?is)<meta[^>]*property\s*=\s*["'']og:title["''][^>]*content\s*=\s*["'']([^"'']*)"""
oracle("H3_page_title", f"""
SELECT page_id,
       CASE WHEN regexp_matches(html, '{_H1}') THEN {_element_text(f"regexp_extract(html, '{_H1}', 1)")}
            WHEN regexp_extract(html, '{_OG}', 1) <> '' THEN {_element_text(f"regexp_extract(html, '{_OG}', 1)")}
            ELSE '' END AS title
FROM pages""")


# ---------------------------------------------------------------- file zone
oracle("S1_towns_seed", "SELECT lower(n_name) AS town FROM nation")

oracle("S2_crawl_frontier", """
SELECT lower(n_name) AS town, CAST(p AS INTEGER) AS page,
       'https://www.example.be/en/for-sale/apartment?search=' || lower(n_name) || '&page=' || CAST(p AS VARCHAR) AS url
FROM nation, range(1, 4) t(p)
UNION ALL
SELECT lower(n_name) AS town, 1 AS page,
       'https://www.example.be/en/for-sale/house/' || lower(n_name) || '?page=1' AS url
FROM nation""")

oracle("S3_consolidate_urls", with_ctes(LISTING_CTE, """
SELECT DISTINCT url FROM listing WHERE url LIKE '%/apartment/%'"""))

oracle("A12_urls_per_town", with_ctes(LISTING_CTE, """
SELECT city AS town, count(DISTINCT url) AS total_urls FROM listing
WHERE url LIKE '%/apartment/%' AND listing_id % 5 <> 0 GROUP BY city"""))

oracle("S4_compact_details", with_ctes(LISTING_CTE, """
SELECT DISTINCT CAST(snapshot_date AS VARCHAR) AS snapshot_date, url, title, city, postal_code,
       property_type, CAST(price AS VARCHAR) AS price, CAST(surface_m2 AS VARCHAR) AS surface_m2,
       CAST(bedrooms AS VARCHAR) AS bedrooms, CAST(bathrooms AS VARCHAR) AS bathrooms,
       CAST(year_built AS VARCHAR) AS year_built, energy_label
FROM listing WHERE url LIKE '%/apartment/%'"""))

oracle("S5_newest_partition", """
SELECT 'snapshot_month=' || strftime(max(o_orderdate), '%Y-%m') AS partition FROM orders""")

EV_PAGES = """
ep AS (
  SELECT CAST(ts AS DATE) AS run,
         'partial_urls_page_' || CAST(hour(ts) AS VARCHAR) || '_town_' || strftime(ts, '%Y%m%d') || '.csv' AS file,
         CAST(hour(ts) AS INTEGER) AS page,
         list_sort(list(DISTINCT event_type)) AS urls, count(*) AS n_rows
  FROM events GROUP BY 1, 2, 3
),
ec AS (
  SELECT *, CASE WHEN lag(urls) OVER (PARTITION BY run ORDER BY page) IS NULL
                   OR lag(urls) OVER (PARTITION BY run ORDER BY page) <> urls THEN 1 ELSE 0 END AS chg
  FROM ep
),
ei AS (SELECT *, sum(chg) OVER (PARTITION BY run ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS isl
       FROM ec),
ed AS (SELECT *, CAST(row_number() OVER (PARTITION BY run, isl ORDER BY page) - 1 AS INTEGER) AS dup_run FROM ei)"""

oracle("W4_page_number_from_file_name", with_ctes(EV_PAGES, "SELECT run, file, page FROM ep"))
oracle("W3_duplicate_page_runs", with_ctes(EV_PAGES, "SELECT run, page, urls, dup_run FROM ed"))
oracle("A11_merge_statistics", with_ctes(EV_PAGES + """,
ua AS (SELECT CAST(ts AS DATE) AS run, count(DISTINCT event_type) AS rows_after FROM events GROUP BY 1),
st AS (SELECT run, count(*) AS files_scanned, arg_max(dup_run, page) AS duplicate_files,
              sum(n_rows) AS rows_before FROM ed GROUP BY run)""", """
SELECT st.run, files_scanned, duplicate_files, CAST(rows_before AS BIGINT) AS rows_before, rows_after,
       files_scanned - duplicate_files AS unique_files
FROM st JOIN ua ON st.run = ua.run"""))


# ---------------------------------------------------------------- models
def rd(expr: str, d: int) -> str:
    q = f"{10 ** d}.0"
    return f"(floor(({expr}) * {q} + 0.5) / {q})"


F5_CTE = LISTING_CTE + """,
l5 AS (SELECT * FROM listing WHERE price IS NOT NULL AND surface_m2 IS NOT NULL
                                AND surface_m2 BETWEEN 10 AND 1000)"""

oracle("M1_feature_projection", with_ctes(LISTING_CTE, """
SELECT listing_id, surface_m2, bedrooms, bathrooms, year_built, postal_code, city, property_type,
       energy_label, region, price FROM listing"""))

oracle("A15_feature_medians", with_ctes(LISTING_CTE, "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, {r4(f'median(CAST({c} AS DOUBLE))')} AS median FROM listing"
    for c in ["surface_m2", "bedrooms", "bathrooms", "year_built", "price"])))

oracle("A15_feature_modes", with_ctes(LISTING_CTE, "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS feature, (SELECT v FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM listing
         WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY n DESC, v ASC LIMIT 1)) AS mode"""
    for c in ["postal_code", "city", "property_type", "energy_label", "region"])))

_CV_METRICS = f"""
SELECT fold, {rd("sqrt(avg((y - yhat) * (y - yhat)))", 2)} AS rmse, {rd("avg(abs(y - yhat))", 2)} AS mae,
       {rd("avg(abs(y - yhat) / greatest(abs(y), 1e-9))", 6)} AS mape,
       {rd("1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*))", 6)} AS r2,
       count(*) AS n
FROM p GROUP BY fold"""
CV_CTE = F5_CTE + """,
d AS (SELECT CAST(listing_id % 5 AS INTEGER) AS fold, surface_m2 AS x, price AS y, ln(1 + price) AS ly FROM l5),
fs AS (SELECT DISTINCT fold AS f FROM d),
coef AS (SELECT f, regr_slope(ly, x) AS b, regr_intercept(ly, x) AS a FROM fs JOIN d ON d.fold <> fs.f GROUP BY f),
p AS (SELECT d.fold, y, exp(a + b * x) - 1 AS yhat FROM d JOIN coef ON d.fold = coef.f)"""

oracle("M4_linear_cv_fold_metrics", with_ctes(CV_CTE, _CV_METRICS))

oracle("A14_linear_cv_mean_metrics", with_ctes(CV_CTE + f""",
pf AS (SELECT fold, sqrt(avg((y - yhat) * (y - yhat))) AS rmse, avg(abs(y - yhat)) AS mae,
              avg(abs(y - yhat) / greatest(abs(y), 1e-9)) AS mape,
              1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*)) AS r2, count(*) AS n
       FROM p GROUP BY fold)""", f"""
SELECT {rd("avg(rmse)", 2)} AS rmse, {rd("avg(mae)", 2)} AS mae, {rd("avg(mape)", 6)} AS mape,
       {rd("avg(r2)", 6)} AS r2, CAST(sum(n) AS BIGINT) AS n FROM pf"""))

oracle("M5_linear_holdout", with_ctes(F5_CTE + """,
d AS (SELECT listing_id % 10 AS b, surface_m2 AS x, price AS y FROM l5),
coef AS (SELECT regr_slope(y, x) AS s, regr_intercept(y, x) AS a FROM d WHERE b >= 2),
p AS (SELECT y, a + s * x AS yhat FROM d, coef WHERE b < 2)""", f"""
SELECT {rd("1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*))", 6)} AS r2,
       {rd("avg(abs(y - yhat))", 2)} AS mae, count(*) AS n FROM p"""))

oracle("P10_scoring_request_coercion", with_ctes(LISTING_CTE, """
SELECT listing_id AS request_id,
       CASE WHEN listing_id % 3 = 0 THEN NULL ELSE surface_m2 END AS surface_m2,
       CAST(year_built AS INTEGER) AS year_built, CAST(bedrooms AS INTEGER) AS bedrooms,
       CAST(NULL AS INTEGER) AS bathrooms, postal_code, city,
       CAST(NULL AS VARCHAR) AS property_type, CAST(NULL AS VARCHAR) AS energy_label,
       CAST(NULL AS VARCHAR) AS region
FROM listing"""))


# ---------------------------------------------------------------- sinks, flows, streaming
_LATEST_ALL = with_ctes(LISTING_CTE, """
SELECT url, snapshot_date, price FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY snapshot_date DESC, listing_id DESC) AS rn
  FROM listing WHERE url IS NOT NULL) WHERE rn = 1""")
_LAKE_TABLES = with_ctes(LISTING_CTE, """
SELECT 'latest' AS "table", url, snapshot_date, price, CAST(NULL AS BIGINT) AS n FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY snapshot_date DESC, listing_id DESC) AS rn
  FROM listing WHERE url IS NOT NULL) WHERE rn = 1
UNION ALL SELECT 'history', url, snapshot_date, price, NULL FROM listing WHERE url IS NOT NULL
UNION ALL SELECT 'summary', concat_ws('|', city, property_type), snapshot_date, NULL, count(*) FROM listing
  WHERE url IS NOT NULL AND price_per_m2 IS NOT NULL GROUP BY city, property_type, snapshot_date""")
oracle("J2_upsert_tables", _LAKE_TABLES)
oracle("J2_stream_upsert", _LAKE_TABLES)

oracle("S10_history_partitions", with_ctes(LISTING_CTE, """
SELECT listing_id, url, strftime(snapshot_date, '%Y-%m') AS snapshot_month FROM listing"""))

oracle("S12_replace_table_from_itself", with_ctes(LISTING_CTE, """
SELECT listing_id, url, price FROM listing WHERE price >= 100000"""))

oracle("S17_table_counts", with_ctes(LISTING_CTE, """
SELECT 'listings_latest' AS "table", count(DISTINCT url) AS n FROM listing
UNION ALL SELECT 'listings_history', count(*) FROM listing
UNION ALL SELECT 'market_daily_summary', CAST(NULL AS BIGINT)"""))

oracle("S16_rebuild_sanity_report", with_ctes(PREP_CTE, """
SELECT count(*) AS total_rows,
       count(*) FILTER (WHERE price IS NULL) AS missing_price,
       count(*) FILTER (WHERE surface_m2 IS NULL) AS missing_m2,
       count(*) FILTER (WHERE surface_m2 < 10 OR surface_m2 > 1000) AS bad_m2,
       count(*) FILTER (WHERE price_per_m2 < 500 OR price_per_m2 > 50000) AS bad_eur_m2,
       count(*) FILTER (WHERE price IS NOT NULL AND surface_m2 IS NOT NULL
                          AND surface_m2 BETWEEN 10 AND 1000
                          AND (price_per_m2 IS NULL OR price_per_m2 BETWEEN 500 AND 50000))
         AS kept_after_sanity
FROM prep"""))

oracle("S11_csv_sink_roundtrip", with_ctes(LISTING_CTE, "SELECT listing_id, url, city FROM listing"))


# ---------------------------------------------------------------- remaining inventory
oracle("S6_source_preference_chain", with_ctes(LISTING_CTE, """
SELECT listing_id, url FROM listing WHERE snapshot_date >= DATE '1998-08-01'"""))

oracle("P4_legacy_column_renames", with_ctes(LISTING_CTE, f"""
SELECT listing_id, CASE WHEN surface_m2 > 0 THEN surface_m2 END AS surface_m2,
       regexp_extract(postal_code, '\\d+') AS postal_code, snapshot_date,
       {r4("CASE WHEN surface_m2 > 0 AND price > 0 THEN price / surface_m2 END")} AS price_per_m2
FROM listing"""))

oracle("X1_strip_currency_and_space", with_ctes(RB_CTE, f"""
SELECT k, regexp_replace(regexp_replace(trim(translate({PRICE_TEXT}, chr(160) || chr(8239), '  ')),
                                        '[^0-9.,\\- ]+', '', 'g'), '\\s+', ' ', 'g') AS stripped
FROM rb"""))

oracle("F11_market_slice", with_ctes(PREP_CTE, """
SELECT listing_id, city, postal_code, property_type FROM cleaned
WHERE city = 'nation_3' AND contains(postal_code, '1')"""))

oracle("O2_input_cap_first_urls", with_ctes(LISTING_CTE, """
SELECT url FROM (SELECT DISTINCT url FROM listing WHERE url IS NOT NULL) ORDER BY url LIMIT 100"""))

oracle("U1_schema_tolerant_union", with_ctes(LISTING_CTE, """
SELECT listing_id, url, price AS price_a, CAST(NULL AS DOUBLE) AS surface_b FROM listing
WHERE snapshot_date < DATE '1998-08-01'
UNION ALL
SELECT listing_id, url, CAST(NULL AS DOUBLE), surface_m2 FROM listing WHERE snapshot_date >= DATE '1998-08-01'"""))

oracle("A13_training_lineage", with_ctes(LISTING_CTE + f""",
d0 AS (SELECT *, CASE WHEN listing_id % 2 = 0 THEN 'Nice flat of ' || CAST(30 + listing_id % 90 AS VARCHAR)
                      || ' m² near the park' END AS description FROM listing),
d2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY snapshot_date DESC NULLS LAST,
                                                   listing_id DESC) AS rn
                      FROM d0 WHERE url IS NOT NULL) WHERE rn = 1),
d3 AS (SELECT *, COALESCE(surface_m2,
                          CASE WHEN TRY_CAST(replace(regexp_extract(description, '{_SCAN}', 1), ',', '.') AS DOUBLE) > 5
                               THEN TRY_CAST(replace(regexp_extract(description, '{_SCAN}', 1), ',', '.') AS DOUBLE) END) AS sf2
       FROM d2),
d4 AS (SELECT listing_id, price, CASE WHEN sf2 <= 5 THEN NULL ELSE sf2 END AS surface_m2 FROM d3 WHERE price > 0),
d5 AS (SELECT *, CASE WHEN surface_m2 > 0 THEN price / surface_m2 END AS price_per_m2 FROM d4),
b AS (SELECT quantile_cont(price_per_m2, 0.05) AS lo, quantile_cont(price_per_m2, 0.95) AS hi FROM d5),
o AS (SELECT d5.* FROM d5, b WHERE price_per_m2 >= lo AND price_per_m2 <= hi AND price_per_m2 IS NOT NULL)""", f"""
SELECT (SELECT count(*) FROM listing) AS n_in, (SELECT count(sf2) FROM d3) AS surface_filled,
       CASE WHEN (SELECT count(price_per_m2) FROM d5) > 0 THEN 'price_per_m2' ELSE 'price' END AS trim_target,
       {r4("(SELECT lo FROM b)")} AS trim_lo, {r4("(SELECT hi FROM b)")} AS trim_hi,
       (SELECT count(*) FROM d5) - count(*) AS trim_dropped, count(*) AS n_out
FROM o"""))

ORACLES["A3_market_summary_v3_rank_select"] = ORACLES["A3_market_summary_v3"]

oracle("A3_market_summary_v3_split_hot_groups", with_ctes(PREP_CTE, f"""
SELECT CASE WHEN listing_id % 10 = 0 THEN snapshot_date END AS snapshot_date,
       CASE WHEN listing_id % 10 = 0 THEN city ELSE 'hot' END AS city,
       CASE WHEN listing_id % 10 = 0 THEN property_type END AS property_type, count(url) AS n,
       {r4("median(price)")} AS median_price, {r4("median(price_per_m2)")} AS median_eur_m2
FROM cleaned GROUP BY 1, 2, 3
"""))

ORACLES["S15_dashboard_sql_on_view"] = ORACLES["A4_dashboard_summary_top500"]

oracle("S8_read_details_with_kind", with_ctes(LISTING_CTE, """
SELECT listing_id, url, price, 'houses' AS kind FROM listing WHERE url LIKE '%/house/%'"""))

oracle("P3_url_column_rename", with_ctes(LISTING_CTE, "SELECT listing_id, url FROM listing"))

oracle("P8_defensive_float_coercion", with_ctes(RB_CTE, f"""
SELECT k, {pick(4, ["CAST(P AS VARCHAR) || ' €'",
                    "'EUR' || CAST(P AS VARCHAR) || ',' || lpad(CAST(C AS VARCHAR), 2, '0')",
                    "chr(160) || CAST(P AS VARCHAR) || ' '", "'n/a'"])} AS text,
       {r4("CASE k % 4 WHEN 1 THEN (P * 100 + C) / 100.0 WHEN 3 THEN NULL ELSE CAST(P AS DOUBLE) END")} AS value
FROM rb"""))
