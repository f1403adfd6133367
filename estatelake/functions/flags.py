"""Categorical / flag / URL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocab
from .parse import as_text, first_number, normalize_spaces, safe_double


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def infer_property_type(url, title) -> Column:
    """First keyword of apartment/residence/house/villa in url+title."""
    text = F.lower(F.concat_ws(" ", F.coalesce(as_text(url), F.lit("")),
                               F.coalesce(as_text(title), F.lit(""))))
    expr = None
    for key, label in vocab.PROPERTY_TYPE_KEYWORDS:
        expr = (F.when(text.contains(key), label) if expr is None
                else expr.when(text.contains(key), label))
    return expr.otherwise("Other")


def fill_property_type(ptype, url, title) -> Column:
    """X8 applied only where the type is missing or empty."""
    return F.coalesce(F.nullif(as_text(ptype), F.lit("")), infer_property_type(url, title))


def is_rent_from_url(url) -> Column:
    """Tri-state rent flag from the URL path (NULL when neither cue)."""
    u = F.lower(as_text(url))
    return F.when(u.contains("/for-rent/"), True).when(u.contains("/for-sale/"), False)


def rent_sale_flags(url, blob, price, input_sale=None) -> tuple[Column, Column]:
    """Multilingual rent / sale cues over url and the row's text blob.

    Both flags may be true. A row with neither cue and a price of at least
    50 000 is inferred to be a sale. An input ``is_sale`` flag, when present
    and non-null, wins over the text cue.
    """
    u = F.lower(F.coalesce(as_text(url), F.lit("")))
    b = F.lower(F.coalesce(blob, F.lit("")))
    rent = u.rlike(vocab.RENT_PATTERN) | b.rlike(vocab.RENT_PATTERN)
    sale_txt = u.rlike(vocab.SALE_PATTERN) | b.rlike(vocab.SALE_PATTERN)
    inferred = (~rent) & (~sale_txt) & F.coalesce(_c(price) >= 50_000, F.lit(False))
    sale = sale_txt | inferred
    if input_sale is not None:
        sale = F.coalesce(_c(input_sale).cast("boolean"), sale)
    return rent, sale


def postal_digits(x) -> Column:
    """X11: first run of digits (NULL when there is none)."""
    return F.regexp_substr(as_text(x), F.lit(r"\d+"))


def to_day(x) -> Column:
    """Any date / timestamp / ISO text -> DATE; unparsable -> NULL."""
    c = _c(x)
    return F.to_date(F.try_to_timestamp(as_text(c)))


def postal_as_price(price, postal) -> Column:
    """Price between 1 000 and 9 999 that equals the postal code (±0.5)."""
    p = _c(price)
    pc = safe_double(F.regexp_replace(F.trim(as_text(postal)), ",", "."))
    return F.coalesce(p.between(1_000, 9_999) & (F.abs(pc - p) < 0.5), F.lit(False))


def url_parts(url) -> Column:
    """struct(property_type, is_sale, postal_code, city) from the path
    segments that follow ``detail``. All NULL when there is no ``detail``."""
    parts = F.filter(F.split(as_text(url), "/"), lambda s: s != "")
    i = F.array_position(parts, "detail")          # 1-based, 0 when absent
    has = i > 0

    def seg(k):                                    # k-th segment after 'detail'
        return F.when(has, F.get(parts, (i + k - 1).cast("int")))

    action = seg(2)
    return F.struct(
        seg(1).alias("property_type"),
        F.when(has, F.coalesce(action, F.lit("")).contains("sale")).alias("is_sale"),
        seg(3).alias("postal_code"),
        seg(4).alias("city"),
    )


def year_in_range(v, run_year: Column) -> Column:
    """An integer year between 1800 and next year."""
    y = F.floor(_c(v)).try_cast("int")
    hi = run_year + 1
    return F.when(y.between(F.lit(1800), hi), y)


ENERGY_RE = r"(?<![\p{L}\p{N}_])(A\+|[A-G])(?![\p{L}\p{N}_])"


def energy_class(v) -> Column:
    """X25: 'A+' or A..G as a whole token of the upper-cased value."""
    g = F.regexp_extract(F.upper(as_text(v)), ENERGY_RE, 1)
    return F.nullif(g, F.lit(""))


def pad_postal(v) -> Column:
    """First number as a zero-padded 4-digit postal code."""
    n = first_number(v)
    return F.when(n.isNotNull(), F.lpad(F.floor(n).try_cast("bigint").cast("string"), 4, "0"))


def address_split(address) -> Column:
    """struct(postal_code, city) from an address: the first all-digit
    token and the last token, only when the address has two tokens or more."""
    toks = F.split(F.trim(as_text(address)), r"\s+")
    ok = F.coalesce(F.size(toks) >= 2, F.lit(False))
    digits = F.get(F.filter(toks, lambda t: t.rlike(r"^[0-9]+$")), 0)
    return F.struct(F.when(ok & digits.isNotNull(), digits).alias("postal_code"),
                    F.when(ok & digits.isNotNull(), F.element_at(toks, -1)).alias("city"))


def yes_no(flag) -> Column:
    """Boolean -> 'Yes' / 'No' (NULL -> 'No')."""
    return F.when(F.coalesce(_c(flag).cast("boolean"), F.lit(False)), "Yes").otherwise("No")


def canonical_url(href, base: str = vocab.SITE_BASE) -> Column:
    """Resolve a relative href against ``base`` and drop the query."""
    h = as_text(href)
    full = (F.when(h.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*://"), h)
            .when(h.startswith("//"), F.concat(F.lit(base.split("//")[0]), h))
            .when(h.startswith("/"), F.concat(F.lit(base.rstrip("/")), h))
            .otherwise(F.concat(F.lit(base.rstrip("/") + "/"), h)))
    return F.split_part(full, F.lit("?"), F.lit(1))


def label_lookup_number(pairs, labels: Column) -> Column:
    """First number of the first pair whose label is in the array ``labels``.

    ``pairs`` is array<struct<label, value, ord>> sorted by ``ord``."""
    hits = F.filter(_c(pairs), lambda p: F.array_contains(labels, p["label"]))
    vals = F.transform(hits, lambda p: first_number(p["value"]))
    return F.get(F.filter(vals, lambda v: v.isNotNull()), 0)


# Basic named character references decoded by the label normaliser (labels
# coming through the page parser are already decoded; this covers raw text).
_ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'),
             ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&")]


def normalize_label(x) -> Column:
    """Strip, lower, decode basic entities, collapse whitespace (NBSP
    included), drop one trailing colon, 'opp.' -> 'opp', 'm²' -> 'm2'."""
    s = F.lower(F.trim(F.coalesce(as_text(x), F.lit(""))))
    for ent, ch in _ENTITIES:
        s = F.replace(s, F.lit(ent), F.lit(ch))
    s = F.regexp_replace(normalize_spaces(s), r"\s+", " ")
    s = F.regexp_replace(s, r":$", "")
    return F.replace(F.replace(s, F.lit("opp."), F.lit("opp")), F.lit("m²"), F.lit("m2"))
