"""Text -> number parsers as native column expressions.

Every function maps ``Column -> Column`` and compiles to JVM expressions
(regexp / translate / try_cast), so parsing stays inside whole-stage codegen
and scales with the scan; nothing here calls back into Python.

Java regex notes that shape these patterns:
* ``\\s`` does not match NBSP / narrow NBSP, so those are translated to a
  plain space first.
* ``(?i)`` is ASCII-only; accented cues are matched on ``lower()`` text.
* ``²`` is not a word character, so ``m²\\b`` fails before a space; the
  patterns use an explicit "no letter/digit follows" look-ahead instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocab

NBSP = "\u00a0"
THIN_NBSP = "\u202f"

_UNSIGNED = r"^[0-9]+(\.[0-9]*)?$|^\.[0-9]+$"
_SIGNED = r"^[-+]?([0-9]+(\.[0-9]*)?|\.[0-9]+)$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_text(x) -> Column:
    """String view of any column (numbers render as Spark's canonical text)."""
    return _c(x).cast("string")


def safe_double(s: Column, signed: bool = False) -> Column:
    """``try_cast`` behind a strict numeric guard: plain ``try_cast`` accepts
    '12d' or 'NaN', which are not numbers here."""
    pat = _SIGNED if signed else _UNSIGNED
    return F.when(s.rlike(pat), s.try_cast("double"))


def normalize_spaces(x) -> Column:
    """NBSP / narrow NBSP -> space."""
    return F.translate(_c(x), NBSP + THIN_NBSP, "  ")


def strip_currency_and_space(x) -> Column:
    """NBSP -> space, trim, drop everything but digits/separators/minus/space,
    collapse space runs."""
    s = F.trim(normalize_spaces(as_text(x)))
    s = F.regexp_replace(s, r"[^0-9.,\- ]+", "")
    return F.regexp_replace(s, r"\s+", " ")


def price_to_int_eur(x) -> Column:
    """Price text -> whole euros (bigint).

    The last separator followed by exactly one or two digits is a decimal
    point (the fraction is truncated); any other separator is a thousands
    mark. No digit -> NULL.
    """
    s = F.regexp_replace(strip_currency_and_space(x), r"[^0-9.,]", "")
    # integer part: the shortest prefix after which only an optional
    # 1-2 digit decimal tail remains
    whole = F.regexp_replace(F.regexp_extract(s, r"^(.*?)(?:[.,][0-9]{1,2})?$", 1), r"[.,]", "")
    return F.when(s.rlike("[0-9]"), F.coalesce(F.nullif(whole, F.lit("")), F.lit("0"))
                  .try_cast("bigint"))


def surface_to_float_m2(x) -> Column:
    """Surface text -> m² (double).

    Unit words go first (so '85 m2' is 85, not 852); with both ',' and '.'
    the dots are thousands and the comma is decimal; otherwise a comma is
    decimal. Unparsable -> digits only.
    """
    s = F.regexp_replace(F.lower(as_text(x)), r"m²|m2|sqm", "")
    s = F.regexp_replace(strip_currency_and_space(s), r"[^0-9.,]", "")
    dots_are_thousands = s.rlike(r",.*\.|\..*,")
    s2 = F.translate(F.when(dots_are_thousands, F.regexp_replace(s, r"\.", "")).otherwise(s), ",", ".")
    return F.coalesce(safe_double(s2), safe_double(F.regexp_replace(s2, r"[^0-9]", "")))


def price_from_text(x) -> Column:
    """The number after a '€' / 'EUR' cue, parsed with X2."""
    g = F.regexp_extract(normalize_spaces(as_text(x)), vocab.PRICE_IN_TEXT, 1)
    return F.when(g != "", price_to_int_eur(g))


def surface_from_text(x) -> Column:
    """X5: 'NN m²' / 'NN m2' in free text, parsed with X3."""
    g = F.regexp_extract(as_text(x), vocab.SURFACE_IN_TEXT, 1)
    return F.when(g != "", surface_to_float_m2(g))


def clean_price(x, numeric: bool = False) -> Column:
    """Rebuild-path price. Numbers pass through (re-parsing a float's text
    would drop its decimal point and multiply it by ten); strings keep digits
    and separators, dots are thousands, comma is decimal. Must be > 0."""
    if numeric:
        v = _c(x).cast("double")
    else:
        s = F.regexp_replace(as_text(x), r"[^0-9.,]", "")
        s = F.regexp_replace(F.regexp_replace(s, r"\.", ""), ",", ".")
        v = safe_double(s)
    return F.when(v > 0, v)


def clean_surface(x, numeric: bool = False) -> Column:
    """Rebuild-path surface; leftmost number of a range, > 0."""
    if numeric:
        v = _c(x).cast("double")
    else:
        s = F.regexp_replace(F.regexp_replace(F.lower(as_text(x)), "m²", ""), "m2", "")
        s = F.trim(F.regexp_replace(s, r"[^0-9,.\-]", ""))
        g = F.regexp_extract(s, r"^\s*([0-9]+(?:[.,][0-9]+)?)", 1)
        v = safe_double(F.regexp_replace(g, ",", "."))
    return F.when(v > 0, v)


def coerce_float(x) -> Column:
    """Defensive float coercion of text (spaces, NBSP and currency marks
    removed, comma -> dot)."""
    s = F.trim(as_text(x))
    s = F.regexp_replace(normalize_spaces(s), " ", "")
    s = F.regexp_replace(s, ",", ".")
    s = F.regexp_replace(s, "€|EUR|eur|Euros", "")
    return safe_double(s, signed=True)


def range_to_float(x) -> Column:
    """A number or a numeric range ('85–90' -> 87.5, midpoint)."""
    s = F.regexp_replace(normalize_spaces(as_text(x)), " ", "")
    s = F.regexp_replace(s, ",", ".")
    s = F.regexp_replace(s, r"[^0-9.\-–—]", "")
    rng = r"^([0-9]+(?:\.[0-9]+)?)[-–—]([0-9]+(?:\.[0-9]+)?)$"
    a = F.regexp_extract(s, rng, 1).try_cast("double")
    b = F.regexp_extract(s, rng, 2).try_cast("double")
    return F.when(s.rlike(rng), (a + b) / 2.0).otherwise(safe_double(s, signed=True))


# A currency cue with the run of number characters before it (none when it is too long) and after it. Values are looked for next to a cue only, and no
# longer than this; a longer run is no price. So any text takes linear time.
CUE_REACH = 64
CUED_RE = rf"(?i)(?:(?<![\d.,\s])([\d.,\s]{{0,{CUE_REACH}}}+))?{vocab.CURRENCY}(?=([\d.,\s]{{0,{CUE_REACH + 1}}}))"


def _cued_value(before: Column, after: Column) -> Column:
    """The value that ends at the cue, else the one that begins after it; NULL where a run reaches too far."""
    ends = F.nullif(F.regexp_extract(before, vocab.CUED_VALUE + r"\s*$", 1), F.lit(""))
    begins = F.nullif(F.regexp_extract(after, r"^\s*" + vocab.CUED_VALUE, 1), F.lit(""))
    whole = (F.length(after) <= CUE_REACH) | (F.length(F.regexp_extract(after, r"^\s*" + vocab.CUED_VALUE, 0)) <= CUE_REACH)
    return F.coalesce(ends, F.when(whole, begins))


def _cued_number(raw: Column) -> Column:
    grouped = rf"^({vocab.GROUPED})(?:[.,](\d{{1,2}}))?\s*$"
    whole = F.regexp_replace(F.regexp_extract(raw, grouped, 1), r"[^0-9]", "")
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(raw, r"\s", ""), r"\.", ""), ",", ".")
    return safe_double(F.when(raw.rlike(grouped), F.concat(whole, F.lit("."), F.regexp_extract(raw, grouped, 2),
                                                           F.lit("0"))).otherwise(plain))


def price_from_cued_text(x) -> Column:
    """Price only when the text carries a currency cue or a 'k' suffix.

    A 'k' right after the number is a multiplier even when a currency sign is
    present, so '€250k' is 250 000 rather than 250. Of several cues the first one
    with a value next to it counts.
    """
    t = normalize_spaces(as_text(x))
    both = [F.regexp_extract_all(t, F.lit(CUED_RE), F.lit(i)) for i in (1, 2)]
    values = F.filter(F.zip_with(*both, _cued_value), lambda v: v.isNotNull())
    # a lambda's argument is computed once, however often the expression names it
    cur_val = F.get(F.transform(F.slice(values, 1, 1), _cued_number), 0)
    k = F.regexp_extract(t, vocab.K_SUFFIX, 1)
    k_val = F.when(k != "", F.regexp_replace(k, ",", ".").try_cast("double") * 1000.0)
    # currency number immediately followed by k / K -> thousands
    cur_then_k = t.rlike(rf"(?i){vocab.CURRENCY}[0-9.,\s]*[0-9]\s?k(?![\p{{L}}\p{{N}}_])")
    return F.when(cur_then_k & k_val.isNotNull(), k_val).otherwise(F.coalesce(cur_val, k_val))


def _number_value(m: Column) -> Column:
    whole = F.regexp_extract(m, rf"^({vocab.NUMBER_WHOLE})", 1)
    frac = F.substr(m, F.length(whole) + 1)
    digits = F.regexp_replace(whole, r"[^0-9]", "")
    frac_digits = F.regexp_replace(frac, r"^[,.]", "")
    txt = F.when(frac == "", digits).otherwise(F.concat(digits, F.lit("."), frac_digits))
    return txt.try_cast("double")


def extract_numbers(x) -> Column:
    """Every number in the text, as array<double>.

    A 3-digit group after '.', ' ' or ',' is a thousands group (so 250000,
    250.000, 250 000 and 250,000 all read 250000); a trailing ',d' / '.d'
    tail that is not a full group is a decimal.
    """
    t = normalize_spaces(as_text(x))
    return F.transform(F.regexp_extract_all(t, F.lit(vocab.NUMBER), 0), _number_value)


def first_number(x) -> Column:
    return F.get(extract_numbers(x), 0)


def surface_value(x, mode: str = "mid") -> Column:
    """Surface with range separators; range -> midpoint ('mid') or
    upper bound ('max'); otherwise the first number."""
    t = F.trim(as_text(x))
    parts = F.split(t, vocab.RANGE_SEPARATOR)
    a = first_number(F.get(parts, 0))
    b = first_number(F.get(parts, 1))
    pick = F.greatest(a, b) if mode == "max" else (a + b) / 2.0
    single = first_number(t)
    out = F.when((F.size(parts) >= 2) & a.isNotNull() & b.isNotNull(), pick).otherwise(single)
    return F.when(t != "", out)


def parse_price(x) -> Column:
    """X22: 'M' (millions, needs a currency cue) and 'k' (thousands) suffixes
    keep their decimals; otherwise the largest number in the text."""
    t = F.lower(normalize_spaces(as_text(x)))
    m_re = r"(?<![\p{L}\p{N}_])([0-9]+(?:[.,][0-9]+)?)\s*m(?![\p{L}\p{N}_])"
    k_re = r"(?<![\p{L}\p{N}_])([0-9]+(?:[.,][0-9]+)?)\s*k(?![\p{L}\p{N}_])"
    cue = t.rlike(r"€|eur")
    m_val = F.regexp_replace(F.regexp_extract(t, m_re, 1), ",", ".").try_cast("double")
    k_val = F.regexp_replace(F.regexp_extract(t, k_re, 1), ",", ".").try_cast("double")
    nums = extract_numbers(t)
    return (F.when(cue & t.rlike(m_re), m_val * 1_000_000.0)
            .when(t.rlike(k_re), k_val * 1_000.0)
            .when(F.size(nums) > 0, F.array_max(nums)))
