"""Vocabularies the operators match against.

FIXED VALUES. Every list below must equal the source pipeline's so that the
same inputs resolve to the same columns, labels and flags. They are written
plainly, in their natural order; do not reorder them, because several are
"first match wins" lists.
"""

# --- Column alias dictionary for the listing normaliser (exact names first,
# --- then substring keywords; first column in table order wins) -------------
ALIASES = {
    "url": (["url"], ["url", "link", "href"]),
    "title": (["title", "name", "heading"],
              ["title", "headline", "beschrijving", "description"]),
    "description": (["description", "beschrijving", "omschrijving", "details", "info"],
                    ["descr", "beschrij", "omscr", "details", "info"]),
    "price": (["price", "amount", "price_eur"],
              ["price", "prijs", "rent", "huur", "kost", "asking"]),
    "city": (["city", "town", "locality", "gemeente", "stad", "municipality", "plaats"],
             ["city", "town", "locality", "gemeente", "stad", "municipality", "plaats"]),
    "postal_code": (["postalcode", "postal_code", "zip", "zipcode", "postcode"],
                    ["postal", "zip", "post"]),
    "property_type": (["type", "property_type", "category", "subtype", "typology"],
                      ["type", "category", "subtype", "typology"]),
    "bedrooms": (["bedrooms", "beds", "slaapkamers"], ["bed", "slaap"]),
    "bathrooms": (["bathrooms", "baths", "badkamers"], ["bath", "bad"]),
    # surface_livable / surface_m2 added to the exact list and bedroom*/terrace*
    # excluded from the substring search (a wide record would otherwise pick
    # bedroom1_surface, the first column containing "surface").
    "surface_m2": (["surface", "area", "living_area", "size", "habitable_surface", "woonopp",
                    "oppervlakte", "surface_livable", "surface_m2"],
                   ["surface", "area", "m2", "m²", "opper", "habitable", "woon"]),
    "year_built": (["year", "built", "construction_year", "bouwjaar"],
                   ["year", "bouw", "construction"]),
    "energy_label": (["epc", "energy", "energy_label", "epc_label", "peb"],
                     ["epc", "energy", "peb"]),
}
SUBSTRING_EXCLUDE = {"surface_m2": ["bedroom", "terrace"]}

# URL column names recognised by the consolidation scan.
URL_COLUMN_NAMES = ["url", "urls", "link", "href"]

# Rent / sale cues over url and the row's text blob (lower-cased before matching).
RENT_PATTERN = r"/for-rent/|for rent|te huur|à louer|zur miete|zu vermieten"
SALE_PATTERN = r"/for-sale/|for sale|te koop|à vendre|zum verkauf|verkauf"

# Property type from url+title keywords: first hit wins, else "Other".
PROPERTY_TYPE_KEYWORDS = [
    ("apartment", "Apartment"),
    ("residence", "Residence"),
    ("house", "House"),
    ("villa", "Villa"),
]

# Label sets of the detail-page spec tables (matched after label normalisation).
SURFACE_LABELS = [
    "living area", "living-area", "area", "surface", "habitable surface", "living space",
    "surface habitable", "surf. habitable", "surface utile",
    "bewoonbare opp.", "bew. opp.", "bewoonbare oppervlakte", "woonopp.", "woonoppervlakte",
    "oppervlakte", "opp.",
    "m²", "sqm", "sq m", "m2",
]
BEDROOM_LABELS = ["bedrooms", "chambres", "slaapkamers", "kamers", "ch"]
BATHROOM_LABELS = ["bathrooms", "sdb", "badkamers", "bad", "bath", "bathroom"]
YEAR_LABELS = ["construction year", "year built", "built", "bouwjaar", "année de construction", "année"]
ENERGY_LABELS = ["energy label", "peb", "epc", "energy class", "klasse", "label énergie"]

# Spec-map keys that hold a surface (training backfill); compared after
# stripping every non-letter from both key and token.
SURFACE_SPEC_TOKENS = [
    "surface habitable", "surface", "habitable", "superficie",
    "bewoonbare opp.", "bew. opp.", "bewoonbare oppervlakte", "opp.", "oppervlakte", "woonopp",
    "living area", "area",
    "woonoppervlakte", "m²",
]

# Listing-link heuristics for crawled result pages.
LINK_INCLUDE = ["/detail/", "/classified/", "/en/for-sale/", "/en/for-rent/"]
LINK_EXCLUDE = ["/search", "/map", "/news", "/about", "/contact"]
SITE_BASE = "https://www.example.be"

# Legacy detail page: <h4> label texts -> output field (28-field record).
LEGACY_H4_FIELDS = [
    ("bedrooms", "Number of bedrooms"),
    ("bedroom1_surface", "Surface bedroom 1"),
    ("bedroom2_surface", "Surface bedroom 2"),
    ("bathrooms", "Number of bathrooms"),
    ("toilets", "Number of toilets"),
    ("surface_livable", "Livable surface"),
    ("terrace", "Terrace"),
    ("terrace_surface", "Surface terrace"),
    ("terrace_orientation", "Terrace orientation"),
    ("floor", "Floor of appartment"),
    ("year_built", "Build Year"),
    ("condition", "State of the property"),
    ("kitchen_equipment", "Kitchen equipment"),
    ("cellar", "Cellar"),
    ("glazing_type", "Type of glazing"),
    ("elevator", "Elevator"),
    ("entry_phone", "Entry phone"),
    ("epc_score", "Specific primary energy consumption"),
    ("epc_total", "Yearly total primary energy consumption"),
    ("epc_valid_until", "Validity date EPC/PEB"),
]
LEGACY_FIELDS = [
    "town", "page", "url", "property_type", "price", "address", "postal_code", "city",
    "bedrooms", "bedroom1_surface", "bedroom2_surface", "bathrooms", "toilets",
    "surface_livable", "terrace", "terrace_surface", "terrace_orientation", "floor", "year_built",
    "condition", "kitchen_equipment", "cellar", "glazing_type", "elevator", "entry_phone",
    "epc_score", "epc_total", "epc_valid_until",
]

# Model features.
NUMERIC_FEATURES = ["surface_m2", "bedrooms", "bathrooms", "year_built"]
CATEGORICAL_FEATURES = ["postal_code", "city", "property_type", "energy_label", "region"]

# Column lists of the persisted tables.
LISTING_TABLE_COLUMNS = [
    "snapshot_date", "url", "title", "city", "postal_code", "region",
    "property_type", "price", "surface_m2", "bedrooms", "bathrooms",
    "year_built", "energy_label", "price_per_m2",
]
TRAINING_V1_COLUMNS = [
    "price", "surface_m2", "bedrooms", "bathrooms",
    "postal_code", "city", "property_type", "year_built", "energy_label",
]
TRAINING_V2_KEEP = [
    "url", "title", "price", "surface_m2", "bedrooms", "bathrooms",
    "postal_code", "city", "region", "property_type", "year_built",
    "energy_label", "snapshot_date",
]

# What a legacy URL of each kind contains.
KIND_URL_MARKERS = {
    "apartments": ("/apartment/", "apartment?", "apartment&"),
    "houses": ("/house/", "house?", "house&"),
}

# Fixed patterns. They are the source pipeline's, spelled as there; each real change has its reason beside it.
# Java has no (?P<name>...), so groups are numbered; its \\b and \\d know ASCII only.
_WORD_END = r"(?![\p{L}\p{N}_])"     # stands for \b after a character that is no ASCII letter
_WORD_START = r"(?<![\p{L}\p{N}_])"  # stands for \b before a number: "é250k" has none there
PRICE_IN_TEXT = r"(?i)(?:€|\bEUR\b)\s*([\d\s\u00A0\u202F\.,]+)"
SURFACE_IN_TEXT = r"(?i)(\d+(?:[.,]\d+)?)\s*m(?:²|2)" + _WORD_END
SURFACE_SCAN = (r"(?i)(\d{1,3}(?:[.,]\d{1,2})?)\s*(?:[-–—]\s*(\d{1,3}(?:[.,]\d{1,2})?))?"
                r"\s*(?:m2|m\u00B2|m²|sqm|m)")
CURRENCY = r"(?:€|eur|euro|euros)"
# Full groups of three are thousands whatever separates them ("EUR 250,000"); the source reads 250 there.
GROUPED = r"\d{1,3}(?:[.,\s]\d{3})+(?!\d)"
# The source's value is [\d\.\s]+(?:[,\.\s]\d{1,3})?; here it starts with a digit, because a lone blank before the
# currency word matched as the value ("Prijs € 250.000"), and full groups come first.
CUED_VALUE = rf"({GROUPED}(?:[.,]\d{{1,2}}(?!\d))?|\d[\d\.\s]*(?:[,\.\s]\d{{1,3}})?)"
K_SUFFIX = r"(?i)" + _WORD_START + r"(\d{1,3}(?:[.,]\d{1,3})?)\s?k" + _WORD_END
# The source's number is (?<!\d)(\d{1,3}(?:[.\s]\d{3})*|\d+)([,.]\d+)?, which splits "250000" into 250 and 000; here a
# group needs its three digits, plain runs are taken whole, and a comma may separate thousands.
NUMBER_WHOLE = r"(?:\d{1,3}(?:[.\s,]\d{3})+(?!\d)|\d+)"
NUMBER = r"(?<!\d)" + NUMBER_WHOLE + r"(?:[,.]\d+)?"
RANGE_SEPARATOR = r"\s*(?:-|–|—|to|à|tot)\s*"

# Character references that page text carries; the ampersand's own comes last.
CHARACTER_REFERENCES = [
    ("nbsp", " "), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("euro", "€"), ("sup2", "²"), ("sup3", "³"), ("frac12", "½"),
    ("deg", "°"), ("ndash", "–"), ("mdash", "—"), ("hellip", "…"), ("middot", "·"), ("agrave", "à"), ("acirc", "â"), ("ccedil", "ç"),
    ("egrave", "è"), ("eacute", "é"), ("ecirc", "ê"), ("euml", "ë"), ("iuml", "ï"), ("icirc", "î"), ("ocirc", "ô"), ("ouml", "ö"),
    ("ugrave", "ù"), ("ucirc", "û"), ("uuml", "ü"), ("Eacute", "É"), ("amp", "&"),
]
