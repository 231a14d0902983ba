"""Name, country, website, date and number clean-up as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Canonical country -> accepted spellings (compared upper-case, trimmed).
COUNTRY_SPELLINGS = {
    "GERMANY": ["DE", "DEUTSCHLAND", "GERMANY"],
    "JAPAN": ["JP", "JAPAN"],
    "FRANCE": ["FR", "FRANCE"],
    "UNITED STATES": ["US", "USA", "UNITED STATES"],
    "CANADA": ["CA", "CANADA"],
    "SWEDEN": ["SE", "SWEDEN"],
    "MEXICO": ["MX", "MEXICO"],
    "SPAIN": ["ES", "SPAIN"],
    "SOUTH KOREA": ["KR", "SOUTH KOREA", "KOREA", "REPUBLIC OF KOREA"],
    "IRELAND": ["IE", "IRELAND"],
    "INDIA": ["IN", "INDIA"],
    # upper('Türkiye') is 'TÜRKIYE' in Java and DuckDB, so both forms are listed
    "TURKEY": ["TR", "TURKEY", "TÜRKİYE", "TÜRKIYE"],
}

# Words and phrases that end a company name without naming the company.
LEGAL_SUFFIXES = (
    r"inc|corp|corporation|ltd|limited|gmbh|sa|sg|ag|llc|co|kg|co\.?\s*kg|group|division|"
    r"automotive|solutions|plc|as|ltd\.\s*sti|ticaret|sanayi|k\.s|bv|nv|sas|srl"
)
# Division tags removed wherever they occur, in this order.
DIVISION_TAGS = (
    r"\s*-\s*automotive\s*division|\s+automotive\s+division|\s+automotive",
    r"-?\s*automotive\s*division",
    r"-?\s*automotive",
    r"\bco\.\s*kg\b",
    r"\bltd\.?\s*şti\.?\b",
)
# Characters that may trail a name once its suffix is gone.
_TRAILING = r"[\s.,/&-]*"

# Hosts that are never a company's own site.
UTILITY_DOMAINS = [
    "linkedin.com", "facebook.com", "twitter.com", "wikipedia.org",
    "google.com", "baidu.com", "github.com", "youtube.com", "instagram.com",
    "juraforum.de", "weforum.org", "motogp.com",
]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim all Unicode white space (SQL ``trim`` removes spaces only)."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def match_key(c: Column | str) -> Column:
    """Case- and padding-insensitive key for exact name joins."""
    return strip(F.lower(_col(c)))


def is_blank(c: Column | str) -> Column:
    return _col(c).isNull() | (F.trim(_col(c)) == "")


def is_missing(c: Column | str) -> Column:
    return _col(c).isNull() | (_col(c) == "")


def canonical_name(c: Column | str) -> Column:
    return F.regexp_replace(F.lower(F.trim(_col(c))), r"\s+", " ")


def bare_website(c: Column | str) -> Column:
    return F.regexp_replace(F.lower(F.trim(_col(c))), r"^(https?://)?(www\.)?", "")


def canonical_country(c: Column | str) -> Column:
    raw = F.upper(F.trim(_col(c)))
    pairs = [F.lit(x) for country, forms in COUNTRY_SPELLINGS.items() for s in forms for x in (s, country)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), raw), raw)


def lenient_int(c: Column | str) -> Column:
    """Integer from text; decimals round half away from zero, anything else is NULL."""
    c = _col(c)
    number = F.when(c.rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"), c.try_cast("double"))
    return F.round(number).try_cast("int")


def lenient_date(c: Column | str) -> Column:
    """Date from ISO-like text, ``-`` or ``/`` separated, time part ignored; else NULL."""
    c = F.replace(_col(c), F.lit("/"), F.lit("-"))
    return F.when(
        c.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}([ T]\d{2}:.*)?\s*$"), F.trim(c).try_cast("date")
    )


def core_name(c: Column | str) -> Column:
    """The upper-case root of a company name; NULL becomes ''.

    Division tags go first, then every legal suffix and loose punctuation at
    the end. Stripping suffixes one by one until nothing changes equals a
    single anchored expression of the form ``trailing (suffix trailing)* $``.
    """
    name = strip(F.lower(F.coalesce(_col(c), F.lit(""))))
    name = F.replace(name, F.lit("̇"), F.lit(""))  # left by lower('İ')
    for tag in DIVISION_TAGS:
        name = F.regexp_replace(name, f"(?U){tag}", "")
    tail = rf"(?U){_TRAILING}(?:\b(?:{LEGAL_SUFFIXES})\b{_TRAILING})*$"
    return F.upper(strip(F.regexp_replace(name, tail, "")))


def clean_domain(c: Column | str) -> Column:
    """Host part of a URL without ``www.``; NULL unless it looks like a company's own.

    A host ends at ``/``, ``?`` or ``#``, has a dot, a last label of two or more
    characters, and is not a utility site. One pattern, so the input appears once.
    """
    blocked = "|".join(d.replace(".", r"\.") for d in UTILITY_DOMAINS)
    end = r"(?=[/?#]|$)"
    own = rf"^(?!(?:{blocked}){end})[^/?#\[\]]*\.[^./?#\[\]]{{2,}}{end}"
    url = F.regexp_replace(strip(F.lower(_col(c))), r"[\t\r\n]", "")
    return F.regexp_substr(F.regexp_replace(url, r"^(https?://)?(www\.)?", ""), F.lit(own))


def comparable(c: Column | str) -> Column:
    """Lower-case text with every non-alphanumeric turned into a space, for fuzzy scoring."""
    return strip(F.regexp_replace(F.lower(_col(c)), r"[^\p{L}\p{N}_]", " "))


def tokens(c: Column | str) -> Column:
    return F.filter(F.split(_col(c), r"(?U)\s+"), lambda t: t != "")


def token_sort_key(c: Column | str) -> Column:
    return F.array_join(F.sort_array(tokens(c)), " ")
