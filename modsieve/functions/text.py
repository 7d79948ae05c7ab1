"""Column functions on text: words, tokens, trimming, URL rewriting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes, valid in both Java and RE2 regular expressions.
# SPACE lists the characters Unicode calls white space (plus \x1c-\x1f), because a
# plain \s is ASCII-only here.
SPACE = r"\t-\r\x1c-\x20\x{85}\p{Z}"
WORD = r"\p{L}\p{N}_"
# The same white space, one by one.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# What counts as a URL, for cleaning and for everything else.
URL_TO_CLEAN = r'https?://[^' + SPACE + r'<>"{}|\\^`\[\]]+'
URL_ANYWHERE = r"https?://[^" + SPACE + r"/$.?#][^\n][^" + SPACE + r"]*"
URL_DOMAIN = r"(?:https?://)?([a-z0-9\-\.]+)\.[a-z]{2,}"
URL_BEFORE_PATH = r"^(?:https?://)?[a-z0-9\.-]+\.[a-z]{2,}/?"
# Characters whose compatibility form contains one of / ? # @ : and
# which therefore make a host unparsable.
BAD_HOST = r"[\x{2048}\x{2049}\x{2047}\x{2100}\x{2101}\x{2105}\x{2106}\x{2A74}\x{FE13}\x{FE16}\x{FE55}\x{FE56}\x{FE5F}\x{FE6B}\x{FF03}\x{FF0F}\x{FF1A}\x{FF1F}\x{FF20}]"


def words(col: Column) -> Column:
    """White-space separated words, no empty ones."""
    return F.regexp_extract_all(col, F.lit(f"[^{SPACE}]+"), 0)


def word_count(col: Column) -> Column:
    return F.regexp_count(col, F.lit(f"[^{SPACE}]+"))


def strip(col: Column) -> Column:
    """Drop white space of any kind at both ends."""
    return F.btrim(col, F.lit(SPACES))


def tokens(col: Column) -> Column:
    """Lower-case word tokens of at least two characters."""
    return F.regexp_extract_all(F.lower(col), F.lit(f"[{WORD}]{{2,}}"), 0)


def urls(col: Column) -> Column:
    return F.regexp_extract_all(col, F.lit(URL_ANYWHERE), 0)


def rewrite_matches(col: Column, pattern: str, rewrite, hint=lambda c: c.contains("://")) -> Column:
    """Replace every match of ``pattern`` by ``rewrite(match)`` in texts that pass the cheap test ``hint``.

    The text is cut at the matches, the matches are rewritten as an array, and the
    two arrays are joined again, all inside one row.
    """
    between = F.split(col, pattern, -1)
    found = F.transform(F.regexp_extract_all(col, F.lit(pattern), 0), rewrite)
    joined = F.array_join(
        F.zip_with(between, found, lambda piece, new: F.concat(piece, F.coalesce(new, F.lit("")))), ""
    )
    return F.when(hint(col), joined).otherwise(col)


def _short_url(url: Column) -> Column:
    rest = F.regexp_replace(url, "^https?://", "")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    domain = F.regexp_replace(F.lower(host), r"^www\.", "")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    path = F.regexp_replace(path, r";[^/]*$", "")
    first_two = F.slice(F.filter(F.split(path, "/"), lambda p: p != ""), 1, 2)
    return (
        F.when(host.rlike(BAD_HOST), F.lit("<url>: (unknown)"))
        .when(F.size(first_two) > 0, F.concat(F.lit("<url>: ("), domain, F.lit("/"), F.array_join(first_two, "/"), F.lit(")")))
        .otherwise(F.concat(F.lit("<url>: ("), domain, F.lit(")")))
    )


def url_clean(col: Column) -> Column:
    """Each URL becomes ``<url>: (domain/first/two)``."""
    return rewrite_matches(col, URL_TO_CLEAN, _short_url)


def _url_words(url: Column) -> Column:
    low = F.lower(url)
    labels = F.filter(F.split(F.regexp_extract(low, URL_DOMAIN, 1), r"\."), lambda p: p != "")
    domain = F.array_join(F.transform(labels, lambda p: F.concat(F.lit("domain:"), p, F.lit(" "))), "")
    parts = F.filter(
        F.split(F.regexp_replace(low, URL_BEFORE_PATH, ""), "[/_.-]+"), lambda p: p.rlike(r"^[\p{L}\p{N}]+$")
    )
    path = F.array_join(F.transform(parts, lambda p: F.concat(F.lit("path:"), p)), "")
    return F.trim(F.concat(domain, path))


def url_semantics(col: Column) -> Column:
    """Each URL becomes ``domain:a domain:b path:xpath:y``."""
    return rewrite_matches(col, URL_ANYWHERE, _url_words)
