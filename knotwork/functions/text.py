"""Normalisation, tokens, n-grams and codes of a record's text, as native column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Words that say nothing about which business or address is meant.
BUSINESS_STOP = """
inc incorporated llc ltd limited corp corporation co company services service solutions solution group
enterprises enterprise holdings holding pvt private the and of in for technologies technology tech global
international usa us india
""".split()
ADDRESS_STOP = """
street st avenue ave road rd boulevard blvd lane ln drive dr court ct suite ste floor fl building bldg
highway hwy box po usa us
""".split()

SPACE = r"\s\x1c-\x1f\x85\p{Z}"
UK_CODE = r"(?U)\b[A-Za-z]{1,2}\d{1,2}[A-Za-z]?\s*\d[A-Za-z]{2}\b"


@F.pandas_udf(StringType())
def _folded(texts):
    """Canonical composition and full case folding, which Spark has no function for."""
    return texts.map(lambda x: unicodedata.normalize("NFC", x).casefold(), na_action="ignore")


def text_or_empty(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def normalize(column: Column, exact: bool = False, keep_marks: bool = False) -> Column:
    """Lower case, everything but letters, numbers and _ to single spaces, trimmed; null gives an empty text.

    exact adds composition and full case folding in a vectorised Python function; the native form
    lower-cases instead, which differs for a few letters (ß, final sigma, ligatures). keep_marks keeps
    combining marks, so that words of Indic scripts stay whole.
    """
    low = _folded(text_or_empty(column)) if exact else F.lower(text_or_empty(column))
    word = r"\p{L}\p{N}\p{M}_" if keep_marks else r"\p{L}\p{N}_"
    return F.trim(F.regexp_replace(F.regexp_replace(low, f"[^{word}{SPACE}]", " "), f"[{SPACE}]+", " "))


def no_strings() -> Column:
    return F.expr("cast(array() as array<string>)")


def tokenize(normal: Column) -> Column:
    """The distinct words of a normalised text."""
    return F.when(normal == "", no_strings()).otherwise(F.array_distinct(F.split(normal, " ")))


def char_ngrams(text: Column, n: int) -> Column:
    """Distinct n-grams of the text without white space; the whole of it if it is no longer than n."""
    grams = lambda c: F.when(c == "", no_strings()).when(F.length(c) <= n, F.array(c)).otherwise(
        F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - (n - 1)), lambda i: F.substring(c, i, n))))
    return F.transform(F.array(F.regexp_replace(text_or_empty(text), f"[{SPACE}]+", "")), grams)[0]


def postal_tokens(text: Column) -> Column:
    """Numbers of three to six digits, and British codes in lower case without spaces."""
    text = text_or_empty(text)
    codes = F.transform(F.regexp_extract_all(text, F.lit(UK_CODE), F.lit(0)), lambda x: F.lower(F.regexp_replace(x, f"[{SPACE}]+", "")))
    return F.array_union(F.regexp_extract_all(text, F.lit(r"(?U)\b\d{3,6}\b"), F.lit(0)), codes)


def country_key(column: Column) -> Column:
    return F.upper(F.trim(text_or_empty(column)))


def source_of(entity_id: Column) -> Column:
    """S1, S2, S3: what stands before the dash."""
    return F.substring_index(entity_id, "-", 1)


def name_terms(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: (F.length(t) > 1) & ~t.isin(BUSINESS_STOP))


def address_terms(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: (F.length(t) >= 3) & ~t.isin(ADDRESS_STOP))


def composite_terms(name_tokens: Column, addr_tokens: Column) -> Column:
    """Name tokens and longer address tokens together."""
    return F.array_union(name_tokens, F.filter(addr_tokens, lambda t: (F.length(t) >= 4) & ~t.isin(BUSINESS_STOP)))


def id_list(text: Column) -> Column:
    """The trimmed, non-blank parts of a comma-separated list."""
    return F.filter(F.transform(F.split(text_or_empty(text), ","), lambda x: F.trim(x)), lambda x: x != "")


def score_map(text: Column) -> Column:
    """`id:p,id:p` as a map of doubles."""
    pairs = F.filter(F.split(text_or_empty(text), ","), lambda x: x.contains(":"))
    return F.map_from_entries(F.transform(pairs, lambda x: F.struct(F.substring_index(x, ":", 1), F.substring_index(x, ":", -1).cast("double"))))


def format_scores(ids: Column, scores: Column) -> Column:
    return F.array_join(F.zip_with(ids, scores, lambda i, p: F.concat(i, F.lit(":"), F.format_string("%.4f", p))), ",")
