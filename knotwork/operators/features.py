"""The 25 similarity features of a candidate pair, as one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .retrieve import jaccard

# The features' names and their order.
NAME = [
    "name_exact_match", "name_token_jaccard", "name_token_overlap_count", "name_token_overlap_ratio", "name_char3_jaccard",
    "name_char4_jaccard", "name_seq_sim", "name_len_diff", "name_len_ratio", "name_token_count_diff",
]
ADDRESS = [
    "addr_exact_match", "addr_token_jaccard", "addr_token_overlap_count", "addr_token_overlap_ratio", "addr_char3_jaccard", "addr_seq_sim",
    "postal_exact_match", "postal_overlap_count", "s1_addr_missing", "cand_addr_missing", "both_addr_missing",
]
CROSS = ["country_match", "combined_token_jaccard", "is_source2", "is_source3"]
FEATURES = NAME + ADDRESS + CROSS
TEXTS = ["norm_name", "norm_addr", "country", "name_tokens", "addr_tokens", "char3", "char4", "addr_char3", "postal", "comb"]


def _flag(c: Column) -> Column:
    return c.cast("double")


def overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)).cast("double")


def overlap_ratio(a: Column, b: Column) -> Column:
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / F.least(F.size(a), F.size(b)))


def multiset_ratio(a: Column, b: Column) -> Column:
    """Twice the characters that both texts have, counted with repeats, over all characters."""
    letters = F.array_distinct(F.split(a, ""))
    count = lambda text, ch: F.length(text) - F.length(F.replace(text, ch, F.lit("")))
    both = F.aggregate(letters, F.lit(0), lambda s, ch: s + F.least(count(a, ch), count(b, ch)))
    return F.when((a == "") | (b == ""), F.lit(0.0)).when(a == b, F.lit(1.0)).otherwise(2.0 * both / (F.length(a) + F.length(b)))


def length_ratio(a: Column, b: Column) -> Column:
    x, y = F.length(a), F.length(b)
    return F.when((x == 0) | (y == 0), F.lit(0.0)).otherwise(F.least(x, y) / F.greatest(x, y))


def expressions(zero_addr_char3: bool = False) -> dict[str, Column]:
    """Over columns with the prefixes x_ (query) and y_ (candidate). zero_addr_char3 keeps that feature at 0, for parity with models trained so."""
    x = {c: F.col(f"x_{c}") for c in TEXTS}
    y = {c: F.col(f"y_{c}") for c in TEXTS}
    pair = lambda f, c: f(x[c], y[c])
    same = lambda c: _flag((x[c] != "") & (x[c] == y[c]))
    source = F.substring_index(F.col("id"), "-", 1)
    return {
        "name_exact_match": same("norm_name"),
        "name_token_jaccard": pair(jaccard, "name_tokens"),
        "name_token_overlap_count": pair(overlap, "name_tokens"),
        "name_token_overlap_ratio": pair(overlap_ratio, "name_tokens"),
        "name_char3_jaccard": pair(jaccard, "char3"),
        "name_char4_jaccard": pair(jaccard, "char4"),
        "name_seq_sim": pair(multiset_ratio, "norm_name"),
        "name_len_diff": F.abs(F.length(x["norm_name"]) - F.length(y["norm_name"])).cast("double"),
        "name_len_ratio": pair(length_ratio, "norm_name"),
        "name_token_count_diff": F.abs(F.size(x["name_tokens"]) - F.size(y["name_tokens"])).cast("double"),
        "addr_exact_match": same("norm_addr"),
        "addr_token_jaccard": pair(jaccard, "addr_tokens"),
        "addr_token_overlap_count": pair(overlap, "addr_tokens"),
        "addr_token_overlap_ratio": pair(overlap_ratio, "addr_tokens"),
        "addr_char3_jaccard": F.lit(0.0) if zero_addr_char3 else pair(jaccard, "addr_char3"),
        "addr_seq_sim": pair(multiset_ratio, "norm_addr"),
        "postal_exact_match": _flag(pair(overlap, "postal") > 0),
        "postal_overlap_count": pair(overlap, "postal"),
        "s1_addr_missing": _flag(x["norm_addr"] == ""),
        "cand_addr_missing": _flag(y["norm_addr"] == ""),
        "both_addr_missing": _flag((x["norm_addr"] == "") & (y["norm_addr"] == "")),
        "country_match": _flag((x["country"] == "") | (y["country"] == "") | (x["country"] == y["country"])),
        "combined_token_jaccard": pair(jaccard, "comb"),
        "is_source2": _flag(source == "S2"),
        "is_source3": _flag(source == "S3"),
    }


def _sets() -> dict[str, Column]:
    """A candidate's token sets and n-grams from its normal texts, as `records.enrich` makes them."""
    name, addr = F.col("y_norm_name"), F.col("y_norm_addr")
    return {
        "name_tokens": T.tokenize(name), "addr_tokens": T.tokenize(addr), "char3": T.char_ngrams(name, 3), "char4": T.char_ngrams(name, 4),
        "addr_char3": T.char_ngrams(addr, 3), "comb": F.array_union(T.tokenize(name), T.tokenize(addr)),
    }


def featurize(pairs: DataFrame, queries: DataFrame, targets: DataFrame, names: list[str] | None = None, zero_addr_char3: bool = False) -> DataFrame:
    """pairs (q, id, ...) with their features; pairs of unknown records are dropped.

    A row for each pair travels from its candidate to its query, so it takes the candidate's texts along
    and not the sets that are made of them, which are many times as long: those are made again where the pair meets its query.
    """
    side = lambda frame, key, p, columns: frame.select(F.col("id").alias(key), *[F.col(c).alias(p + c) for c in columns])
    sets = _sets()
    both = pairs.join(side(targets, "id", "y_", [c for c in TEXTS if c not in sets]), "id").join(side(queries, "q", "x_", TEXTS), "q")
    found = expressions(zero_addr_char3)
    return both.select("*", *[c.alias(f"y_{n}") for n, c in sets.items()]).select(*pairs.columns, *[found[n].alias(n) for n in (names or FEATURES)])
