"""Records with everything that is derived from their texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def normal(records: DataFrame, exact: bool = False) -> DataFrame:
    """(entity_id, business_name, business_address, country[, ord]) with source and normal texts: all that the rest is made from, in few bytes."""
    order = F.col("ord").cast("long") if "ord" in records.columns else F.lit(0).cast("long")
    return records.select(
        F.col("entity_id").alias("id"), T.source_of(F.col("entity_id")).alias("src"), order.alias("ord"),
        T.normalize(F.col("business_name"), exact).alias("norm_name"), T.normalize(F.col("business_address"), exact).alias("norm_addr"),
        T.country_key(F.col("country")).alias("country"), T.text_or_empty(F.col("business_address")).alias("raw_addr"),
    )


def derived(base: DataFrame, raw_postal: bool = False) -> DataFrame:
    """Records of `normal` with token sets, n-grams and postal codes."""
    name_tokens, addr_tokens = T.tokenize(F.col("norm_name")), T.tokenize(F.col("norm_addr"))
    return base.select(
        "id", "src", "ord", "norm_name", "norm_addr", "country", name_tokens.alias("name_tokens"), addr_tokens.alias("addr_tokens"),
        T.char_ngrams(F.col("norm_name"), 3).alias("char3"), T.char_ngrams(F.col("norm_name"), 4).alias("char4"), T.char_ngrams(F.col("norm_addr"), 3).alias("addr_char3"),
        T.postal_tokens(F.col("raw_addr" if raw_postal else "norm_addr")).alias("postal"), F.array_union(name_tokens, addr_tokens).alias("comb"),
    )


def enrich(records: DataFrame, exact: bool = False, raw_postal: bool = False) -> DataFrame:
    """(entity_id, business_name, business_address, country[, ord]) with source, normal texts and token sets.

    Postal tokens come from the normalised address on both sides of a comparison, or with raw_postal
    from the address as given. Missing texts count as empty ones. ord orders ties; without it the id does.
    """
    return derived(normal(records, exact), raw_postal)
