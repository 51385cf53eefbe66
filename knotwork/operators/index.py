"""Postings and vocabularies: the inverted index as tables.

A posting is (src, country, term, id, ord). Document frequencies are counted per source over all
countries; which countries a query may stay within is decided per source and kind of term.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

#: Kind of term -> how fast its weight falls with its document frequency.
FALL = {"tokens": 0.1, "char3": 0.05, "char4": 0.05, "addr": 0.1}


def index_terms(kind: str) -> Column:
    return {
        "tokens": T.name_terms(F.col("name_tokens")), "char3": F.col("char3"), "char4": F.col("char4"),
        "addr": F.array_union(F.col("postal"), T.address_terms(F.col("addr_tokens"))),
    }[kind]


def postings(targets: DataFrame, kind: str) -> DataFrame:
    return targets.select("src", "country", F.explode(index_terms(kind)).alias("term"), "id", "ord")


def exact_postings(targets: DataFrame) -> DataFrame:
    return targets.where("norm_name <> ''").select("src", "country", "norm_name", "id", "ord")


def vocabulary(posted: DataFrame) -> DataFrame:
    """(src, term, df)."""
    return posted.groupBy("src", "term").agg(F.count("*").alias("df"))


def weight(df: Column, fall: float, head: float = 1.0) -> Column:
    return F.lit(head) / (F.lit(1.0) + F.lit(fall) * F.greatest(F.lit(1), df))


def weighted_vocabulary(posted: DataFrame, kind: str) -> DataFrame:
    return vocabulary(posted).withColumn("weight", weight(F.col("df"), FALL[kind]))


def posting_stats(posted: DataFrame) -> DataFrame:
    """Per source and country, and over all countries as '*': terms, postings, and how long the lists are."""
    scopes = posted.select("src", F.explode(F.array("country", F.lit("*"))).alias("scope"), "term")
    lists = scopes.groupBy("src", "scope", "term").agg(F.count("*").alias("n"))
    p = lambda q: F.expr(f"percentile(n, {q})")
    return lists.groupBy("src", "scope").agg(
        F.count("*").alias("terms"), F.sum("n").alias("postings"), F.min("n").alias("min_len"), p(0.5).alias("median_len"), F.avg("n").alias("mean_len"),
        p(0.9).alias("p90_len"), p(0.95).alias("p95_len"), p(0.99).alias("p99_len"), F.max("n").alias("max_len"),
    )


def traversed(query_terms: DataFrame, posted: DataFrame) -> DataFrame:
    """Per query (q, src, term): terms looked up and postings read."""
    lists = posted.groupBy("src", "term").agg(F.count("*").alias("n"))
    return query_terms.join(lists, ["src", "term"]).groupBy("q").agg(F.count("*").alias("terms"), F.sum("n").alias("postings"))
