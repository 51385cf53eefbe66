"""Business records derived from `documents`, so that linkage can be checked on the given tables.

Record i is in source i % 3 + 1. Its name is the first four words of the normalised text, its address
the next eight, its country the language. Two records are the same business if name and address are equal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.records import derived, enrich, normal  # noqa: F401  (enrich: for queries)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity_id, business_name, business_address, country, ord)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    words = docs.select("doc_id", F.split(T.normalize(F.col("text")), " ").alias("w"), "lang")
    part = lambda a, n: F.array_join(F.slice("w", a, n), " ")
    source = F.concat(F.lit("S"), (F.col("doc_id") % 3 + 1).cast("string"))
    return words.select(F.concat(source, F.lit("-"), F.col("doc_id").cast("string")).alias("entity_id"), part(1, 4).alias("business_name"), part(5, 8).alias("business_address"), F.col("lang").alias("country"), F.col("doc_id").alias("ord"))


def sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Enriched queries (source 1) and targets (sources 2 and 3)."""
    every = derived(normal(records(spark, sf_dir)).persist())  # every tier of a search reads it several times; token sets and n-grams, many times the texts, are made when read
    return every.where("src = 'S1'"), every.where("src <> 'S1'")


def with_numbers(frame: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records with the text's length as a further address token and postal code, which the texts have few of."""
    sizes = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("ord"), F.col("n_chars").cast("string").alias("_n"))
    number = F.array(F.col("_n"))
    joined = frame.join(sizes, "ord")
    postal = F.when(F.length("_n").between(3, 6), F.array_union("postal", number)).otherwise(F.col("postal"))
    return joined.withColumn("addr_tokens", F.array_union("addr_tokens", number)).withColumn("postal", postal).drop("_n")


def truth(queries: DataFrame, targets: DataFrame) -> DataFrame:
    """(q, id) of equal name and address."""
    side = lambda frame, key: frame.where("norm_name <> ''").select(F.col("id").alias(key), "norm_name", "norm_addr")
    return side(queries, "q").join(side(targets, "id"), ["norm_name", "norm_addr"]).select("q", "id")
