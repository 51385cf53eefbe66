"""Checks of result files before they are handed in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

HEADERS = {"matching": ("source1_entity_id", "matched_entity_ids"), "candidate": ("source1_entity_id", "candidate_entity_ids")}
SHOWN = 5


def parse(lines: DataFrame) -> DataFrame:
    """(q, ids, tabbed) of the non-blank lines (value) behind the header."""
    rows = lines.where(F.trim("value") != "")
    part = F.split("value", "\t", -1)
    return rows.select(F.trim(part[0]).alias("q"), T.id_list(F.get(part, F.lit(1))).alias("ids"), F.col("value").contains("\t").alias("tabbed"), "value")


def header_problem(first_line: str | None, kind: str) -> str | None:
    """What is fatally wrong with a file's first line, if anything."""
    a, b = HEADERS[kind]
    if first_line is None or not first_line.strip():
        return "empty file"
    if "\t" not in first_line:
        return "columns separated by commas" if "," in first_line else "no TAB in the header"
    return None if [x.strip() for x in first_line.rstrip("\r\n").split("\t")] == [a, b] else "wrong header"


def _found(frame: DataFrame, code: str, key: Column, severity: str = "error") -> DataFrame:
    """(severity, code, count, examples) of the offending rows; examples are the least keys."""
    keyed = frame.select(key.cast("string").alias("key"))
    least = keyed.orderBy("key").limit(SHOWN).agg(F.array_join(F.array_sort(F.collect_list("key")), ",").alias("examples"))
    return keyed.agg(F.count("*").alias("count")).join(F.broadcast(least)).select(F.lit(severity).alias("severity"), F.lit(code).alias("code"), "count", "examples")


def ids(rows: DataFrame) -> DataFrame:
    return rows.select("q", F.explode("ids").alias("id"))


def no_tab(rows: DataFrame) -> DataFrame:
    return _found(rows.where(~F.col("tabbed")), "no_tab", F.col("value"))


def duplicate_rows(rows: DataFrame) -> DataFrame:
    return _found(rows.groupBy("q").count().where("count > 1"), "duplicate_row", F.col("q"))


def duplicate_ids(rows: DataFrame) -> DataFrame:
    return _found(rows.where(F.size("ids") != F.size(F.array_distinct("ids"))), "duplicate_id", F.col("q"))


def self_matches(rows: DataFrame) -> DataFrame:
    return _found(ids(rows).where(F.col("id").startswith("S1-")), "self_match", F.col("id"))


def bad_prefixes(rows: DataFrame) -> DataFrame:
    return _found(ids(rows).where(~F.col("id").rlike("^S[123]-")), "bad_prefix", F.col("id"))


def unknown_ids(rows: DataFrame, targets: DataFrame) -> DataFrame:
    named = ids(rows).where(F.col("id").rlike("^S[23]-")).select("id").distinct()
    return _found(named.join(targets.select("id").distinct(), "id", "left_anti"), "unknown_id", F.col("id"))


def missing_queries(rows: DataFrame, queries: DataFrame) -> DataFrame:
    return _found(queries.select("q").distinct().join(rows, "q", "left_anti"), "missing_s1", F.col("q"))


def extra_queries(rows: DataFrame, queries: DataFrame) -> DataFrame:
    return _found(rows.select("q").distinct().join(queries, "q", "left_anti"), "extra_s1", F.col("q"))


def not_candidates(rows: DataFrame, candidates: DataFrame) -> DataFrame:
    """Matches that are no candidates: a warning."""
    return _found(ids(rows).distinct().join(ids(candidates).distinct(), ["q", "id"], "left_anti"), "not_subset", F.concat_ws(":", "q", "id"), "warning")


def report(matching: DataFrame, candidates: DataFrame | None, queries: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """All checks of parsed files in one frame; `count` is 0 for those that pass."""
    out = [no_tab(matching), duplicate_rows(matching), duplicate_ids(matching), self_matches(matching), bad_prefixes(matching), missing_queries(matching, queries), extra_queries(matching, queries)]
    if targets is not None:
        out.append(unknown_ids(matching, targets))
    if candidates is not None:
        out.append(not_candidates(matching, candidates))
    every = out[0]
    for x in out[1:]:
        every = every.unionByName(x)
    return every


def partition_bounds(n: int, worker: int, workers: int) -> tuple[int, int]:
    """The rows [start, end) of one of several workers; the first ones take one row more."""
    base, rest = divmod(n, workers)
    start = worker * base + min(worker, rest)
    return start, start + base + (worker < rest)


def merge_parts(parts: list[DataFrame], queries: DataFrame) -> DataFrame:
    """The parts together; raises if a query is missing, unknown or there twice."""
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p)
    bad = duplicate_rows(merged).unionByName(missing_queries(merged, queries)).unionByName(extra_queries(merged, queries)).where("count > 0").collect()
    if bad:
        raise ValueError("; ".join(f"{r['code']}: {r['count']} ({r['examples']})" for r in bad))
    return merged
