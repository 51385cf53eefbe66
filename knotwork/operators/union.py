"""Candidate unions: tiers of candidates merged under quotas, in one fold per query.

A strategy is a list of tiers with the share of what is then still free that each may fill, half of it
from each source. Tiers go in order; what is already there is skipped; the exact tier is not capped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from . import retrieve

TIERS = ("exact", "tokens", "char4", "char3", "addr")


@dataclass(frozen=True)
class Strategy:
    """tiers: (tier, share of the free places). halved: half of a quota goes to each source."""

    tiers: tuple[tuple[str, float], ...]
    exact: bool = True
    halved: bool = True
    k: int = 50


#: Which tiers a strategy has, in which order, and the share of the free places that each may fill.
STRATEGIES = {
    "exact_name": Strategy(()),
    "rare_tokens": Strategy((("tokens", 1.0),), exact=False),
    "char_3gram": Strategy((("char3", 1.0),), exact=False),
    "char_4gram": Strategy((("char4", 1.0),), exact=False),
    "address_tokens": Strategy((("addr", 1.0),), exact=False),
    "ablation_A_disjunctive": Strategy((("tokens", 1.0),)),
    "disjunctive_union": Strategy((("tokens", 1.0),)),
    "ablation_B_char3": Strategy((("tokens", 0.6), ("char3", 1.0))),
    "ablation_C_char4": Strategy((("tokens", 0.6), ("char4", 1.0))),
    "ablation_D_char3_char4": Strategy((("tokens", 0.5), ("char4", 0.5), ("char3", 1.0))),
    "ablation_E_full_hybrid": Strategy((("tokens", 0.45), ("char4", 0.35), ("char3", 0.5), ("addr", 1.0))),
    "composite_union": Strategy((("composite", 1.0),)),
    "single_source": Strategy((("tokens", 0.45), ("char4", 0.35), ("char3", 0.5), ("addr", 1.0)), halved=False, k=25),
}


def search(queries: DataFrame, targets: DataFrame, tier: str, k: int, cap: int) -> DataFrame:
    if tier == "exact":
        return retrieve.exact(queries, targets, k)
    if tier == "addr":
        return retrieve.by_address(queries, targets, k, cap)
    if tier == "composite":
        return retrieve.by_terms(queries, targets, "tokens", k, cap, T.composite_terms(F.col("name_tokens"), F.col("addr_tokens")))
    return retrieve.by_terms(queries, targets, tier, k, cap)


def tiers(queries: DataFrame, targets: DataFrame, names: tuple[str, ...] = TIERS, k: int = 50, cap: int = 5000) -> DataFrame:
    """(q, and an array of ids for each tier and source, as tokens_S2): every query has a row; lists are in rank order."""
    out = queries.select(F.col("id").alias("q"))
    for t in names:
        found = search(queries, targets, t, k, cap).select("q", "src", F.struct("rank", "id").alias("x"))
        # a task gathers what it has found before it sends it: candidates travel as lists, once, and tiers meet where their lists are
        gathered = found.groupBy("q").agg(*[F.collect_list(F.when(F.col("src") == s, F.col("x"))).alias(f"{t}_{s}") for s in retrieve.SOURCES])
        out = out.join(gathered, "q", "left")
    columns = [f"{t}_{s}" for t in names for s in retrieve.SOURCES]
    return out.select("q", *[F.coalesce(F.transform(F.array_sort(c), lambda x: x["id"]), T.no_strings()).alias(c) for c in columns])


def merge(tiered: DataFrame, strategy: Strategy, k: int | None = None, sources: tuple[str, str] = ("S2", "S3")) -> DataFrame:
    """(q, candidates) by folding the tiers: chained columns would expand the result so far again and again."""
    k = k or strategy.k
    a, b = sources
    start = f"array_distinct(concat(exact_{a}, exact_{b}))" if strategy.exact else "cast(array() as array<string>)"
    if not strategy.tiers:
        return tiered.select("q", F.expr(f"slice({start}, 1, {k})").alias("candidates"))
    steps = ", ".join(f"named_struct('f', {f}D, 'a', {t}_{a}, 'b', {t}_{b})" for t, f in strategy.tiers)
    quota = f"greatest(1, cast(floor(({k} - size(r)) * t.f) as int))"
    half = f"greatest(1, {quota} div 2)" if strategy.halved else quota
    fold = f"""slice(aggregate(array({steps}), {start},
        (r, t) -> CASE WHEN size(r) >= {k} THEN r ELSE slice(array_distinct(concat(r, slice(t.a, 1, cast({half} as int)), slice(t.b, 1, cast({half} as int)))), 1, {k}) END), 1, {k})"""
    return tiered.select("q", F.expr(fold).alias("candidates"))


def candidates(queries: DataFrame, targets: DataFrame, strategy: str, k: int | None = None, cap: int = 5000) -> DataFrame:
    s = STRATEGIES[strategy]
    k = k or s.k
    names = tuple(dict.fromkeys([*["exact"] * (s.exact or not s.tiers), *[t for t, _ in s.tiers]]))
    return merge(tiers(queries, targets, names, k, cap), s, k)


def single_source(queries: DataFrame, targets: DataFrame, source: str = "S2", k: int = 25, cap: int = 5000) -> DataFrame:
    """The full hybrid over one source: quotas are not halved."""
    one = targets.where(F.col("src") == source)
    s = STRATEGIES["single_source"]
    t = tiers(queries, one, ("exact", *[x for x, _ in s.tiers]), k, cap)
    other = "S3" if source == "S2" else "S2"
    return merge(t, s, k, (source, other))


def pairs(merged: DataFrame) -> DataFrame:
    """(q, id, place) of merged candidates."""
    return merged.select("q", F.posexplode("candidates").alias("place", "id"))
