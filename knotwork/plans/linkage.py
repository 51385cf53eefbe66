"""Whole runs: candidates, features, scores, decisions, result files."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import features, matching, union
from ..sources.files import id_lists, write_tsv


@dataclass(frozen=True)
class Linked:
    """candidates: (q, id, place); scored: those with p; matches: those at the threshold or above."""

    candidates: DataFrame
    scored: DataFrame
    matches: DataFrame


def link(queries: DataFrame, targets: DataFrame, strategy: str = "ablation_E_full_hybrid", k: int | None = None, cap: int = 5000, threshold: float = matching.THRESHOLD, score: Callable[[DataFrame], DataFrame] | None = None) -> Linked:
    """Candidates are merged first and only those are scored, so the candidate file is what the scorer saw.

    score adds the column p to a frame with all features; without it the rule matcher does.
    """
    pairs = union.pairs(union.candidates(queries, targets, strategy, k, cap))
    found = features.featurize(pairs, queries, targets)
    scored = score(found) if score else found.withColumn("p", matching.rule_score())
    scored = scored.select("q", "id", "place", "p")
    return Linked(pairs, scored, matching.decide(scored, threshold))


def write_results(linked: Linked, queries: DataFrame, folder: str, sort_ids: bool = False) -> None:
    """matching_results and candidate_pairs, with a row for every query."""
    asked = queries.select(F.col("id").alias("q"))
    write_tsv(id_lists(asked, linked.matches, "matched_entity_ids", sort_ids), f"{folder}/matching_results.tsv")
    write_tsv(id_lists(asked, linked.candidates, "candidate_entity_ids", sort_ids), f"{folder}/candidate_pairs.tsv")


def training_pairs(queries: DataFrame, targets: DataFrame, truth: DataFrame, strategy: str = "ablation_E_full_hybrid", k: int | None = None, cap: int = 5000) -> DataFrame:
    """Labelled and weighted features of candidate pairs, with `train` by query."""
    pairs = union.pairs(union.candidates(queries, targets, strategy, k, cap))
    labelled = matching.label(features.featurize(pairs, queries, targets), truth)
    return matching.balanced(labelled).withColumn("train", matching.in_training(F.col("q")))
