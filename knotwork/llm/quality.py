"""Quality rules with risk-controlled thresholds, in DataFrame operations only.

Each signal (higher is worse) gets one cutoff per stratum. From the most lenient cutoff of a fixed
ladder on, a cutoff holds if the labelled good documents of the stratum show, by an exact binomial
test, that it rejects at most the allowed share of them. The allowed share is split over the signals,
and the tests' error over all strata and signals (Bonferroni); along a ladder the first failure ends
the search, which needs no correction. A stratum without enough labels gets no cutoff and rejects nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_PATTERN, documents, let, staged

#: The share of a stratum's good documents that all signals together may reject, and the chance that it is exceeded.
RISK, ERROR = 0.02, 0.05
LADDER = 40
#: Signal -> (strictest cutoff, most lenient cutoff).
SIGNALS = {"symbols_a_word": (0.01, 2.0), "other_share": (0.05, 1.0), "upper_share": (0.05, 1.0), "repeat_share": (0.02, 1.0), "dup_line_share": (0.02, 1.0), "word_length": (5.0, 60.0)}


def repeated_words(words: Column) -> Column:
    """Words in three-word windows that occur twice or more, first ones included.

    Windows go by a 64-bit hash. They are sorted by (hash, place), so equal ones stand together; then
    the places found are sorted, and each adds the words that the one before hasn't covered.
    """

    def of(h: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(h) - 2)
        windows = F.array_sort(F.transform(places, lambda i: F.struct(F.xxhash64(h[i - 1], h[i], h[i + 1]).alias("h"), i.alias("i"))))
        twice = let(windows, lambda w: F.filter(w, lambda x, k: x["h"].eqNullSafe(F.get(w, k - 1)["h"]) | x["h"].eqNullSafe(F.get(w, k + 1)["h"])))
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
        step = lambda s, i: F.struct(i.alias("last"), (s["n"] + F.least(F.lit(3), i - s["last"])).alias("n"))
        return F.aggregate(F.array_sort(F.transform(twice, lambda x: x["i"])), start, step, lambda s: s["n"])

    return F.when(F.size(words) < 3, F.lit(0)).otherwise(let(F.transform(words, lambda w: F.xxhash64(w)), of)).cast("long")


def measured(docs: DataFrame) -> DataFrame:
    """The counts of each row's whole text. A null text has no words, and all its counts are 0."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD_PATTERN))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("stratum"), text.alias("text"))
    counts = let(F.regexp_extract_all("text", F.lit(WORD_PATTERN), F.lit(0)), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), repeated_words(w).alias("n_repeat_words")))
    left = lambda pattern: F.length(F.regexp_replace("text", pattern, "")).cast("long")
    dup = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    rows = rows.select("doc_id", "stratum", counts.alias("c"), (F.length("text") - left(r"[#*$%&|<>]+")).alias("n_symbols"), (F.length("text") - left(r"[A-Z]+")).alias("n_upper"), (F.length("text") - left(r"[!-/:-@\[-`{-~]+")).alias("n_other"), dup.alias("d"))
    rows = rows.select("doc_id", "stratum", "c.*", "n_symbols", "n_upper", "n_other", "d.*")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def signals() -> dict[str, Column]:
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {"symbols_a_word": share("n_symbols", "n_words"), "other_share": share("n_other", "word_chars"), "upper_share": share("n_upper", "word_chars"), "repeat_share": share("n_repeat_words", "n_words"), "dup_line_share": share("n_dup_lines", "n_lines"), "word_length": share("word_chars", "n_words")}


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) of n trials with chance p, summed in logarithms term by term. Meant for k below n * p."""
    odds = math.log(p / (1 - p))
    first = n * F.lit(math.log1p(-p))
    start = F.struct(first.cast("double").alias("term"), first.cast("double").alias("sum"))

    def step(s: Column, i: Column) -> Column:
        term = s["term"] + F.log((n - i + 1).cast("double")) - F.log(i.cast("double")) + F.lit(odds)
        high, low = F.greatest(s["sum"], term), F.least(s["sum"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("sum"))

    return F.exp(F.aggregate(F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.expr("cast(array() as array<bigint>)")), start, step, lambda s: s["sum"]))


def ladder(name: str) -> list[float]:
    strict, lenient = SIGNALS[name]
    return [round(strict * (lenient / strict) ** (i / (LADDER - 1)), 6) for i in range(LADDER)]


def cutoffs(measures: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """(stratum, signal, cutoff): the strictest cutoff of each ladder that holds. labels: (doc_id, quality), 1 for good.

    Only documents that pass the base rules are rejected by a cutoff, so only they count.
    """
    label = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality")).where("quality = 1").select("doc_id")
    good = measures.where(~F.col("base_failed")).join(label, "doc_id", "left_semi")
    # how many steps of the ladder lie below the signal, strictest first: those cutoffs reject the document
    above = lambda name, value: F.size(F.filter(F.array(*map(F.lit, ladder(name))), lambda c: c < value))
    steps = [F.struct(F.lit(s).alias("signal"), above(s, v).alias("above")) for s, v in signals().items()]
    found = good.select("stratum", F.explode(F.array(*steps)).alias("x")).groupBy("stratum", "x.signal", "x.above").agg(F.count("*").alias("n"))
    total = found.groupBy("stratum", "signal").agg(F.sum("n").alias("n"))
    rungs = F.explode(F.map_from_arrays(F.array(*map(F.lit, SIGNALS)), F.array(*[F.array(*map(F.lit, ladder(s))) for s in SIGNALS]))).alias("signal", "rungs")
    grid = found.sparkSession.range(1).select(rungs).select("signal", F.posexplode("rungs").alias("rung", "cutoff"))
    rejected = total.join(grid, "signal").alias("t").join(found.withColumnRenamed("n", "m").alias("f"), F.col("t.stratum").eqNullSafe(F.col("f.stratum")) & (F.col("t.signal") == F.col("f.signal")) & (F.col("f.above") > F.col("t.rung")), "left")
    tested = rejected.groupBy("t.stratum", "t.signal", "t.rung", "t.cutoff", "t.n").agg(F.coalesce(F.sum("f.m"), F.lit(0)).cast("long").alias("k"))
    strata = F.greatest(F.size(F.collect_set(F.coalesce("stratum", F.lit(""))).over(Window.partitionBy(F.lit(1)))), F.lit(1))
    share = risk / len(SIGNALS)
    p = F.when(F.col("k") < F.col("n") * share, binomial_cdf(F.col("k"), F.col("n"), share)).otherwise(F.lit(1.0))
    held = tested.withColumn("strata", strata).withColumn("fails", p > error / (F.col("strata") * len(SIGNALS)))
    from_lenient = Window.partitionBy("stratum", "signal").orderBy(F.desc("rung")).rowsBetween(Window.unboundedPreceding, 0)
    return held.withColumn("ended", F.max("fails").over(from_lenient)).where(~F.col("ended")).groupBy("stratum", "signal").agg(F.min("cutoff").alias("cutoff"))


def judge(measures: DataFrame, limits: DataFrame) -> DataFrame:
    """measures with `kept`: false if base_failed, or if a signal exceeds its stratum's cutoff."""
    wide = limits.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("signal", "cutoff"))).alias("_limits")).withColumnRenamed("stratum", "_stratum")
    over = F.lit(False)
    for name, value in signals().items():
        over = over | F.coalesce(value > F.col("_limits")[name], F.lit(False))
    return measures.join(wide, F.col("stratum").eqNullSafe(F.col("_stratum")), "left").withColumn("kept", ~F.col("base_failed") & ~over)


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    measures = staged(measured(documents(spark, sf_dir)), "measures")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    judged = judge(measures, cutoffs(measures, labels))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
