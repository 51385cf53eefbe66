"""How good candidates and matches are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TAUS = [round(0.15 + 0.02 * i, 2) for i in range(38)]


def _prf(true: Column, pred: Column, hit: Column) -> tuple[Column, Column, Column]:
    """Precision, recall and F0.5. Nothing expected and nothing found is perfect; found without expected has recall 1 only."""
    p = F.when(pred == 0, F.lit(1.0)).otherwise(hit / F.greatest(pred, F.lit(1)))
    r = F.when(true == 0, F.lit(1.0)).otherwise(hit / F.greatest(true, F.lit(1)))
    f = F.when((true == 0) & (pred == 0), F.lit(1.0)).when((true == 0) | (pred == 0) | (hit == 0), F.lit(0.0)).otherwise(1.25 * p * r / (0.25 * p + r))
    return p, r, f


def _counts(queries: DataFrame, truth: DataFrame, found: DataFrame) -> DataFrame:
    """(q, n_true, n_pred, n_hit) for every query. Pairs are made distinct and merged before they meet a query."""
    pairs = truth.select("q", "id", F.lit(1).alias("t"), F.lit(0).alias("p")).unionByName(found.select("q", "id", F.lit(0).alias("t"), F.lit(1).alias("p")))
    each = pairs.groupBy("q", "id").agg(F.max("t").alias("t"), F.max("p").alias("p"))
    sums = each.groupBy("q").agg(F.sum("t").alias("n_true"), F.sum("p").alias("n_pred"), F.sum(F.col("t") * F.col("p")).alias("n_hit"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return queries.select("q").distinct().join(sums, "q", "left").select("q", zero("n_true"), zero("n_pred"), zero("n_hit"))


def by_entity(queries: DataFrame, truth: DataFrame, found: DataFrame) -> DataFrame:
    """(q, n_true, n_pred, n_hit, precision, recall, f05) of every query; all frames hold (q, id)."""
    p, r, f = _prf(F.col("n_true"), F.col("n_pred"), F.col("n_hit"))
    return _counts(queries, truth, found).select("*", p.alias("precision"), r.alias("recall"), f.alias("f05"))


def summary(entities: DataFrame) -> DataFrame:
    """One row: macro means, global pair figures and singletons."""
    total = entities.agg(
        F.count("*").alias("entities"), F.avg("f05").alias("macro_f05"), F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"),
        F.sum("n_true").alias("true_pairs"), F.sum("n_pred").alias("predicted_pairs"), F.sum("n_hit").alias("true_positives"),
        F.count_if(F.col("n_true") == 0).alias("singletons"), F.count_if((F.col("n_true") == 0) & (F.col("n_pred") == 0)).alias("correct_singletons"),
        F.count_if((F.col("n_true") == 0) & (F.col("n_pred") > 0)).alias("false_singletons"),
    )
    p = F.when(F.col("predicted_pairs") == 0, F.lit(0.0)).otherwise(F.col("true_positives") / F.greatest("predicted_pairs", F.lit(1)))
    r = F.when(F.col("true_pairs") == 0, F.lit(0.0)).otherwise(F.col("true_positives") / F.greatest("true_pairs", F.lit(1)))
    out = total.withColumn("global_precision", p).withColumn("global_recall", r)
    gf = F.when(F.col("true_positives") == 0, F.lit(0.0)).otherwise(1.25 * F.col("global_precision") * F.col("global_recall") / (0.25 * F.col("global_precision") + F.col("global_recall")))
    out = out.withColumn("global_f05", gf)
    return out.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in out.dtypes])


def by_country(entities: DataFrame, queries: DataFrame) -> DataFrame:
    """Macro F0.5 by country, and over all in the row with a null country."""
    return entities.join(queries.select("q", "country"), "q").rollup("country").agg(F.count("*").alias("entities"), F.round(F.avg("f05"), 6).alias("macro_f05"))


def threshold_sweep(queries: DataFrame, truth: DataFrame, scored: DataFrame, score: str = "p", taus: list[float] = TAUS) -> DataFrame:
    """(tau, macro_f05) for every threshold.

    Each pair counts for the thresholds up to its score, so pairs are tallied by query and step
    first and summed over steps then; queries without a pair or truth are counted, not joined.
    """
    t = truth.select("q", "id").distinct().withColumn("_t", F.lit(1))
    reached = F.size(F.filter(F.array(*map(F.lit, taus)), lambda x: x <= F.col(score)))
    pairs = scored.groupBy("q", "id").agg(F.max(score).alias(score)).join(t, ["q", "id"], "left").select("q", reached.alias("step"), F.coalesce("_t", F.lit(0)).alias("hit"))
    tally = pairs.groupBy("q", "step").agg(F.count("*").alias("n"), F.sum("hit").alias("h"))
    true = t.groupBy("q").agg(F.count("*").alias("n_true"))
    active = tally.select("q").unionByName(true.select("q")).distinct().join(queries.select("q").distinct(), "q", "left_semi").join(true, "q", "left")
    gathered = tally.groupBy("q").agg(F.collect_list(F.struct("step", "n", "h")).alias("steps"))  # a step a threshold at most
    grid = F.array(*[F.struct(F.lit(i + 1).alias("at"), F.lit(x).alias("tau")) for i, x in enumerate(taus)])
    each = active.join(gathered, "q", "left").select("q", "n_true", "steps", F.explode(grid).alias("g"))
    upward = lambda part: F.aggregate(F.filter(F.coalesce("steps", F.expr("cast(array() as array<struct<step:int,n:bigint,h:bigint>>)")), lambda x: x["step"] >= F.col("g.at")), F.lit(0).cast("long"), lambda s, x: s + x[part])
    each = each.select("q", F.col("g.tau").alias("tau"), F.coalesce("n_true", F.lit(0)).alias("n_true"), upward("n").alias("n_pred"), upward("h").alias("n_hit"))
    *_, f = _prf(F.col("n_true"), F.col("n_pred"), F.col("n_hit"))
    idle = queries.select("q").distinct().agg(F.count("*").alias("all"))
    sums = each.groupBy("tau").agg(F.sum(f).alias("s"), F.count("*").alias("m"))
    return sums.join(F.broadcast(idle)).select("tau", F.round((F.col("s") + F.col("all") - F.col("m")) / F.col("all"), 9).alias("macro_f05"))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The lowest threshold of the highest score."""
    return sweep.orderBy(F.desc("macro_f05"), "tau").limit(1)


def blocking(queries: DataFrame, truth: DataFrame, found: DataFrame, universe: DataFrame) -> DataFrame:
    """One row: recall of the true pairs whose record is in the universe (id), by source, and queries fully or partly covered."""
    t = truth.select("q", "id").distinct().join(universe.select("id").distinct(), "id", "left_semi").join(queries.select("q").distinct(), "q", "left_semi")
    hit = t.join(found.select("q", "id").distinct().withColumn("_h", F.lit(1)), ["q", "id"], "left").withColumn("h", F.coalesce("_h", F.lit(0))).withColumn("s", F.substring_index("id", "-", 1))
    per = hit.groupBy("q").agg(F.max("h").alias("any"), F.min("h").alias("all"))
    share = lambda a, b: F.when(b == 0, F.lit(0.0)).otherwise(F.round(a / F.greatest(b, F.lit(1)), 6))
    of = lambda s: share(F.sum(F.when(F.col("s") == s, F.col("h")).otherwise(0)), F.count_if(F.col("s") == s))
    pairs = hit.agg(F.count("*").alias("true_pairs"), F.coalesce(F.sum("h"), F.lit(0)).alias("recovered"), share(F.coalesce(F.sum("h"), F.lit(0)), F.count("*")).alias("recall"), of("S2").alias("recall_s2"), of("S3").alias("recall_s3"))
    cover = per.agg(F.count("*").alias("entities"), F.coalesce(F.sum("any"), F.lit(0)).alias("covered"), F.coalesce(F.sum("all"), F.lit(0)).alias("fully_covered"), share(F.coalesce(F.sum("any"), F.lit(0)), F.count("*")).alias("coverage"))
    return pairs.join(F.broadcast(cover))


def blocking_of_equal(queries: DataFrame, targets: DataFrame, found: DataFrame, by: tuple[str, ...] = ("norm_name", "norm_addr")) -> DataFrame:
    """What `blocking` gives where the true pairs are all records of the same texts (`by`, the first not empty), without making those pairs.

    Of a text that many records share they are the product of its queries and its targets. So targets are counted by text and source,
    each query takes its counts, and only candidates of the query's own text are looked for. An id names one record.
    """
    known = lambda frame, *more: frame.where(F.col(by[0]) != "").select(*more, *by).distinct()
    mine, theirs = known(queries, F.col("id").alias("q")), known(targets, "id", F.substring_index("id", "-", 1).alias("s"))
    of = lambda s: F.count_if(F.col("s") == s)
    held = theirs.groupBy(*by).agg(F.count("*").alias("n"), of("S2").alias("n_S2"), of("S3").alias("n_S3"))
    asked = mine.join(held, list(by))
    shared = theirs.join(mine.select(*by).distinct(), list(by), "left_semi")
    hits = found.select("q", "id").join(asked.select("q", *by), "q").join(shared, ["id", *by], "left_semi").select("q", "id").distinct()
    met = hits.withColumn("s", F.substring_index("id", "-", 1)).groupBy("q").agg(F.count("*").alias("h"), of("S2").alias("h_S2"), of("S3").alias("h_S3"))
    each = asked.join(met, "q", "left").select("n", "n_S2", "n_S3", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("h", "h_S2", "h_S3")])
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    share = lambda a, b: F.when(b == 0, F.lit(0.0)).otherwise(F.round(a / F.greatest(b, F.lit(1)), 6))
    return each.agg(
        total("n").alias("true_pairs"), total("h").alias("recovered"), share(total("h"), total("n")).alias("recall"), share(total("h_S2"), total("n_S2")).alias("recall_s2"), share(total("h_S3"), total("n_S3")).alias("recall_s3"),
        F.count("*").alias("entities"), F.count_if(F.col("h") > 0).alias("covered"), F.count_if(F.col("h") == F.col("n")).alias("fully_covered"), share(F.count_if(F.col("h") > 0), F.count("*")).alias("coverage"),
    )


def volume(queries: DataFrame, found: DataFrame) -> DataFrame:
    """One row: how many candidates queries have, those without any included."""
    n = queries.select("q").distinct().join(found.groupBy("q").agg(F.count("*").alias("n")), "q", "left").select(F.coalesce("n", F.lit(0)).alias("n"))
    p = lambda x: F.round(F.expr(f"percentile(n, {x})"), 6)
    return n.agg(F.sum("n").alias("total"), F.round(F.avg("n"), 6).alias("mean"), p(0.5).alias("median"), p(0.9).alias("p90"), p(0.95).alias("p95"), p(0.99).alias("p99"), F.min("n").alias("least"), F.max("n").alias("most"))


def gain(truth: DataFrame, found: DataFrame, baseline: DataFrame) -> DataFrame:
    """One row: true pairs that found has and baseline hasn't."""
    hits = found.select("q", "id").distinct().join(truth.select("q", "id").distinct(), ["q", "id"], "left_semi")
    return hits.join(baseline.select("q", "id").distinct(), ["q", "id"], "left_anti").agg(F.count("*").alias("new_pairs"))


def run_diff(queries: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """(q, n_a, n_b, n_both, jaccard, changed) of two runs' (q, id)."""
    c = _counts(queries, a, b)
    union = F.col("n_true") + F.col("n_pred") - F.col("n_hit")
    return c.select("q", F.col("n_true").alias("n_a"), F.col("n_pred").alias("n_b"), F.col("n_hit").alias("n_both"), F.when(union == 0, F.lit(1.0)).otherwise(F.round(F.col("n_hit") / F.greatest(union, F.lit(1)), 9)).alias("jaccard"), (union != F.col("n_hit")).alias("changed"))


def match_summary(queries: DataFrame, found: DataFrame) -> DataFrame:
    n = queries.select("q").distinct().join(found.groupBy("q").agg(F.count("*").alias("n")), "q", "left").select(F.coalesce("n", F.lit(0)).alias("n"))
    return n.agg(F.count_if(F.col("n") == 0).alias("zero"), F.count_if(F.col("n") == 1).alias("single"), F.count_if(F.col("n") > 1).alias("multi"), F.sum("n").alias("matches"))


def profile(frame: DataFrame, key: str, texts: list[str], group: str) -> DataFrame:
    """(metric, part, value): rows, repeated keys, blanks and mean lengths by column, and rows by group."""
    blank = lambda c: F.count_if(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "")
    head = [F.count("*").cast("double"), (F.count(key) - F.countDistinct(key)).cast("double")]
    each = [x for c in texts for x in (blank(c).cast("double"), F.round(F.avg(F.length(F.coalesce(F.col(c).cast("string"), F.lit("")))), 6))]
    row = frame.agg(*[e.alias(f"v{i}") for i, e in enumerate(head + each)])
    labels = [("rows", ""), ("duplicate_keys", key), *[x for c in texts for x in (("blank", c), ("mean_length", c))]]
    flat = row.select(F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(p).alias("part"), F.col(f"v{i}").alias("value")) for i, (m, p) in enumerate(labels)])).alias("x")).select("x.*")
    groups = frame.groupBy(F.coalesce(F.col(group).cast("string"), F.lit("")).alias("part")).agg(F.count("*").cast("double").alias("value")).select(F.lit("group").alias("metric"), "part", "value")
    return flat.unionByName(groups)
