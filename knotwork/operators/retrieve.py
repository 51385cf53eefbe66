"""Set-similarity joins: candidates of each query by exact name or by weighted shared terms.

All return (q, src, id, ord, score, rank). A term that more than `cap` records of a source hold is left
out, which bounds what a query meets; queries with only such terms fall back to their rarest ones. A query stays within its country where the source's postings of that
kind know it, else it looks everywhere. Ranks go by score, then ingest order, then id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.working import staged
from .index import FALL, exact_postings, index_terms, postings, weight

#: The sources that are searched.
SOURCES = ("S2", "S3")
#: Kind of term -> how many of the rarest terms a query falls back to.
FALLBACK = {"tokens": 2, "char3": 4, "char4": 4}
OUT = ["q", "src", "id", "ord", "score", "rank"]
#: Postings of a block, and query terms of a slice, at most; terms of a slice where there are slices enough; postings and terms that a wave sends, if a few times all of them are less.
BLOCK, SLICE, WAVE = 4_000_000, 400_000, 32_000_000
#: Sums of weights are rounded to so many parts of one before they are ranked.
SCALE = 1e12
#: Rows that a task gives at once.
GIVEN = 200_000
FOUND = pa.schema([("q", pa.string()), ("src", pa.string()), ("id", pa.string()), ("ord", pa.int64()), ("score", pa.float64()), ("rank", pa.int32())])


def _ranked(scored: DataFrame, k: int | None) -> DataFrame:
    order = Window.partitionBy("q", "src").orderBy(F.desc("score"), "ord", "id")
    out = scored.withColumn("rank", F.row_number().over(order))
    return (out if k is None else out.where(F.col("rank") <= k)).select(*OUT)


def exact(queries: DataFrame, targets: DataFrame, k: int | None = None) -> DataFrame:
    """Records of the same normal name in the query's country, or, where it has none, anywhere; the first k of each source.

    Only a name's first k records of a country, and of all countries, can be among a query's first k,
    so others are dropped before queries meet them: a chain's name is no full product then. Without k nothing is dropped.
    """
    names = exact_postings(targets)
    asked = queries.where("norm_name <> ''").select(F.col("id").alias("q"), F.col("country").alias("c"), "norm_name")
    in_country = Window.partitionBy("src", "norm_name", "country").orderBy("ord", "id")
    anywhere = Window.partitionBy("src", "norm_name").orderBy("ord", "id")
    first = lambda order: names.select("src", "norm_name", "country", "id", "ord", F.row_number().over(order).alias("rank")).where(F.col("rank") <= k) if k else names
    columns = [F.col("q"), F.col("src"), F.col("id"), F.col("ord")]
    here = asked.where("c <> ''").withColumn("country", F.col("c")).join(first(in_country), ["norm_name", "country"]).select(*columns)
    held = names.where("country <> ''").select("src", "norm_name", F.col("country").alias("c")).distinct()
    every = asked.withColumn("src", F.explode(F.array(*map(F.lit, SOURCES))))
    rest = every.join(held, ["src", "norm_name", "c"], "left_anti").join(first(anywhere), ["src", "norm_name"]).select(*columns)
    return _ranked(here.unionByName(rest).withColumn("score", F.lit(1.0)), k)


def _asked(queries: DataFrame, terms: Column, postal: bool = False) -> DataFrame:
    return queries.select(F.col("id").alias("q"), "country", F.explode(F.array_distinct(terms)).alias("term"), F.lit(postal).alias("postal"))


def _counted(asked: DataFrame, posted: DataFrame) -> DataFrame:
    """asked (q, country, term, ...) for each source, with the scope to search (its country, or '*') and the term's df.

    Terms that no record of the scope holds are dropped. Everything comes from one aggregate of the
    postings by source, country and term, which Spark computes once.
    """
    lists = posted.groupBy("src", "country", "term").agg(F.count("*").alias("n"))
    known = lists.select("src", "country").distinct()
    rest = [c for c in asked.columns if c not in ("q", "country", "term")]
    every = asked.withColumn("src", F.explode(F.array(*map(F.lit, SOURCES))))
    here = known.withColumn("scope", F.col("country"))
    scoped = every.join(here, ["src", "country"], "left").select("q", "src", "term", *rest, F.coalesce("scope", F.lit("*")).alias("scope"))
    dfs = lists.groupBy("src", "term").agg(F.sum("n").alias("df"), F.collect_set("country").alias("_in"))
    met = scoped.join(dfs, ["src", "term"])
    return met.where((F.col("scope") == "*") | F.array_contains("_in", F.col("scope"))).drop("_in")


def _key(term: Column, country: Column | None = None) -> Column:
    """The name of a term's postings of all countries, or of one, in 64 bits: the latter is made from the former and the country's name alone."""
    every = F.xxhash64(F.lit(0), term)
    return every if country is None else every.bitwiseXOR(_place(country))


def _place(country: Column) -> Column:
    return F.xxhash64(F.lit(1), country)


def _chosen(counted: DataFrame, choose: Callable[[Column], Column], w: Callable[[Column], Column]) -> DataFrame:
    """(q, src, keys, weights) of a query's distinct terms, largest weight first.

    choose filters an array of (df, term, postal, key), the rarest first; w weighs one of them. Equal
    weights stand side by side, so records that meet the same weights have the same sum to the last bit.
    """
    key = F.when(F.col("scope") == "*", _key(F.col("term"))).otherwise(_key(F.col("term"), F.col("scope")))
    terms = F.array_sort(F.collect_set(F.struct("df", "term", "postal", key.alias("key"))))
    lists = counted.groupBy("q", "src").agg(terms.alias("x")).select("q", "src", choose(F.col("x")).alias("x"))
    heavy = F.sort_array(F.transform("x", lambda t: F.struct(w(t).alias("w"), t["key"].alias("key"))), asc=False)
    return lists.select("q", "src", heavy.alias("x")).where(F.size("x") > 0).select("q", "src", F.col("x.key").alias("keys"), F.col("x.w").alias("weights"))


def _flat(table: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray]:
    """(values, how many each row has) of a list column."""
    whole = table.column(column).combine_chunks()
    whole = whole if isinstance(whole, pa.Array) else pa.concat_arrays(whole.chunks)
    return whole.flatten().to_numpy(zero_copy_only=False), pc.list_value_length(whole).to_numpy(zero_copy_only=False).astype(np.int64)


def _runs(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, start, end) of each run of equal keys."""
    starts = np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1])))
    return sorted_keys[starts], starts, np.append(starts[1:], len(sorted_keys))


def _inverted(targets: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bool]:
    """(keys, starts, ends, postings, repeated): the places of targets in the order of the table, by key; repeated: a record is there twice."""
    same = pc.and_(pc.equal(targets["ord"].slice(1), targets["ord"].slice(0, max(0, len(targets) - 1))), pc.equal(targets["id"].slice(1), targets["id"].slice(0, max(0, len(targets) - 1))))
    new = np.concatenate(([True], ~same.to_numpy(zero_copy_only=False).astype(bool)))[: len(targets)]
    # rows of the same record are one candidate: all stand for the first of them
    first = np.maximum.accumulate(np.where(new, np.arange(len(targets)), 0)).astype(np.int32) if len(targets) else np.zeros(0, np.int32)
    every, n = _flat(targets, "every")
    local = every ^ np.repeat(targets["place"].to_numpy(), n)
    held = np.repeat(first, n)
    order = np.lexsort((held, local, every))  # a term's postings of one country are a part of its postings
    wide, narrow = _runs(every[order]), _runs(local[order])
    keys, starts, ends = (np.concatenate(x) for x in zip(wide, narrow, strict=True))
    by_key = np.argsort(keys)
    return keys[by_key], starts[by_key], ends[by_key], held[order], not new.all()


def _best(asked: pa.Table, targets: pa.Table, k: int) -> Iterator[pa.Table]:
    """The k best targets of each query: (q, src, id, ord, score, rank)."""
    targets = targets.sort_by([("ord", "ascending"), ("id", "ascending")])
    keys, starts, ends, held, repeated = _inverted(targets)
    flat, n = _flat(asked, "keys")
    weights, _ = _flat(asked, "weights")
    at = np.minimum(np.searchsorted(keys, flat), len(keys) - 1)
    there = keys[at] == flat
    begin, end = np.where(there, starts[at], 0).tolist(), np.where(there, ends[at], 0).tolist()
    weights, bounds = weights.tolist(), np.concatenate(([0], np.cumsum(n))).tolist()
    total = np.zeros(len(targets))
    rows, places, scores, size = [], [], [], 0

    def given() -> pa.Table:
        own, found = asked.take(pa.array(np.repeat(rows, [len(p) for p in places]))), targets.take(pa.array(np.concatenate(places)))
        ranks = np.concatenate([np.arange(1, len(p) + 1, dtype=np.int32) for p in places])
        return pa.table({"q": own["q"], "src": own["src"], "id": found["id"], "ord": found["ord"], "score": pa.array(np.concatenate(scores)), "rank": pa.array(ranks)})

    for row in range(len(asked)):
        met, touched = [], 0
        for i in range(bounds[row], bounds[row + 1]):
            if begin[i] < end[i]:
                some = held[begin[i] : end[i]]
                if repeated:
                    np.add.at(total, some, weights[i])
                else:
                    total[some] += weights[i]
                met.append(some)
                touched += len(some)
        if not met:
            continue
        hit = np.flatnonzero(total) if touched > len(total) >> 3 else np.unique(np.concatenate(met))
        score = np.floor(total[hit] * SCALE + 0.5) / SCALE
        total[hit] = 0
        if len(hit) > k:
            good = score >= np.partition(score, len(hit) - k)[len(hit) - k]
            hit, score = hit[good], score[good]
        best = np.lexsort((hit, -score))[:k]
        rows.append(row)
        places.append(hit[best])
        scores.append(score[best])
        size += len(best)
        if size >= GIVEN:
            yield given()
            rows, places, scores, size = [], [], [], 0
    if rows:
        yield given()


def _searched(chosen: DataFrame, targets: DataFrame, terms: Column, asked: int, k: int) -> DataFrame:
    """The k best records of each source for every query of chosen (q, src, keys, weights); asked: about how many terms it has.

    Records are dealt to blocks and queries to slices, and each slice meets each block once, in one
    place: there a block is an inverted index, sums are kept in an array, and only the best k leave. Neither
    postings that a query meets nor their sums are rows that travel. Slices go in waves if their copies
    and those of the blocks are more than a wave or the tables themselves; what a wave sent is gone when the next
    begins. Of one block the ranks are final and aren't made again.
    """
    spark = targets.sparkSession
    mine = targets.where(F.col("src").isin(*SOURCES)).select("src", "country", "id", "ord", terms.alias("terms"))
    posted = mine.agg(F.sum(F.size("terms")).alias("n")).first()["n"] or 0
    blocks = 1 + posted // len(SOURCES) // BLOCK
    slices = max(1 + len(SOURCES) * asked // BLOCK, min(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + asked // SLICE))
    waves = min(slices, 1 + (slices * posted + blocks * asked * len(SOURCES)) // max(WAVE, posted + asked))

    def cell(block: Column, part: Column) -> Column:
        return (block * slices + part).cast("long")

    dealt = lambda name, n: F.pmod(F.xxhash64(name), F.lit(n))
    records = mine.select("src", "id", "ord", F.transform("terms", lambda t: _key(t)).alias("every"), _place(F.col("country")).alias("place"), dealt("id", blocks).alias("block"))
    asking = (chosen if waves == 1 else staged(chosen, "asked")).withColumn("part", dealt("q", slices))

    def run(left: pa.Table, right: pa.Table) -> Iterator[pa.RecordBatch]:
        if len(left) and len(right):
            for found in _best(left, right, k):
                yield from found.to_batches()

    def meet(wave: int) -> DataFrame:
        own = [p for p in range(slices) if p % waves == wave]
        left = asking.where(F.pmod("part", F.lit(waves)) == wave).withColumn("cell", F.explode(F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda b: cell(b, F.col("part")))))
        right = records.where(F.size("every") > 0).withColumn("cell", F.explode(F.transform(F.sequence(F.lit(0), F.lit(len(own) - 1)), lambda p: cell(F.col("block"), p * waves + wave))))
        sides = left.select("cell", "src", "q", "keys", "weights").groupBy("cell", "src"), right.select("cell", "src", "id", "ord", "every", "place").groupBy("cell", "src")
        found = sides[0].cogroup(sides[1]).applyInArrow(lambda a, b: pa.Table.from_batches(run(a, b), FOUND), "q string, src string, id string, ord long, score double, rank int")
        return found.select(*OUT) if blocks == 1 else _ranked(found, k)

    if waves == 1:
        return meet(0)
    return reduce(DataFrame.unionByName, [staged(meet(w), "searched") for w in range(waves)])


def by_terms(queries: DataFrame, targets: DataFrame, kind: str, k: int = 50, cap: int = 5000, terms: Column | None = None) -> DataFrame:
    """Search by name tokens (`tokens`) or n-grams (`char3`, `char4`). terms: the query's terms, if not those of that kind."""
    own = terms if terms is not None else F.col("name_tokens" if kind == "tokens" else kind)
    if kind == "tokens":
        own = F.filter(own, lambda t: ~t.isin(T.BUSINESS_STOP))
    counted = _counted(_asked(queries, own), postings(targets, kind))
    fitting = lambda x: F.filter(x, lambda t: t["df"] <= cap)
    choose = lambda x: F.when(F.size(fitting(x)) > 0, fitting(x)).otherwise(F.slice(x, 1, FALLBACK[kind]))
    chosen = _chosen(counted, choose, lambda t: weight(t["df"], FALL[kind]))
    return _searched(chosen, targets, index_terms(kind), _terms_in(queries, own), k)


def by_address(queries: DataFrame, targets: DataFrame, k: int = 50, cap: int = 5000) -> DataFrame:
    """Search by address terms, capped, and postal codes, not capped and weighted threefold.

    A number can be both and then counts twice. There is no fallback.
    """
    words = F.filter(F.col("addr_tokens"), lambda t: ~t.isin(T.ADDRESS_STOP))
    counted = _counted(_asked(queries, words).unionByName(_asked(queries, F.col("postal"), True)), postings(targets, "addr"))
    choose = lambda x: F.filter(x, lambda t: t["postal"] | (t["df"] <= cap))
    chosen = _chosen(counted, choose, lambda t: F.when(t["postal"], weight(t["df"], 0.05, 3.0)).otherwise(weight(t["df"], FALL["addr"])))
    return _searched(chosen, targets, index_terms("addr"), _terms_in(queries, F.concat(words, "postal")), k)


def _terms_in(queries: DataFrame, terms: Column) -> int:
    return queries.agg(F.sum(F.size(terms))).first()[0] or 0


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def jaccard_rerank(queries: DataFrame, targets: DataFrame, k: int = 50, cap: int = 5000, pool: int = 200) -> DataFrame:
    """Candidates by tokens, ranked over all sources by the Jaccard of their name tokens: (q, id, score, rank)."""
    met = by_terms(queries, targets, "tokens", pool, cap).select("q", "id", "ord")
    both = met.join(queries.select(F.col("id").alias("q"), F.col("name_tokens").alias("x")), "q").join(targets.select("id", F.col("name_tokens").alias("y")), "id")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "ord", "id")
    return both.withColumn("score", F.round(jaccard(F.col("x"), F.col("y")), 9)).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("q", "id", "score", "rank")


def posting_pairs(targets: DataFrame, least: int = 2, most: int = 49, length: int = 3) -> DataFrame:
    """Pairs (a, b) of records that share a name token of that length; longer or shorter lists than those are left out."""
    flat = targets.select("id", F.explode("name_tokens").alias("term")).where(F.length("term") >= length)
    lists = flat.groupBy("term").agg(F.count("*").alias("n")).where(F.col("n").between(least, most))
    short = flat.join(lists, "term", "left_semi")
    return short.select(F.col("id").alias("a"), "term").join(short.select(F.col("id").alias("b"), "term"), "term").where("a < b").select("a", "b").distinct()


def hydrate(pairs: DataFrame, records: DataFrame, key: str = "id") -> DataFrame:
    """pairs with the records they name; pairs that name none are dropped."""
    return pairs.join(records, key)
