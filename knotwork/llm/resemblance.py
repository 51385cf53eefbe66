"""Groups of texts that share most runs of five words: SimHash links through Golay keys first, then MinHash keys for what they miss.

A text's shingles are all runs of `words` words; texts with the same set are one node. SimHash
fingerprints of the sets are linked as `simhash` links them, at 2 differing bits or fewer. That ties most
close copies, but two sets at similarity 0.8 differ in 9 or 10 of 64 bits on average, out of reach of any
Golay key. So each node also has BANDS keys, each of ROWS minima of its shingles under hash functions: a
pair at similarity s is proposed if it has three of them in common, which at 0.8 it hasn't with a chance of
1.2e-5, less above. Both kinds of keys only propose pairs: a pair is linked if the Jaccard similarity of its whole shingle sets is high enough.

Shingles that no other node with a shared key has can't be in an intersection. What is left of two sets
without them bounds their similarity, and pairs below the bound, and nodes that can reach it with nobody,
are dropped unseen: in a large group of copies with many edits each that is nearly all pairs.

So do marks, a bit for each shingle by its hash: a bit that one set has and another lacks stands for one shingle at
least that the other lacks. Pairs are held against that before they are made, so of the pairs that aren't near
copies only those whose difference the marks hide, by some bits in a hundred, are looked at in full.

All other pairs of a key are compared unless links already tie them together. That is done in rounds: some
members of each key are compared with all others and then leave; first the one with the least of its own,
which ties most others, then those outside the larger components. A pair with several keys in common
is compared at the first of them alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import alone, discard, fresh, new_path, quoted, shared_dir, staged, working
from .components import components
from .simhash import fingerprint, links, shingle_hashes

WORDS, SIMILARITY = 5, 0.8
#: Keys that a pair must have in common. Of b bands, each shared with chance p = s^4, fewer are shared with the chance of a binomial tail.
SHARED = 3
#: Bytes of shingle sets that one job brings together to verify pairs, if four times all sets are less.
VERIFIED = 1 << 28
BANDS, ROWS = 32, 4
#: A shingle's bit among 2 ** MARKS is named by its hash's first bits.
MARKS = 11
#: Members of a key that are compared in the first round and the second; from then on four times as many each round.
PIVOTS = (1, 8)
BLOCK = 4096


def _mixers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(42)
    flips, factors = rng.integers(0, 1 << 63, (2, BANDS * ROWS), np.uint64)
    return flips[:, None], factors[:, None] << np.uint64(1) | np.uint64(1)


def band_keys(shingles: np.ndarray) -> list[int]:
    """A key for each band; none for a text without a word."""
    import xxhash

    if not len(shingles):
        return []
    flips, factors = alone("resemblance", _mixers)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), BLOCK):
        least = np.minimum(least, ((shingles[None, at : at + BLOCK] ^ flips) * factors).min(axis=1))
    rows = least.astype("<u8").reshape(BANDS, ROWS)
    return [xxhash.xxh64_intdigest(r.tobytes(), seed=band) for band, r in enumerate(rows)]


def shingle_set(text: str, words: int = WORDS) -> np.ndarray:
    return np.unique(shingle_hashes(text, words))


def _signed(numbers: list[int]) -> pa.Array:
    return pa.array(np.asarray(numbers, np.uint64).view(np.int64), pa.int64())


def signatures(rows: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, row, node, size, fp, keys) from (doc_id, row, text): equal nodes have equal shingle sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            sets = (shingle_set(t, words) for t in batch.column(2).to_pylist())
            found = [(xxhash.xxh64_intdigest(s.astype("<u8").tobytes()), len(s), fingerprint(s), band_keys(s)) for s in sets]
            nodes, sizes, prints, keys = zip(*found, strict=True) if found else ((), (), (), ())
            ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            flat = pa.ListArray.from_arrays(pa.array(ends), _signed([k for x in keys for k in x]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _signed(nodes), pa.array(sizes, pa.int64()), _signed(prints), flat], ["doc_id", "row", "node", "size", "fp", "keys"])

    return rows.select("doc_id", "row", "text").mapInArrow(run, "doc_id long, row long, node long, size long, fp long, keys array<long>")


def marks(shingles: np.ndarray) -> np.ndarray:
    """The bits of a set's shingles, in 64-bit numbers."""
    bits = np.zeros(1 << MARKS, np.uint8)
    bits[(shingles >> np.uint64(64 - MARKS)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64)


def shingle_sets(texts: DataFrame, words: int = WORDS) -> DataFrame:
    """(node, shingles) from (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, words).astype("<u8").tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["node", "shingles"])

    return texts.select("node", "text").mapInArrow(run, "node long, shingles binary")


def marked_sets(sets: DataFrame) -> DataFrame:
    """(node, marks) from (node, shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [marks(np.frombuffer(x.as_buffer(), "<u8")) for x in batch.column(1)]
            flat = pa.array(np.concatenate(found) if found else np.zeros(0, np.int64))
            ends = pa.array(np.arange(len(found) + 1, dtype=np.int32) * ((1 << MARKS) // 64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, flat)], ["node", "marks"])

    return sets.select("node", "shingles").mapInArrow(run, "node long, marks array<long>")


def lacking(a: str, b: str) -> Column:
    """How many shingles of the set with marks a are not in the one with marks b, at least."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y)))), F.lit(0), lambda n, x: n + x)


def held(sets: DataFrame) -> tuple[int, int]:
    """How many shingle sets there are, and their bytes."""
    return tuple(sets.agg(F.count("*"), F.coalesce(F.sum(F.length("shingles")), F.lit(0))).first())


def similar(pairs: DataFrame, sets: DataFrame, similarity: float = SIMILARITY, has: tuple[int, int] | None = None) -> DataFrame:
    """Those of the pairs (a, b) whose shingle sets have that Jaccard similarity at least. has: what `held` says of the sets, if known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(z.as_buffer(), "<u8") for z in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= similarity * (len(x) + len(y) - both) - 1e-9)
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    def verified(some: DataFrame) -> DataFrame:
        return some.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")

    # every pair brings two sets together: in as many jobs as keep that small beside the sets themselves
    pairs = staged(pairs, "pairs")
    n, size = has or held(sets)
    slices = 1 + pairs.count() * 2 * size // max(1, n) // max(VERIFIED, 4 * size)
    found = [staged(verified(pairs.where(F.pmod(F.xxhash64("a", "b"), F.lit(slices)) == i)), "similar") for i in range(slices)]
    return reduce(DataFrame.unionByName, found)


def proposed(prints: DataFrame) -> DataFrame:
    """(a, b) of nodes whose SimHash fingerprints are equal or linked. prints: (node, fp). The least node of a fingerprint stands for the others."""
    least = staged(prints.groupBy("fp").agg(F.min("node").alias("first")), "firsts")
    equal = prints.join(least, "fp").where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    tied = links(least).join(least.toDF("a", "x"), "a").join(least.toDF("b", "y"), "b")
    return equal.unionByName(tied.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))).distinct()


def unique_shingles(sets: DataFrame) -> DataFrame:
    """(node, unique): how many of a node's shingles no other node has; nodes without any are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                shingles = np.frombuffer(data.as_buffer(), "<i8")
                for at in range(0, len(shingles), 100_000):
                    some = shingles[at : at + 100_000]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), node, np.int64)), pa.array(some)], ["node", "shingle"])

    holders = sets.mapInArrow(run, "node long, shingle long").groupBy("shingle").agg(F.min("node").alias("node"), F.max("node").alias("last"))
    return holders.where("node = last").groupBy("node").agg(F.count("*").alias("unique"))


def groups(members: DataFrame, sets: DataFrame, pairs: DataFrame, all_keys: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(node, component) of all nodes of members (key, node, size) with a similar one: component is the least node reachable.

    all_keys: (node, keys) with a key for each band, in order. pairs: (a, b) that are compared before those of the members' keys; they spare later comparisons, and change nothing else.
    """
    spark = members.sparkSession
    has = held(sets)
    edges = similar(pairs, sets, similarity, has)
    unique = staged(unique_shingles(sets), "unique")
    all_keys = staged(all_keys.join(marked_sets(sets), "node"), "known")
    common = members.join(unique, "node", "left").select("key", "node", "size", (F.col("size") - F.coalesce("unique", F.lit(0))).alias("common"))
    tied, pivots, now, work = staged(components(edges), "tied"), PIVOTS[0], common.where(F.col("common") >= similarity * F.col("size") - 1e-9), []

    def keep(frame: DataFrame, name: str) -> DataFrame:
        work.append(new_path(spark, name))
        return staged(frame, name, work[-1])

    while True:
        before = list(work)
        now = now.join(tied, "node", "left").select("key", "node", "size", "common", F.coalesce("component", "node").alias("component"))
        of_key = now.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key")
        mates = now.groupBy("key", "component").agg(F.count("*").alias("mates"))
        opened = keep(now.join(of_key, "key", "left_semi").join(mates, ["key", "component"]), "open")
        if opened.isEmpty():
            discard(spark, *work)
            return tied
        ways = (F.col("common") / F.col("size")).desc(), "node"
        order = Window.partitionBy("key").orderBy(*(ways if pivots == PIVOTS[0] else ("mates", *ways)))
        first = keep(opened.withColumn("place", F.row_number().over(order)).where(F.col("place") <= pivots).select("key", "node", "size", "common", "component", "place"), "pivots")
        first = first.join(all_keys, "node")
        others = opened.join(first.select("key", "node", "place"), ["key", "node"], "left").join(all_keys, "node")
        ahead = first.select("key", *[F.col(c).alias(f"pivot_{c}") for c in ("size", "common", "component", "place", "keys", "marks")], F.col("node").alias("pivot"))
        met = others.join(ahead, "key").where((F.col("component") != F.col("pivot_component")) & (F.col("place").isNull() | (F.col("place") > F.col("pivot_place"))))
        near = met.where((F.least("size", "pivot_size") >= similarity * F.greatest("size", "pivot_size") - 1e-9) & (F.least("common", "pivot_common") >= similarity / (1 + similarity) * (F.col("size") + F.col("pivot_size")) - 1e-9))
        same = F.zip_with("keys", "pivot_keys", lambda x, y: x == y)
        once = (F.array_position(same, True) == F.array_position("keys", F.col("key"))) & (F.size(F.filter(same, lambda x: x)) >= SHARED)
        both = F.least(F.col("size") - lacking("marks", "pivot_marks"), F.col("pivot_size") - lacking("pivot_marks", "marks"))
        able = both >= similarity / (1 + similarity) * (F.col("size") + F.col("pivot_size")) - 1e-9
        pairs = near.where(once).where(able).select(F.greatest("node", "pivot").alias("a"), F.least("node", "pivot").alias("b")).distinct()
        found = similar(pairs, sets, similarity, has)
        if not found.isEmpty():  # what was tied before stands for the links that tied it
            tied = staged(components(tied.toDF("a", "b").unionByName(found)), "tied")
        now = keep(others.where("place is null").select("key", "node", "size", "common"), "left")
        discard(spark, *before)
        work[:] = [x for x in work if x not in before]
        pivots = PIVOTS[1] if pivots < PIVOTS[1] else 4 * pivots


def near_copies(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame, str]:
    """(nodes, rows, name): (node, least, component) of every shingle set; docs with a column of that name, that names a row by its id and text.

    least is the set's first row: (has no id, doc_id, row). Texts without a word are one node. Null texts count as empty.
    """
    shared_dir(docs.sparkSession)  # sets the checkpoint folder where there is none
    (name,) = fresh(docs, "row")
    ids, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.withColumn(name, F.xxhash64(F.coalesce(ids, F.lit(0).cast("long")), ids.isNull(), text))
    marked = staged(signatures(rows.select(ids.alias("doc_id"), F.col(name).alias("row"), text.alias("text")), words), "signatures")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("least")
    nodes = staged(marked.groupBy("node").agg(least, *[F.any_value(x).alias(x) for x in ("size", "fp", "keys")]), "nodes")
    keyed = staged(nodes.select("node", "size", F.explode("keys").alias("key")), "keyed")
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    members = staged(keyed.join(shared, "key", "left_semi").select("key", "node", "size"), "members")
    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", "fp", F.col("least.row").alias("row"))
    texts = rows.select(F.col(name).alias("row"), text.alias("text")).join(wanted, "row").dropDuplicates(["row"])
    tied = groups(members, staged(shingle_sets(texts, words), "sets"), proposed(wanted.select("node", "fp")), nodes.select("node", "keys"), similarity)
    found = nodes.select("node", "least").join(tied, "node", "left").withColumn("component", F.coalesce("component", "node"))
    return found, rows, name


def keep_one(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """One row of docs for each group of near copies: the one with the least doc_id, rows without an id last, then by a hash of id and text.

    Texts are near copies if the Jaccard similarity of their runs of `words` words is `similarity` at
    least; groups are over chains of them. Rows are told apart by id and text, so rows of one id with
    different texts are different documents. Null texts count as empty, and texts without a word are
    one group; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    before, path = working(spark), new_path(spark, "kept")
    nodes, rows, name = near_copies(docs, words, similarity)
    (place,) = fresh(rows, "place")
    kept = staged(nodes.groupBy("component").agg(F.min("least").alias("least")).select(F.col("least.row").alias(name)), "kept", path)
    discard(spark, *(working(spark) - before - {path}))
    one = Window.partitionBy(name).orderBy(name)
    first = rows.join(kept, name, "left_semi").withColumn(place, F.row_number().over(one)).where(F.col(place) == 1)
    return first.select(*[F.col(quoted(c)) for c in docs.columns])
