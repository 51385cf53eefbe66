"""SpotSigs fingerprints: chains of content words that follow common words.

At each anchor (a common word, or one word in 16 by its hash, so that any language has some) the
anchor and the next two content words form a signature. A text's fingerprint is the set of its
signatures; texts are as alike as their sets are (Jaccard).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Kept, alone, documents, staged, texts_of, width

CHAIN = 2
#: Common words of English, French, German and Spanish.
COMMON = """
a an and are as at be but by for from has have he her his i if in is it its not of on or she so that the their they this to was we were which with you
au aux ce ces dans de des du elle en est et il ils je la le les leur mais ne ou par pas plus pour qu que qui sa se ses son sur un une
als am auch auf aus bei das dem den der des die ein eine einen er es für hat ich im ist mit nicht oder sich sie sind und von war wie zu
al como con del el ella en era es esta este la las lo los más no o para pero por que se si sin su sus un una y
""".split()
BLOCK_WORDS = 250_000


def _name(word: bytes) -> bytes:
    """64 bits of a word; the lowest says whether it is common, the next whether it is an anchor."""
    plain = word.strip(b".,;:!?\"'()[]")
    h = int.from_bytes(hashlib.blake2b(plain, digest_size=8).digest(), "little")
    common = plain in _COMMON
    return (h & ~3 | common | (common or h >> 60 == 0) << 1).to_bytes(8, "little")


_COMMON = {x.encode() for x in COMMON}


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def signatures(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(32-bit signatures, edges): text i has those from edges[i] to edges[i + 1], ascending, each once.

    A text with no whole chain has one signature of all its words; so has one without words.
    """
    found: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    words: list[bytes] = []
    edges = [0]
    for i, text in enumerate(texts):
        words += text.encode().lower().split()
        edges.append(len(words))
        if len(words) >= BLOCK_WORDS or i + 1 == len(texts):
            sigs, n = _block(words, np.asarray(edges))
            found.append(sigs)
            counts.append(n)
            words, edges = [], [0]
    if not texts:
        return np.zeros(0, np.uint32), np.zeros(1, np.int64)
    return np.concatenate(found), np.concatenate(([0], np.cumsum(np.concatenate(counts))))


def _block(words: list[bytes], edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    known = alone("spot names", lambda: Kept(_name, 200_000))
    names = np.frombuffer(b"".join(map(known.__getitem__, words)), "<u8")
    n_texts = len(edges) - 1
    owner = np.repeat(np.arange(n_texts), np.diff(edges))
    content = np.flatnonzero(names & np.uint64(1) == 0)
    anchors = np.flatnonzero(names & np.uint64(2))
    k = np.searchsorted(content, anchors, "right")
    whole = k + CHAIN <= len(content)
    anchors, k = anchors[whole], k[whole]
    whole = content[k + CHAIN - 1] < edges[1:][owner[anchors]] if len(k) else np.zeros(0, bool)
    anchors, k = anchors[whole], k[whole]
    sigs = _mixed(names[anchors])
    for i in range(CHAIN):
        sigs = _mixed(sigs * np.uint64(3) + names[content[k + i]])
    owners = owner[anchors]
    bare = np.flatnonzero(np.bincount(owners, minlength=n_texts) == 0)
    rest = [int.from_bytes(hashlib.blake2b(b" ".join(words[edges[i] : edges[i + 1]]), digest_size=8).digest(), "little") for i in bare]
    sigs = np.concatenate((sigs, np.asarray(rest, np.uint64))) >> np.uint64(32)
    owners = np.concatenate((owners, bare))
    key = np.unique(owners.astype(np.uint64) << np.uint64(32) | sigs)
    return key.astype(np.uint32), np.bincount((key >> np.uint64(32)).astype(np.int64), minlength=n_texts)


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Jaccard of the i-th set of a and the i-th set of b, for all i at once."""
    size_a, size_b = np.diff(a[1]), np.diff(b[1])
    n = len(size_a)
    key = np.concatenate([np.repeat(np.arange(n, dtype=np.uint64), s) << np.uint64(32) | x[0] for x, s in ((a, size_a), (b, size_b))])
    key.sort()
    both = np.bincount((key[1:][key[1:] == key[:-1]] >> np.uint64(32)).astype(np.int64), minlength=n)
    return both / (size_a + size_b - both)


def hexed(sigs: tuple[np.ndarray, np.ndarray]) -> list[str]:
    line = sigs[0].astype(">u4").tobytes().hex()
    return [line[8 * i : 8 * j] for i, j in zip(sigs[1].tolist(), sigs[1][1:].tolist(), strict=False)]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every row: its signatures as 8 hexadecimal digits each, ascending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hexed(signatures(batch.column(1).to_pylist())), pa.string())], ["doc_id", "fingerprint"])

    return texts_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, fingerprint string")


FIRST = -(1 << 63)


def with_next(docs: DataFrame, use, schema: str) -> DataFrame:
    """use(ids, texts, next texts) for all rows, where the next text is that of the next doc_id, and after the last of the first.

    Ids are dealt to as many ranges as a shuffle has parts; each range also gets a copy of the first
    row of the range behind it, so texts move once and no task sees more than its range. Null ids
    come first; rows of one id are ordered by a hash of their text.
    """
    spark = docs.sparkSession
    parts = width(spark)
    rows = texts_of(docs)
    points = [i / parts for i in range(1, parts)]
    found = rows.select(F.percentile_approx("doc_id", points, 10_000)).first()[0] if points else []
    bounds = np.unique(np.asarray(found or [], np.int64))

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).fill_null(FIRST).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(np.searchsorted(bounds, ids, "right"), pa.int32()), pa.array(ids)], ["part", "id"])

    firsts = {r["part"]: r["id"] for r in rows.select("doc_id").mapInArrow(ranges, "part int, id long").groupBy("part").agg(F.min("id").alias("id")).collect()}
    there = sorted(firsts)
    goes_to = {firsts[p]: there[i - 1] for i, p in enumerate(there)}  # the first range's first row goes to the last range

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).fill_null(FIRST).to_numpy(zero_copy_only=False)
            part = np.searchsorted(bounds, ids, "right")
            copied = [(i, goes_to[x]) for i, x in enumerate(ids.tolist()) if x in goes_to]
            at = np.concatenate((np.arange(len(ids)), np.asarray([i for i, _ in copied], np.int64)))
            to = np.concatenate((part, np.asarray([p for _, p in copied], np.int64)))
            copy = np.arange(len(at)) >= len(ids)
            for k in range(0, len(at), 2000):
                some = pa.array(at[k : k + 2000])
                yield pa.RecordBatch.from_arrays([pa.array(to[k : k + 2000], pa.int32()), pa.array(copy[k : k + 2000]), batch.column(0).take(some), batch.column(1).take(some)], ["part", "copy", "doc_id", "text"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            held += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            own = [(a[1], a[2], b[2]) for a, b in zip(held, held[1:], strict=False) if not a[0]]
            if own:
                yield use(*map(list, zip(*own, strict=True)))
            held = held[-1:]

    dealt = rows.mapInArrow(deal, "part int, copy boolean, doc_id long, text string").repartition(parts, "part")
    return dealt.sortWithinPartitions("part", "copy", "doc_id", F.xxhash64("text")).select("copy", "doc_id", "text").mapInArrow(walk, schema)


def compare_edited(docs: DataFrame) -> DataFrame:
    """Each text, its edited text and the next text by their fingerprints.

    Null and empty texts have the fingerprint of no words, and are fully alike to each other. A
    single row is its own next document; an empty table gives an empty one.
    """
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def use(ids: list, texts: list[str], following: list[str]) -> pa.RecordBatch:
        edited = [t[: len(t) - q] + n[:q] if (q := len(t) // 4) else t for t, n in zip(texts, following, strict=True)]
        own, changed, after = signatures(texts), signatures(edited), signatures(following)
        columns = [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()), pa.array(hexed(own), pa.string()), pa.array(hexed(changed), pa.string()), pa.array(likeness(own, changed)), pa.array(likeness(own, after))]
        return pa.RecordBatch.from_arrays(columns, names)

    return with_next(docs, use, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def length_part(n, threshold: float):
    """The partition of a set length: within one, and between neighbours, lengths can be as near as the threshold asks."""
    return F.floor(F.log(n.cast("double")) / F.lit(-np.log(threshold))).cast("int")


def near_pairs(prints: DataFrame, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(classes, pairs) of fingerprints (doc_id, fingerprint).

    classes: (doc_id, class), one class for equal fingerprints, named by its least id. pairs: (a, b, likeness)
    of classes whose sets are alike by the threshold or more. Sets are partitioned by length; a set is
    compared with those of its own and the next partition. A pair must share a signature among the
    rarest few of both sets, so only those are looked up, and lengths prune again before sets meet.
    """
    classes = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("class"))
    sets = staged(classes.select("class", F.array_distinct(F.regexp_extract_all("fingerprint", F.lit(".{8}"), F.lit(0))).alias("sigs")).withColumn("n", F.size("sigs")).withColumn("part", length_part(F.size("sigs"), threshold)), "sets")
    flat = sets.select("class", "n", "part", F.explode("sigs").alias("sig"))
    common = flat.groupBy("sig").agg(F.count("*").alias("df"))
    rare = Window.partitionBy("class").orderBy("df", "sig")
    # sharing ceil(2t / (1 + t) n) of n at least leaves so many that can differ before one must be shared
    heads = flat.join(common, "sig").withColumn("at", F.row_number().over(rare)).where(F.col("at") <= F.col("n") - F.ceil(F.lit(threshold - 1e-9) * F.col("n")) + 1)
    heads = staged(heads.select("class", "n", "part", "sig"), "heads")
    other = heads.select(F.col("class").alias("b"), F.col("n").alias("m"), "sig", F.explode(F.array("part", F.col("part") - 1, F.col("part") + 1)).alias("part"))
    met = heads.withColumnRenamed("class", "a").join(other, ["sig", "part"]).where((F.col("a") < F.col("b")) & (F.least("n", "m") >= F.lit(threshold - 1e-9) * F.greatest("n", "m"))).select("a", "b").distinct()
    left, right = sets.select(F.col("class").alias("a"), F.col("sigs").alias("x")), sets.select(F.col("class").alias("b"), F.col("sigs").alias("y"))
    both = met.join(left, "a").join(right, "b").withColumn("likeness", F.size(F.array_intersect("x", "y")) / F.size(F.array_union("x", "y")))
    return prints.join(classes, "fingerprint").select("doc_id", "class"), both.where(F.col("likeness") >= F.lit(threshold)).select("a", "b", "likeness")


def op7_document_fingerprints(spark, sf_dir: str) -> DataFrame:
    return compare_edited(documents(spark, sf_dir))
