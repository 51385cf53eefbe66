"""SimHash near-duplicates, found through Golay-code keys.

Fingerprints of 64 bits are cut into segments of 23, 23 and 18 bits. If two of them differ in 2 bits
or fewer, one segment at least is equal in both, and each other one differs in 2 bits or fewer. The
perfect Golay code gives every 23-bit word one codeword within 3 bits; the codewords of a word and of
all words one bit away (1 or 6 of them) meet those of every word within 2 bits. So a key is an equal
segment together with a codeword of the next segment.

Within a shared key no pairs are made. A fingerprint stands there with itself and the words one bit
away that lead to the key: those whose segment decodes to the key's codeword. Two fingerprints within
2 bits have such a word in common, in one of their shared keys; at most 65 fingerprints have the same
one, and all of those are within 2 bits of each other. So a key may hold any number of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import alone, documents, fresh, shared_dir, staged, texts_of
from .components import components

SEGMENTS = ((0, 23), (23, 23), (46, 18))
SEED, SHINGLE = 42, 3


def shingle_hashes(text: str, k: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """XXH64 of every run of k words, or of all words if there are fewer; none if there is no word."""
    import xxhash

    words = text.encode().lower().split()  # bytes: only A-Z are lowered, only ASCII white space splits
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(k, len(words))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a:b], seed) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)), np.uint64, len(words) - k + 1)


def fingerprint(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes. Counted in blocks, so a long text takes no more memory."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = hashes[at : at + (1 << 16)]
        bits = np.unpackbits(block.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int(((counts * 2 > len(hashes)).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum()) if len(hashes) else 0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) of every row; null and empty texts have fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("simhash", dict)
        for batch in batches:
            found = np.asarray([fingerprint(shingle_hashes(t)) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64), pa.int64())], ["doc_id", "fp"])

    return texts_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


@lru_cache(maxsize=1)
def golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(error pattern by syndrome, syndromes of the low 12 bits, syndromes of the high 11) of the Golay code with generator x^11+x^9+x^7+x^6+x^5+x+1.

    A word's syndrome is its remainder by the generator, which is linear: that of its low bits plus that
    of its high ones. The 2048 patterns of up to 3 bits have all different syndromes.
    """
    generator = 0b101011100011

    def rest(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= generator << (bit - 11)
        return word

    errors = np.zeros(1 << 11, np.int64)
    for n in range(4):
        for bits in combinations(range(23), n):
            pattern = sum(1 << b for b in bits)
            errors[rest(pattern)] = pattern
    return errors, np.asarray([rest(x) for x in range(1 << 12)]), np.asarray([rest(x << 12) for x in range(1 << 11)])


def codewords(words: np.ndarray) -> np.ndarray:
    """Indices (12 bits) of the codewords near each 23-bit word: its own and those of its 23 neighbours, a row each."""
    errors, low, high = golay()
    near = words[:, None] ^ np.concatenate(([0], 1 << np.arange(23))).astype(np.int64)
    return (near ^ errors[low[near & 0xFFF] ^ high[near >> 12]]) >> 11


def keys(prints: DataFrame) -> DataFrame:
    """(fp, key) for every key of every fingerprint: three choices of the equal segment, up to 6 codewords each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                fp = batch.column(0).slice(at, 4096).to_numpy(zero_copy_only=False).view(np.uint64)
                cut = [((fp >> np.uint64(shift)) & np.uint64((1 << n) - 1)).astype(np.int64) for shift, n in SEGMENTS]
                owners, found = [], []
                for i in range(3):
                    near = np.sort(codewords(cut[(i + 1) % 3])[:, : SEGMENTS[(i + 1) % 3][1] + 1], axis=1)
                    first = np.ones(near.shape, bool)
                    first[:, 1:] = near[:, 1:] != near[:, :-1]
                    row, _ = np.nonzero(first)
                    owners.append(fp[row])
                    found.append((np.int64(i) << 40) | (cut[i][row] << 12) | near[first])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(owners).view(np.int64)), pa.array(np.concatenate(found))], ["fp", "key"])

    return prints.select("fp").mapInArrow(run, "fp long, key long")


def between(keyed: DataFrame) -> DataFrame:
    """(choice, word, fp) from (fp, key): the fingerprint itself and the words one bit away that lead to the key, for each key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                fp = batch.column(0).slice(at, 4096).to_numpy(zero_copy_only=False).view(np.uint64)
                key = batch.column(1).slice(at, 4096).to_numpy(zero_copy_only=False)
                out = []
                for i in range(3):
                    own, code = fp[key >> 40 == i], key[key >> 40 == i] & 0xFFF
                    (shift, size), (other, more) = SEGMENTS[(i + 1) % 3], SEGMENTS[(i + 2) % 3]
                    flips = np.concatenate(([0], np.uint64(1) << np.arange(shift, shift + size, dtype=np.uint64))).astype(np.uint64)
                    near = codewords(((own >> np.uint64(shift)) & np.uint64((1 << size) - 1)).astype(np.int64))[:, : size + 1]
                    row, flip = np.nonzero(near == code[:, None])
                    out.append((i, own[row] ^ flips[flip], own[row]))
                    # the codeword of its own word stays the same whatever happens in the last segment
                    same = np.repeat(own[near[:, 0] == code], more)
                    beside = np.tile(np.uint64(1) << np.arange(other, other + more, dtype=np.uint64), len(same) // more)
                    out.append((i, same ^ beside, same))
                choice = np.concatenate([np.full(len(w), i, np.int32) for i, w, _ in out])
                word, owner = (np.concatenate([x[k] for x in out]).view(np.int64) for k in (1, 2))
                yield pa.RecordBatch.from_arrays([pa.array(choice), pa.array(word), pa.array(owner)], ["choice", "word", "fp"])

    return keyed.select("fp", "key").mapInArrow(run, "choice int, word long, fp long")


def links(prints: DataFrame) -> DataFrame:
    """Edges (a, b) between different fingerprints that tie together exactly those linked by 2 differing bits or fewer.

    Of the fingerprints that have a word in common the least stands for the others.
    """
    keyed = staged(keys(prints), "keys")
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    met = between(keyed.join(shared, "key", "left_semi")).groupBy("choice", "word").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    edges = met.select(F.explode("fps").alias("a"), F.array_min("fps").alias("b"))
    return edges.where((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2)).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) of every row of docs; component_id is the least doc_id reachable over links.

    Equal fingerprints are merged first, so copies cost nothing later. Rows without an id take part
    but name no component; a component of such rows alone has a null one. An empty table gives an empty one.
    """
    shared_dir(docs.sparkSession)  # sets the checkpoint folder where there is none
    marked = staged(fingerprints(docs, id_col, text_col), "fingerprints")
    prints = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    linked = components(links(prints))
    tied = prints.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    named = tied.join(tied.groupBy("component").agg(F.min("least").alias("component_id")), "component").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of docs without near-duplicates: of each component the row with the least doc_id stays.

    Of rows that share that id, one stays, chosen by a hash of its text. Rows without an id can't be
    named as their group's and stay as they are.
    """
    least, place = fresh(docs, "least", "place")
    kept = near_duplicates(docs).where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias(least)).distinct()
    rows = docs.join(kept, F.col("doc_id").cast("long") == F.col(least), "left_semi")
    one = rows.withColumn(place, F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text")))).where(F.col(place) == 1)
    return one.unionByName(docs.where(F.col("doc_id").isNull()).withColumn(place, F.lit(1))).drop(place)


def op10_simhash(spark, sf_dir: str) -> DataFrame:
    """Every row of documents with its fingerprint and its component; see `near_duplicates`."""
    found = near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
