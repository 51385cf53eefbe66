"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import alone, documents, remainder, texts_of
from .sampling import labelled_sample

#: Training texts for each language, about (see labelled_sample): the classifier's only bound, and a parameter.
PER_LANGUAGE = 3_000
BITS = 16
ORDERS = (1, 2, 3)
#: Code points that a part of a long text shows of the next one.
AHEAD = max(ORDERS) - 1
#: Code points times languages that are scored in one numpy pass, and code points counted in one.
CELLS, BLOCK = 1 << 22, 1 << 20
#: Languages whose counts a counting task holds at once.
HELD = 16


def hashed(points: np.ndarray, ends: np.ndarray | None = None, bits: int = BITS) -> list[np.ndarray]:
    """Feature numbers of the n-grams that start at each place, for each order; none goes beyond the end of its text, where it is cut short."""
    ends = np.asarray([len(points)]) if ends is None else ends
    low = np.where((points >= 65) & (points <= 90), points + 32, points).astype(np.uint32)
    out, state = [], np.zeros(len(low), np.uint32)
    for n in ORDERS:
        following = np.zeros(len(low), np.uint32)
        following[: max(0, len(low) - n + 1)] = low[n - 1 :]
        over = (ends[:, None] - 1 - np.arange(n - 1)).ravel()
        following[over[over >= 0]] = 0
        state = state * np.uint32(0x9E3779B1) + following + np.uint32(n)
        mixed = (state ^ (state >> np.uint32(15))) * np.uint32(0x85EBCA77)
        out.append(mixed >> np.uint32(32 - bits))
    return out


@dataclass
class Block:
    """Parts of texts, one after the other. A long text has several; each but the last ends with AHEAD points of the next part, where no n-gram is counted."""

    points: np.ndarray
    starts: np.ndarray
    #: Which text each part is of.
    owners: np.ndarray
    #: The places that count.
    own: np.ndarray

    @property
    def lengths(self) -> np.ndarray:
        return np.diff([*self.starts, len(self.points)])

    def features(self) -> list[np.ndarray]:
        return hashed(self.points, np.append(self.starts[1:], len(self.points)))


def blocks(texts: list[str], size: int = BLOCK) -> Iterator[Block]:
    """All texts in pieces of about `size` code points."""
    parts: list[np.ndarray] = []
    owners: list[int] = []
    ahead: list[int] = []
    total = 0

    def made() -> Block:
        lengths = np.asarray([len(x) for x in parts])
        own = np.arange(lengths.sum()) < np.repeat(np.cumsum(lengths) - ahead, lengths)
        return Block(np.concatenate(parts), np.cumsum([0, *lengths[:-1]]), np.asarray(owners), own)

    for i, text in enumerate(texts):
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        for at in range(0, len(points), size):
            parts.append(points[at : at + size + AHEAD])
            owners.append(i)
            ahead.append(max(0, at + len(parts[-1]) - min(at + size, len(points))))
            total += len(parts[-1])
            if total >= size:
                yield made()
                parts, owners, ahead, total = [], [], [], 0
    if parts:
        yield made()


def fit(sample: DataFrame, smoothing: float = 0.5) -> tuple[list[str], np.ndarray]:
    """The languages, and log P(feature | language) by feature and language. sample: (doc_id, text, label), bounded."""
    languages = [r[0] for r in sample.select("label").distinct().orderBy("label").collect()]
    place = {x: i for i, x in enumerate(languages)}
    size = len(ORDERS) << BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def send() -> Iterator[pa.RecordBatch]:
            for k, row in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([place[k]], pa.int32()), pa.array([row.astype("<i8").tobytes()], pa.binary())], ["label", "counts"])
            held.clear()

        for batch in batches:
            texts, labels = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for block in blocks(texts):
                found, lengths = block.features(), block.lengths
                for k in sorted({labels[i] for i in block.owners}):
                    if k not in held and len(held) >= HELD:
                        yield from send()
                    row = held.setdefault(k, np.zeros(size, np.int64))
                    mask = np.repeat([labels[i] == k for i in block.owners], lengths) & block.own
                    for n, features in enumerate(found):
                        row[n << BITS : (n + 1) << BITS] += np.bincount(features[mask], minlength=1 << BITS)
        yield from send()

    total = np.zeros((len(languages), size))
    for row in sample.select("text", "label").repartition(6).mapInArrow(count, "label int, counts binary").toLocalIterator():
        total[row["label"]] += np.frombuffer(row["counts"], "<i8")
    probability = total + smoothing
    for n in range(len(ORDERS)):
        part = probability[:, n << BITS : (n + 1) << BITS]
        part /= part.sum(axis=1, keepdims=True)
    return languages, np.ascontiguousarray(np.log(probability).T.astype(np.float32))


def judged(texts: list[str], languages: list[str], weights: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The likeliest language of each text, and its posterior."""
    if not languages:
        return ["und"] * len(texts), np.zeros(len(texts))
    sums = np.zeros((len(texts), len(languages)))
    for block in blocks(texts, max(1 << 12, CELLS // len(languages))):
        value = np.zeros((len(block.points), len(languages)), np.float32)
        for n, features in enumerate(block.features()):
            value += weights[n << BITS : (n + 1) << BITS][features]
        value[~block.own] = 0
        np.add.at(sums, block.owners, np.add.reduceat(value, block.starts, axis=0, dtype=np.float64))
    best = sums.argmax(axis=1)
    score = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
    letters = [x[:1].isalpha() or any(map(str.isalpha, x)) for x in texts]
    return [languages[b] if ok else "und" for b, ok in zip(best, letters, strict=True)], np.where(letters, score, 0.0)


def predict(docs: DataFrame, languages: list[str], table: np.ndarray) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of docs. The table has a fixed number of rows and a column a language.

    A text without a letter, a null one, or any text when nothing was learned, is `und` with score 0.
    The score is the language's posterior with equal priors.
    """
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            predicted, score = judged(batch.column(1).to_pylist(), languages, shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(predicted, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    return texts_of(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """Fit on the documents of the training fold that have a language and a text."""
    fold = docs.where((remainder(F.col("doc_id"), 4) != 2) & F.col("text").isNotNull())
    return fit(labelled_sample(fold, fold.select("doc_id", F.col("lang").alias("label")), per_language))


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    return predict(docs, *train(docs, per_language)).select("doc_id", F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of docs whose text is in a learned language; those that are `und` or of score below `least` go.

    Where no language could be learned, for want of labels, nothing can be told and all rows stay.
    """
    languages, table = train(docs)
    if not languages:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast((languages, table))
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("language", dict)
        for batch in batches:
            texts = ["" if x is None else x for x in batch.column(columns.index("text")).to_pylist()]
            predicted, score = judged(texts, *shared.value)
            yield batch.filter(pa.array([lang != "und" and s >= least for lang, s in zip(predicted, score, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    """Every row of documents with its language.

    A null id is in the training fold but is not learned from, since ids choose the sample. A doc_id with several
    languages is learned from as the least of them. Repeated rows get equal results, ties go to the
    lesser language; with no labels at all every text is `und`, and an empty table gives an empty one.
    """
    return identify(documents(spark, sf_dir))
