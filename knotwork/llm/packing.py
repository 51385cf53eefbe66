"""Best-fit packing of tokenised documents into sequences of a fixed length.

Planning runs over the histogram of piece lengths, never over documents: at most `limit` numbers
reach the driver. The plan says which run of ranks within each length goes to which run of
sequences; pieces then take their slots by joining on (length, rank within length).
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Kept, alone, documents, staged, texts_of, width

#: The characters with the Unicode property White_Space.
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class ByteBpe:
    """Ids of the tokenizer file as little-endian 32-bit numbers.

    The tokenizer first splits a text into words, and no word holds white space but one space before
    it. So the ids of a stretch between white space depend on that stretch alone; those of lately
    met stretches, and of the words in them, are kept. A text that holds an added token's string is
    left to the tokenizers library itself.
    """

    def __init__(self, path: str) -> None:
        import regex
        import tiktoken

        self.path, self._library = path, None
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        self.added = [x["content"] for x in model.get("added_tokens", [])]
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in word): i for word, i in model["model"]["vocab"].items() if word not in self.added}
        bpe = tiktoken.Encoding("file", pat_str=r"\s+|\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.words = words = Kept(lambda word: array("I", bpe(word.encode())).tobytes(), 120_000)
        split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+").findall
        self.known = Kept(lambda stretch: b"".join(map(words.__getitem__, split(stretch))), 200_000)
        self.ids = self.known.__getitem__
        self.stretches = re.compile(f" ?[^{SPACES}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]").findall

    @property
    def library(self):
        """The tokenizers library's own tokenizer, loaded where it is needed."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path)
        return self._library

    def forget(self) -> None:
        """Drop what is kept of texts."""
        for kept in (self.words, self.known):
            kept.clear()
            kept.older = {}

    def encode(self, text: str) -> bytes:
        if any(x in text for x in self.added):
            return np.asarray(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.ids, self.stretches(text)))


def byte_bpe(path: str) -> ByteBpe:
    return alone(f"byte_bpe {path}", lambda: ByteBpe(path))


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def pieces(docs: DataFrame, tokenizer: str, limit: int = 1024, end_id: int = 2, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise each document, append end_id, and cut those over limit; the first piece is the shorter one.

    Null text counts as empty: one piece that holds only end_id. With with_ids the ids come too.
    """
    end = np.asarray([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(tokenizer)
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            kept: list[np.ndarray] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = bpe.encode(text) + end
                n = len(ids) // 4
                first = (n - 1) % limit + 1
                edges = [0, *range(first, n + 1, limit)]
                for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    for column, value in zip(out, (doc, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])), strict=True):
                        column.append(value)
                    if with_ids:
                        kept.append(np.frombuffer(ids[4 * a : 4 * b], "<u4").astype(np.int32))
            columns = [pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids])
        bpe.forget()  # the worker outlives this task

    return texts_of(docs, id_col, text_col).mapInArrow(cut, PIECES + ", ids array<int>" * with_ids)


def plan(histogram: dict[int, int], limit: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts.

    Rows (length, first rank, last rank + 1, first sequence, pieces of this length in each sequence, offset):
    rank r goes to sequence first + (r - first rank) // each, at offset + length * ((r - first rank) % each).
    Groups of sequences with the same contents are handled at once. Each length splits at most one
    group and opens at most two, so the plan is bounded by limit alone, however many pieces there are.
    """
    rows: list[tuple[int, int, int, int, int, int]] = []
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # space left: (first sequence, how many)
    opened = 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            fit = min((r for r, groups in room.items() if r >= length and groups), default=None)
            if fit is None:
                fit, each = limit, limit // length
                first, many = opened, max(1, left // each)
                opened += many
            else:
                each = fit // length
                first, many = room[fit].pop()
            each = min(each, left)
            used = min(many, left // each)
            rows.append((length, rank, rank + used * each, first, each, limit - fit))
            rank, left = rank + used * each, left - used * each
            room[fit - used_space].append((first, used)) if (used_space := each * length) < fit else None
            if many > used:
                room[fit].append((first + used, many - used))
    return rows


def ranked(cut: DataFrame) -> DataFrame:
    """Number the pieces of each length from 0. A length is dealt over many tasks, so that a common one doesn't meet in one."""
    parts = width(cut.sparkSession)
    salted = cut.withColumn("_part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = salted.groupBy("length", "_part").agg(F.count("*").alias("_n"))
    starts = counts.select("length", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    order = Window.partitionBy("length", "_part").orderBy("doc_id", "piece", "ids_crc32")
    return salted.withColumn("_at", F.row_number().over(order) - 1).join(starts, ["length", "_part"]).withColumn("_rank", F.col("_base") + F.col("_at"))


def pack(cut: DataFrame, limit: int = 1024) -> DataFrame:
    """Give every piece a sequence_id and an offset. cut: a frame with doc_id, piece, length, ids_crc32 that can be read again.

    An empty table gives an empty one. Equal rows each take a slot of their own.
    """
    spark = cut.sparkSession
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # limit rows at most
    schema = "_length long, _from long, _to long, _first long, _each long, _offset long"
    slots = F.broadcast(spark.createDataFrame(plan(histogram, limit), schema))
    placed = ranked(cut).join(slots, (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
    k = F.col("_rank") - F.col("_from")
    return placed.withColumn("sequence_id", (F.col("_first") + F.floor(k / F.col("_each"))).cast("long")).withColumn("offset", F.col("_offset") + F.col("length") * (k % F.col("_each"))).select(*cut.columns, "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer: str, limit: int = 1024, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    return pack(staged(pieces(docs, tokenizer, limit, end_id, with_ids), "pieces"), limit)


def op1_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
