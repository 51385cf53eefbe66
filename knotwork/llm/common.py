"""What the operators share: the shared folder, staging, and column selection."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.working import FREED, discard, new_path, shared_dir, shuffles_freed, staged, working  # noqa: F401

#: Characters that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def numbered(words: list[bytes], digest: Callable, size: int) -> np.ndarray:
    """The digest of each word, `size` little-endian 64-bit numbers a word. Each distinct word is digested once."""
    distinct = dict.fromkeys(words)
    names = np.frombuffer(b"".join(map(digest, distinct)), "<u8").reshape(-1, size)
    place = dict(zip(distinct, range(len(distinct)), strict=True))
    return names[np.fromiter(map(place.__getitem__, words), np.int64, len(words))]


def ascii_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words of all texts, how many each has): what stands between spaces, tabs, line feeds and the like, without passing through Python objects."""
    split = pc.ascii_split_whitespace(texts)
    words = split.flatten()
    there = pc.greater(pc.binary_length(words), 0)
    ends = np.concatenate(([0], np.cumsum(there.to_numpy(zero_copy_only=False))))
    offsets = split.offsets.to_numpy()
    return words.filter(there), np.diff(ends[offsets - offsets[0]])


def word_digests(words: pa.Array, digest: Callable, size: int) -> np.ndarray:
    """As `numbered`, of Arrow words."""
    coded = words.dictionary_encode()
    names = np.frombuffer(b"".join(map(digest, coded.dictionary.cast(pa.binary()).to_pylist())), "<u8").reshape(-1, size)
    return names[coded.indices.to_numpy()]


def slices(batch: pa.RecordBatch, column: int, size: int) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of whole rows whose strings in a column have about `size` bytes, or one longer one."""
    sizes = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy().astype(np.int64))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + size, "right")))
        yield batch.slice(at, end - at)
        at = end


def characters(docs: DataFrame, text_col: str = "text") -> int:
    return docs.agg(F.sum(F.length(text_col).cast("long"))).first()[0] or 0


def labels(spark: SparkSession, n: int) -> list[int]:
    """n numbers that Spark's hash deals to n parts one by one: the k-th goes to part k of n, and to part k modulo m of m if m divides n."""
    rows = spark.range(24 * n).select(F.col("id").cast("int").alias("id"), F.pmod(F.hash(F.col("id").cast("int")), F.lit(n)).alias("part")).groupBy("part").agg(F.min("id").alias("id")).collect()
    own = {r["part"]: r["id"] for r in rows}
    return [own.get(k, 24 * n + k) for k in range(n)]


class Kept(dict):
    """Values by key, made when first asked for. At most twice `most` are held; those asked for lately stay."""

    def __init__(self, make: Callable, most: int = 250_000) -> None:
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        value = self.older.get(key)
        self.keep(key, self.make(key) if value is None else value)
        return self[key]

    def keep(self, key, value) -> None:
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value


_ALONE: dict = {}


def alone(name: str, make: Callable):
    """What make() gives, kept in this Python worker until another name is asked for.

    Workers outlive operators, so the tables of one must not stay beside those of the next.
    """
    if name not in _ALONE:
        _ALONE.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # not every C library has it
            ctypes.CDLL(None).malloc_trim(0)
        _ALONE[name] = make()
    return _ALONE[name]


def let(value: Column, use) -> Column:
    """use(value), with value computed once: a lambda's variable is not expanded where it is used."""
    return F.transform(F.array(value), use)[0]


def quoted(name: str) -> str:
    """A column name as an expression, dots and backticks included."""
    return "`" + name.replace("`", "``") + "`"


def fresh(frame: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of the frame has, in whatever case."""
    taken = {c.lower() for c in frame.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text) of docs, whatever else it holds; a null text becomes an empty one."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def remainder(column, modulus: int):
    """crc32 of a column's text, modulo modulus: which fold a document is in."""
    return F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(modulus))


def width(spark: SparkSession) -> int:
    """How many parts a shuffle of this session has."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
