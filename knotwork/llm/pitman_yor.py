"""Scores of a hierarchical Pitman-Yor language model.

Words that follow two words sit in the restaurant of those two; its tables are customers in the restaurant
of the nearer word, whose tables are customers in the one that all share, whose own base is uniform over
the vocabulary and one unknown word. A context is the words themselves (64-bit names; the farther word
by 40 bits within the nearer one's restaurants), so restaurants grow with the corpus.

Tokens are dealt to buckets by the word before them: all restaurants of that word, with one word and with
two, are in one bucket. Words that are more than a small share of all tokens have their restaurants
spread over all buckets by the word that follows; what such a restaurant's parts have in common, its
numbers of customers and tables, is summed up between rounds, and so are the customers that each
word has in the shared restaurant. Nothing else crosses buckets, and parts are added up before they go.

A Gibbs round takes each dish's whole seating in a restaurant out and draws its number of tables from the
conditional (see `stirling`), given what all other dishes and the other levels had before the round.
Rounds run in parallel: within a round no draw sees another. Draws follow from the dish, the round and a
seed, so a lost task is simply run again, and the way tokens are dealt changes nothing. Predictive
probabilities are averaged over the rounds kept. Discounts come from the counts of one and two, once;
strengths are constants.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import alone, ascii_words, characters, discard, documents, labels, new_path, remainder, shuffles_freed, slices, staged, texts_of, width
from .stirling import Stirling, drawn

#: Rounds of seating; the first rounds, which are not averaged.
ROUNDS, BURN_IN = 3, 1
#: Strengths of the shared restaurant, of those of one word and of those of two.
STRENGTHS = (10.0, 2.0, 1.0)
#: Bytes of text that a task packs at once; a batch has 10,000 documents at most. Bytes of a piece of a bucket's row.
BLOCK_BYTES, PIECE = 2_500_000, 250_000
#: Characters of text that a bucket has on average at most. Tokens are dealt in so many waves, each to its share of the buckets.
BUCKET_CHARS, WAVES = 14_000_000, 3
#: A word's restaurants are spread if it is more than this share of an average bucket. One document in so many is looked at.
SPREAD, LOOKED_AT = 0.25, 8
END = b"\n"  # no word holds it
GOLDEN = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: What is left of eight bytes of which the first 0 to 8 count.
KEEP = np.asarray([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def word_names(words: pa.Array) -> np.ndarray:
    """64-bit names of Arrow strings: their lengths, then eight bytes after eight, mixed in. No word passes through a Python object."""
    if not len(words):
        return np.zeros(0, np.uint64)
    offsets = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, 4 * words.offset)
    text = np.zeros(int(offsets[-1]) + 8, np.uint8)
    text[:-8] = np.frombuffer(words.buffers()[2] or b"", np.uint8, len(text) - 8)
    eights = np.ndarray(len(text) - 7, "<u8", text, strides=(1,))  # those that begin at each byte

    def mixed_in(names: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
        return mixed(names ^ eights[at] & KEEP.take(left, mode="clip"))

    at, left = offsets[:-1], np.diff(offsets)
    names = mixed_in(left.astype(np.uint64) * np.uint64(GOLDEN), at, left)
    rows = np.flatnonzero(left > 8)
    at, left = at[rows] + 8, left[rows] - 8
    while len(rows):
        names[rows] = mixed_in(names[rows], at, left)
        on = left > 8
        rows, at, left = rows[on], at[on] + 8, left[on] - 8
    return names


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A name for the two in this order."""
    return mixed(mixed(a + np.uint64(GOLDEN)) * np.uint64(3) + b)


def names_of(words: list[bytes]) -> np.ndarray:
    return word_names(pa.array(words, pa.binary()))


END_NAME = names_of([END])[0]


def uniform(keys: np.ndarray, seed: int) -> np.ndarray:
    """A number between 0 and 1 for each key."""
    salt = np.uint64((seed + 1) * GOLDEN % (1 << 64))
    return ((mixed(mixed(keys ^ salt) + salt) >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)


def heads(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins, as a mask."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def runs(new: np.ndarray) -> np.ndarray:
    return np.diff(np.append(np.flatnonzero(new), len(new)))


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers in as few bytes as the largest needs; a first byte says how many."""
    most = int(numbers.max()) if len(numbers) else 0
    size = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4 if most < 1 << 32 else 8
    return bytes([size]) + numbers.astype(f"<u{size}").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def near(x: np.ndarray) -> np.ndarray:
    """The first 16 bits by which words are sorted: whatever is sorted goes by them, so that places in one order are nearly in order in another."""
    return mixed(x) & np.uint64(0xFFFF)


def five(x: np.ndarray) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def from_five(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return out.view("<u8").reshape(-1)


def member(x: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(x), bool)
    return ordered[np.minimum(np.searchsorted(ordered, x), len(ordered) - 1)] == x


@dataclass
class Tokens:
    """The tokens of some documents: names, the word before, 40 bits of the one before that, and each one's document by number."""

    names: np.ndarray
    before: np.ndarray
    farther: np.ndarray
    owner: np.ndarray
    ids: pa.Array
    held_out: np.ndarray


def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[Tokens]:
    """From batches of (doc_id, held_out, text)."""
    alone("tokens", dict)
    for batch in batches:
        for some in slices(batch, 2, BLOCK_BYTES):
            words, lengths = ascii_words(pc.ascii_lower(some.column(2)))
            ends = np.cumsum(lengths + 1)  # an end after each text
            names = np.full(ends[-1], END_NAME)
            inside = np.ones(len(names), bool)
            inside[ends - 1] = False
            names[inside] = word_names(words)
            before = np.concatenate(([END_NAME], names[:-1]))
            farther = np.concatenate(([END_NAME], before[:-1]))
            farther[ends - lengths - 1] = END_NAME
            yield Tokens(names, before, farther >> np.uint64(24), np.repeat(np.arange(len(lengths)), lengths + 1), some.column(0), some.column(1).to_numpy(zero_copy_only=False))


def batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def table_of(rows: list[tuple], schema: str) -> pa.Table:
    return pa.Table.from_batches([batch_of(rows, schema)])


@dataclass(frozen=True)
class Dealt:
    """How tokens are dealt: a label for each bucket, and the words whose restaurants are spread, in order."""

    labels: np.ndarray
    spread: np.ndarray

    def place(self, before: np.ndarray, names: np.ndarray) -> np.ndarray:
        """The bucket of a word after another."""
        by = np.where(member(before, self.spread), joined(before, names), mixed(before))
        return ((by >> np.uint64(20)) % np.uint64(len(self.labels))).astype(np.int64)

    def reducer(self, keys: np.ndarray) -> np.ndarray:
        return ((mixed(keys) >> np.uint64(20)) % np.uint64(len(self.labels))).astype(np.int64)


def frequent(rows: DataFrame, share: float) -> np.ndarray:
    """Words that are about that share of the tokens or more, by one document in LOOKED_AT. It settles where tokens go, not what comes out.

    A word with that share has it in one task at least, so tasks send what has half of it there; 2 / share words of a task at most.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in tokens(batches):
            words, n = np.unique(t.names, return_counts=True)
            often = n >= share / 2 * len(t.names)
            yield batch_of([(int(w), int(k), 0) for w, k in zip(words[often].view(np.int64), n[often], strict=True)] + [(0, 0, len(t.names))], "word long, n long, total long")

    looked = rows.where(F.pmod(F.xxhash64("doc_id", F.lit("look")), F.lit(LOOKED_AT)) == 0)
    counts = looked.mapInArrow(count, "word long, n long, total long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    total = sum(r["total"] for r in counts)
    return np.sort(np.asarray([r["word"] for r in counts if r["n"] and r["n"] >= share * total], np.int64).view(np.uint64))


SENT = "bucket int, block long, before binary, before_runs binary, names binary, name_runs binary, farther binary, token_runs binary, owners binary, head binary"


def send(batches: Iterator[pa.RecordBatch], dealt: Dealt, wave: int, waves: int) -> Iterator[pa.RecordBatch]:
    """All tokens of a wave's buckets, by bucket: distinct words before, what follows each, the distinct words farther back of each of those, and the documents of each.

    An owner's low bit says whether it is held out; what add_up needs of a block's documents goes with the block's first row in the first wave that has one.
    """
    part = TaskContext.get().partitionId()
    for k, t in enumerate(tokens(batches)):
        place = dealt.place(t.before, t.names)
        mine = np.flatnonzero(place * waves // len(dealt.labels) == wave)
        carries = len(mine) and wave == int((place * waves // len(dealt.labels)).min())
        place, before, names, farther, owner = place[mine], t.before[mine], t.names[mine], t.farther[mine], t.owner[mine]
        # equal entries come together
        key = place.astype(np.uint64) << np.uint64(48)
        for shift, x in ((32, before), (16, names), (0, farther)):
            key |= near(x) << np.uint64(shift)
        order = np.argsort(key, kind="stable")
        place, before, names, farther, owner = place[order], before[order], names[order], farther[order], owner[order]
        first = heads(place)
        new_before = first | heads(before)
        new_name = new_before | heads(names)
        new_entry = new_name | heads(farther)
        owners = (owner << 1 | t.held_out[owner]).astype("<u2")
        edges = np.append(np.flatnonzero(first), len(place))
        rows = []
        for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            b, n, e = new_before[i:j], new_name[i:j], new_entry[i:j]
            head = None
            if not i and carries:
                head = pickle.dumps((t.ids.fill_null(0).to_numpy(), t.ids.is_null().to_numpy(zero_copy_only=False), np.bincount(t.owner, minlength=len(t.ids)), t.held_out), 5)
            rows.append((int(dealt.labels[place[i]]), part << 32 | k, before[i:j][b].tobytes(), packed(runs(b[n])), names[i:j][n].tobytes(), packed(runs(n[e])), five(farther[i:j][e]), packed(runs(e)), owners[i:j].tobytes(), head))
        if rows:
            yield batch_of(rows, SENT)


COUNTS = "n long, one1 long, two1 long, one2 long, two2 long"
MODEL = "bucket int, piece int, model binary, tokens binary, " + COUNTS
#: What only scoring needs of a bucket: it is kept apart, so that rounds don't read it.
OF_TOKENS = ("entries", "runs", "owners", "blocks", "sizes", "heads")


def merge(table: pa.Table, dealt: Dealt) -> pa.Table:
    """A bucket's restaurants and, apart, its tokens in rows of PIECE bytes; the first one has the counts."""
    parts: list[list[np.ndarray]] = [[], [], [], [], []]
    for b, br, n, nr, x, er, o in zip(*(table[c].to_pylist() for c in ("before", "before_runs", "names", "name_runs", "farther", "token_runs", "owners")), strict=True):
        name_runs = unpacked(nr)
        parts[0].append(np.repeat(np.repeat(np.frombuffer(b, "<u8"), unpacked(br)), name_runs))
        parts[1].append(np.repeat(np.frombuffer(n, "<u8"), name_runs))
        parts[2].append(from_five(x))
        parts[3].append(unpacked(er))
        parts[4].append(np.frombuffer(o, "<u2"))
    sizes = [len(x) for x in parts[4]]
    before, names, farther, n, owners = map(np.concatenate, parts)
    del parts
    pair = near(before) << np.uint64(48) | near(names) << np.uint64(32) | joined(before, names) >> np.uint64(32)
    order = np.lexsort((near(farther) << np.uint64(40) | farther, pair))
    pair, farther = pair[order], farther[order]
    new_pair = heads(pair)
    new = new_pair | heads(farther)
    triple = np.empty(len(order), np.int32)
    triple[order] = np.cumsum(new) - 1
    token = np.repeat(triple, n)
    m = {"entries": closer(triple), "runs": packed(n), "owners": owners, "blocks": table["block"].to_pylist(), "sizes": sizes, "heads": table["head"].to_pylist()}
    counts = np.bincount(token[(owners & 1) == 0], minlength=int(new.sum()))
    of_pair = (np.cumsum(new_pair) - 1)[new]
    first = order[new_pair]
    m["words"], pair_word = np.unique(names[first], return_inverse=True)
    _, contexts, pair_context = np.unique(near(before[first]) << np.uint64(48) | before[first] >> np.uint64(16), return_index=True, return_inverse=True)
    contexts = before[first][contexts]
    context = contexts[pair_context][of_pair]
    doubles, triple_double = np.unique(near(context) << np.uint64(48) | joined(context, farther[new]) >> np.uint64(16), return_inverse=True)
    m["counts"], m["pair"], m["double"] = packed(counts), packed(np.diff(of_pair, prepend=0)), closer(triple_double)
    m["pair_word"], m["pair_context"] = pair_word.astype(np.int32), closer(pair_context)
    # what is shared with other buckets: contexts that are spread, and the pairs of words that end in one
    shared = member(contexts, dealt.spread)
    m["n_contexts"], m["n_doubles"] = len(contexts), len(doubles)
    m["shared_contexts"] = np.flatnonzero(shared)
    m["shared_doubles"] = np.unique(triple_double[shared[pair_context][of_pair]])
    m["shared_keys"] = np.concatenate((joined(contexts[m["shared_contexts"]], np.uint64(1)), joined(doubles[m["shared_doubles"]], np.uint64(2))))
    total = np.bincount(of_pair, counts, len(pair_word)).astype(np.int64)
    m["again"], m["pair_again"] = np.flatnonzero(counts > 1), np.flatnonzero(total > 1)
    m["keys"], m["pair_keys"] = joined(pair[new], farther[new])[m["again"]], pair[new_pair][m["pair_again"]]
    customers = np.bincount(of_pair, np.minimum(counts, 1), len(pair_word))
    found = (int(counts.sum()), int((customers == 1).sum()), int((customers == 2).sum()), int((counts == 1).sum()), int((counts == 2).sum()))
    own = {k: m.pop(k) for k in OF_TOKENS}
    data, more = dense(m), dense(own)
    bucket = table["bucket"][0].as_py()
    return table_of([(bucket, k, data[at : at + PIECE] or None, more[at : at + PIECE] or None, *(found if not k else (0,) * 5)) for k, at in enumerate(range(0, max(len(data), len(more)), PIECE))], MODEL)


def dense(values: dict) -> bytes:
    """Pickled and compressed here: whatever carries it copies fewer bytes, again and again."""
    data = pickle.dumps(values, 5)
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def opened(pieces: list[tuple[int, bytes | None]]) -> dict:
    data = b"".join(x for _, x in sorted(pieces, key=lambda p: p[0]) if x is not None)
    return pickle.loads(pa.decompress(memoryview(data)[8:], int.from_bytes(data[:8], "little"), "zstd"))


def closer(places: np.ndarray) -> np.ndarray:
    """Steps between places that are nearly in order: small numbers, that files compress."""
    return np.diff(places, prepend=0).astype(np.int32)


def loaded(rows: pa.Table, with_tokens: bool = False) -> dict:
    """A bucket's restaurants from its rows, with their places summed up again."""
    places = rows["piece"].to_pylist()
    m = opened(list(zip(places, rows["model"].to_pylist(), strict=True)))
    if with_tokens:
        m |= opened(list(zip(places, rows["tokens"].to_pylist(), strict=True)))
    for k in ("double", "pair_context"):
        m[k] = np.cumsum(m[k], dtype=np.int32)
    m["counts"] = unpacked(m["counts"])
    m["pair"] = np.cumsum(unpacked(m["pair"]), dtype=np.int32)
    if with_tokens:
        m["token"] = np.repeat(np.cumsum(m["entries"], dtype=np.int32), unpacked(m["runs"]))
    return m


@dataclass(frozen=True)
class Totals:
    """What all buckets know of a round: the shared restaurant's customers and tables, and of the corpus its tokens, its vocabulary and the discounts."""

    customers: int = 0
    tables: int = 0
    n: int = 0
    vocabulary: int = 0
    discounts: tuple[float, float, float] = (0.5, 0.5, 0.5)


class Seats:
    """A bucket's restaurants after a round, with the totals they share with other buckets."""

    def __init__(self, m: dict, totals: Totals, state: bytes | None, shared: list[tuple[int, bytes]], dealt: Dealt) -> None:
        self.m, self.totals = m, totals
        self.tables = np.minimum(m["counts"], 1)
        n_pairs = len(m["pair_word"])
        self.pair_tables = np.zeros(n_pairs, np.int64)
        if state is not None:
            again, pair_again = pickle.loads(state)
            self.tables[m["again"]] = again
        self.customers = np.bincount(m["pair"], self.tables, n_pairs).astype(np.int64)
        self.pair_tables = np.minimum(self.customers, 1)
        if state is not None:
            self.pair_tables[m["pair_again"]] = pair_again
        self.in_double = np.bincount(m["double"], m["counts"], m["n_doubles"]).astype(np.int64)
        self.double_tables = np.bincount(m["double"], self.tables, m["n_doubles"]).astype(np.int64)
        self.in_context = np.bincount(m["pair_context"], self.customers, m["n_contexts"]).astype(np.int64)
        self.context_tables = np.bincount(m["pair_context"], self.pair_tables, m["n_contexts"]).astype(np.int64)
        self.word_customers = np.bincount(m["pair_word"], self.pair_tables, len(m["words"])).astype(np.int64)
        self.word_tables = np.zeros(len(m["words"]), np.int64)
        self.word_counts = np.bincount(m["pair_word"][m["pair"]], m["counts"], len(m["words"])).astype(np.int64)
        if not shared:
            return
        at, at_shared = self.slices(dealt)
        label = {int(x): k for k, x in enumerate(dealt.labels)}
        n_contexts = len(m["shared_contexts"])
        a, b = np.zeros(len(m["shared_keys"]), np.int64), np.zeros(len(m["shared_keys"]), np.int64)
        for reducer, payload in shared:
            k = label[reducer]
            own, tables, counts, x, y = map(unpacked, pickle.loads(payload))
            words, keys = at[k], at_shared[k]
            self.word_customers[words], self.word_tables[words], self.word_counts[words], a[keys], b[keys] = own, tables, counts, x, y
        self.in_context[m["shared_contexts"]], self.context_tables[m["shared_contexts"]] = a[:n_contexts], b[:n_contexts]
        self.in_double[m["shared_doubles"]], self.double_tables[m["shared_doubles"]] = a[n_contexts:], b[n_contexts:]

    def slices(self, dealt: Dealt) -> tuple[dict[int, np.ndarray], dict[int, np.ndarray]]:
        """The words, and the shared keys, that each reducer adds up."""
        if "slices" in self.m:
            return self.m["slices"]
        out = []
        for keys in (self.m["words"], self.m["shared_keys"]):
            place = dealt.reducer(keys).astype(np.min_scalar_type(len(dealt.labels)))  # of 16 bits or fewer they are sorted by counting
            order = np.argsort(place, kind="stable")
            edges = np.searchsorted(place[order], np.arange(len(dealt.labels) + 1))
            out.append({k: order[edges[k] : edges[k + 1]] for k in range(len(dealt.labels))})
        self.m["slices"] = out[0], out[1]
        return self.m["slices"]

    def messages(self, bucket: int, dealt: Dealt) -> list[tuple]:
        """Rows for the reducers: keys and this bucket's part of their sums."""
        m = self.m
        a = np.concatenate((self.in_context[m["shared_contexts"]], self.in_double[m["shared_doubles"]]))
        b = np.concatenate((self.context_tables[m["shared_contexts"]], self.double_tables[m["shared_doubles"]]))
        words, shared = self.slices(dealt)
        out = []
        for k in range(len(dealt.labels)):
            w, s = words[k], shared[k]
            if len(w) or len(s):
                parts = (m["words"][w].tobytes(), packed(self.word_customers[w]), packed(self.word_counts[w]), packed(self.word_tables[w]), m["shared_keys"][s].tobytes(), packed(a[s]), packed(b[s]))
                out.append((1, bucket, int(dealt.labels[k]), pickle.dumps(parts, 5)))
        return out

    def root(self) -> np.ndarray:
        """The chance of each word in the shared restaurant."""
        t, d, s = self.totals, self.totals.discounts[0], STRENGTHS[0]
        return (self.word_customers - d * self.word_tables + (s + d * t.tables) / (t.vocabulary + 1)) / (s + t.customers)

    def middle(self, root: np.ndarray) -> np.ndarray:
        """The chance of each pair's word after its context of one word."""
        m, d, s = self.m, self.totals.discounts[1], STRENGTHS[1]
        c = m["pair_context"]
        return (self.customers - d * self.pair_tables + (s + d * self.context_tables[c]) * root[m["pair_word"]]) / (s + self.in_context[c])

    def chances(self) -> np.ndarray:
        """The chance of each triple's word after its context of two words."""
        m, d, s = self.m, self.totals.discounts[2], STRENGTHS[2]
        up = self.middle(self.root())[m["pair"]]
        return (m["counts"] - d * self.tables + (s + d * self.double_tables[m["double"]]) * up) / (s + self.in_double[m["double"]])

    def reseated(self, k: int) -> bytes:
        """Draw all tables anew, for round k; returns the state."""
        m = self.m
        root = self.root()
        d0, d1, d2 = self.totals.discounts
        rows, pairs = m["again"], m["pair_again"]
        # a dish with its tables out: the parent's customers, tables and totals without them
        own, p = self.tables[rows], m["pair"][rows]
        rest = self.customers[p] - own
        rest_tables = np.where(rest > 0, np.minimum(self.pair_tables[p], rest), 0)
        c = m["pair_context"][p]
        tables = self.context_tables[c] - (self.pair_tables[p] - rest_tables)
        chance = (rest - d1 * rest_tables + (STRENGTHS[1] + d1 * tables) * root[m["pair_word"][p]]) / (STRENGTHS[1] + self.in_context[c] - own)
        room = STRENGTHS[2] + d2 * np.maximum(self.double_tables[m["double"][rows]] - own, 0)
        again = drawn(stirling(d2), m["counts"][rows], room, chance, uniform(m["keys"], 2 * k))
        self.tables[rows] = again
        customers = np.bincount(m["pair"], self.tables, len(m["pair_word"])).astype(np.int64)[pairs]
        t, w = self.totals, m["pair_word"][pairs]
        own = self.pair_tables[pairs]
        rest = np.maximum(self.word_customers[w] - own, 0)
        rest_tables = np.where(rest > 0, np.minimum(self.word_tables[w], rest), 0)
        chance = (rest - d0 * rest_tables + (STRENGTHS[0] + d0 * (t.tables - self.word_tables[w] + rest_tables)) / (t.vocabulary + 1)) / (STRENGTHS[0] + t.customers - own)
        room = STRENGTHS[1] + d1 * np.maximum(self.context_tables[m["pair_context"][pairs]] - own, 0)
        pair_again = drawn(stirling(d1), customers, room, chance, uniform(m["pair_keys"], 2 * k + 1))
        return pickle.dumps((again, pair_again), 5)


def stirling(d: float) -> Stirling:
    kept = alone("stirling", dict)
    if d not in kept:
        kept[d] = Stirling(d)
    return kept[d]


RESPONSE = "bucket int, reducer int, payload binary, customers long, tables long, n long, vocabulary long, one0 long, two0 long"


def add(table: pa.Table, totals: Totals, k: int) -> pa.Table:
    """A reducer's answer to each bucket, in the order that the bucket sent its keys, and a row of totals. From round 1 on words are reseated in the shared restaurant."""
    rows = [pickle.loads(x) for x in table["payload"].to_pylist()]
    sizes = [len(r[0]) // 8 for r in rows]
    words, place = np.unique(np.frombuffer(b"".join(r[0] for r in rows), "<u8"), return_inverse=True)
    summed = lambda j: np.bincount(place, np.concatenate([unpacked(r[j]) for r in rows]), len(words)).astype(np.int64)
    customers = summed(1)
    counts = summed(2) if k == 0 else np.zeros(len(words), np.int64)
    own = np.zeros(len(words), np.int64)
    np.maximum.at(own, place, np.concatenate([unpacked(r[3]) for r in rows]))
    if k == 0:
        tables = np.minimum(customers, 1)
    else:
        np.maximum.at(counts, place, np.concatenate([unpacked(r[2]) for r in rows]))
        d = totals.discounts[0]
        tables = drawn(stirling(d), customers, STRENGTHS[0] + d * np.maximum(totals.tables - own, 0), np.full(len(words), 1 / (totals.vocabulary + 1)), uniform(words, 1_000_000 + k))
    keys, at = np.unique(np.frombuffer(b"".join(r[4] for r in rows), "<u8"), return_inverse=True)
    a, b = (np.bincount(at, np.concatenate([unpacked(r[j]) for r in rows]), len(keys)).astype(np.int64) for j in (5, 6))
    out = []
    edges, shared = np.cumsum([0, *sizes]), np.cumsum([0, *[len(r[4]) // 8 for r in rows]])
    reducer = table["reducer"][0].as_py()
    for i, bucket in enumerate(table["bucket"].to_pylist()):
        w, s = place[edges[i] : edges[i + 1]], at[shared[i] : shared[i + 1]]
        out.append((bucket, reducer, pickle.dumps(tuple(map(packed, (customers[w], tables[w], counts[w], a[s], b[s]))), 5), 0, 0, 0, 0, 0, 0))
    seen = counts > 0
    out.append((None, reducer, None, int(customers.sum()), int(tables.sum()), int(counts.sum()), int(seen.sum()), int((customers == 1).sum()), int((customers == 2).sum())))
    return table_of(out, RESPONSE)


def discount(one: int, two: int) -> float:
    return float(np.clip(one / (one + 2 * two) if one + two else 0.5, 0.1, 0.95))


def sums(frame: DataFrame, columns: str) -> dict[str, int]:
    return frame.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns.replace(" long", "").split(", ")]).first().asDict()


STEP = "kind int, bucket int, reducer int, payload binary"
PARTS = "block long, owners binary, scores binary, bases binary, known binary, head binary"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def arrived(right: pa.Table, k: int) -> tuple[bytes | None, list[tuple[int, bytes]]]:
    """The state after round k, and the reducers' answers."""
    state, shared = None, []
    for kind, r, reducer, payload in zip(*(right[c].to_pylist() for c in ("kind", "round", "reducer", "payload")), strict=True):
        if r == k and kind == 0:
            state = payload
        elif r == k:
            shared.append((reducer, payload))
    return state, shared


def score_bucket(left: pa.Table, right: pa.Table, totals: dict[int, Totals], dealt: Dealt) -> pa.Table:
    """A row for each block: sums over its documents' tokens in this bucket."""
    if not left.num_rows:
        return table_of([], PARTS)
    m = loaded(left, with_tokens=True)
    p = np.zeros(len(m["counts"]))
    for k, t in totals.items():
        seats = Seats(m, t, *arrived(right, k), dealt)
        p += seats.chances()
    score = np.log10(p / len(totals))
    counts = seats.word_counts[m["pair_word"][m["pair"]]]
    base, known = np.log10((counts + 1) / (t.n + 1 * (t.vocabulary + 1))), counts > 0
    rows, at = [], 0
    for block, size, head in zip(m["blocks"], m["sizes"], m["heads"], strict=True):
        owner, own = m["owners"][at : at + size] >> 1, m["token"][at : at + size]
        docs, place = np.unique(owner, return_inverse=True)
        a, b, c = (np.bincount(place, x[own], len(docs)) for x in (score, base, known))
        rows.append((block, docs.astype("<u2").tobytes(), a.tobytes(), b.tobytes(), packed(c), head))
        at += size
    return table_of(rows, PARTS)


def add_up(table: pa.Table, n: int) -> pa.Table:
    ids, null, lengths, held = pickle.loads(next(x for x in table["head"].to_pylist() if x is not None))
    score, base, known = (np.zeros(len(ids)) for _ in range(3))
    for o, a, b, c in zip(*(table[x].to_pylist() for x in ("owners", "scores", "bases", "known")), strict=True):
        owners = np.frombuffer(o, "<u2")
        score[owners] += np.frombuffer(a, "<f8")
        base[owners] += np.frombuffer(b, "<f8")
        known[owners] += unpacked(c)
    return pa.table([pa.array(ids, mask=null), pa.array(held), pa.array(lengths), pa.array(known.astype(np.int64)), pa.array(np.full(len(ids), n, np.int64)), pa.array(base), pa.array(score)], names=[x.split()[0] for x in SCORES.split(", ")])


def buckets(spark: SparkSession, size: int) -> int:
    """As many as keep the average at BUCKET_CHARS, but at least one for each of a shuffle's parts: with fewer, Spark would move the table in buckets again.

    What buckets send of their words grows with their number, so there are no more of them than that. 100,000 is the most that Spark's tables take.
    """
    return min(max(width(spark), -(-size // BUCKET_CHARS)), 100_000)


def score_documents(docs: DataFrame, n_rounds: int = ROUNDS, burn_in: int = BURN_IN) -> DataFrame:
    """Learn from the documents of the training fold, score every row of docs.

    A null text counts as empty: its only token is the end. A null id is in the training fold. Repeated rows
    each count, and get equal scores. Without training documents every token is unknown. An empty table gives
    an empty one.
    """
    spark = docs.sparkSession
    rows = texts_of(docs).select("doc_id", F.coalesce(remainder(F.col("doc_id"), 7) == 2, F.lit(False)).alias("held_out"), "text")
    n_buckets = buckets(spark, characters(docs))
    dealt = Dealt(np.asarray(labels(spark, n_buckets)), frequent(rows, SPREAD / n_buckets))
    shared = spark.sparkContext.broadcast(dealt)
    # a table in buckets: its rows meet those of a round without being moved again. Waves keep what is on its way small
    name_, place, work = f"knotwork_{uuid.uuid4().hex}", new_path(spark, "model"), []
    for wave in range(WAVES):
        sent = rows.mapInArrow(lambda batches: send(batches, shared.value, wave, WAVES), SENT)  # noqa: B023  run at once
        with shuffles_freed(spark):
            sent.repartition(n_buckets, "bucket").groupBy("bucket").applyInArrow(lambda table: merge(table, shared.value), MODEL).write.bucketBy(n_buckets, "bucket").option("path", place).option("compression", "zstd").saveAsTable(name_, mode="append")
    model = spark.table(name_)
    counted, whole = sums(model, COUNTS), model.select("bucket", "piece", "model")
    with_tokens = model.select("bucket", "piece", "model", "tokens")

    def keep(frame: DataFrame, what: str, *parts: str) -> DataFrame:
        work.append(new_path(spark, what))
        return staged(frame, what, work[-1], "zstd", *parts)

    def step(k: int, totals: Totals, right: DataFrame | None) -> DataFrame:
        if right is None:

            def first(table: pa.Table) -> pa.Table:
                return table_of(Seats(loaded(table), totals, None, [], shared.value).messages(table["bucket"][0].as_py(), shared.value), STEP)

            return keep(whole.groupBy("bucket").applyInArrow(first, STEP), "step", "kind")

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows:
                return table_of([], STEP)
            bucket, m = left["bucket"][0].as_py(), loaded(left)
            before = Seats(m, totals, *arrived(right, k - 1), shared.value)
            state = before.reseated(k)
            after = Seats(m, totals, state, [], shared.value)
            after.word_counts, after.word_tables = before.word_counts, before.word_tables
            return table_of([(0, bucket, -1, state), *after.messages(bucket, shared.value)], STEP)

        return keep(whole.groupBy("bucket").cogroup(right.groupBy("bucket")).applyInArrow(run, STEP), "step", "kind")

    totals, averaged, right, before = Totals(), {}, None, {}
    for k in range(n_rounds + 1):
        now = step(k, totals, right)
        answers = keep(now.where("kind = 1").drop("kind").groupBy("reducer").applyInArrow(lambda table: add(table, totals, k), RESPONSE), "answers")  # noqa: B023  run at once
        discard(spark, f"{work[-2]}/kind=1")
        found = sums(answers, "customers, tables, n, vocabulary, one0, two0")
        discounts = totals.discounts if k else (discount(found["one0"], found["two0"]), discount(counted["one1"], counted["two1"]), discount(counted["one2"], counted["two2"]))
        totals = Totals(found["customers"], found["tables"], found["n"], found["vocabulary"], discounts)
        right = now.where("kind = 0").select("kind", "bucket", "reducer", "payload").unionByName(answers.where("bucket IS NOT NULL").select(F.lit(1).alias("kind"), "bucket", "reducer", "payload")).withColumn("round", F.lit(k))
        if k > burn_in or k == n_rounds:
            averaged[k], before[k] = totals, right
        elif k > 0:  # nothing reads the round before this one any more
            discard(spark, *work[:-2])
            del work[:-2]
    kept = next(iter(before.values()))
    for k in list(before)[1:]:
        kept = kept.unionByName(before[k])
    parts = with_tokens.groupBy("bucket").cogroup(kept.groupBy("bucket")).applyInArrow(lambda left, right: score_bucket(left, right, averaged, shared.value), PARTS)
    scores = staged(parts.groupBy("block").applyInArrow(lambda table: add_up(table, totals.n), SCORES), "scores")
    spark.sql(f"DROP TABLE IF EXISTS {name_}")
    discard(spark, place, *work)
    return scores


def op3_lm_scoring(spark, sf_dir: str) -> DataFrame:
    """Every row of documents with its scores; see `score_documents`."""
    return score_documents(documents(spark, sf_dir))
