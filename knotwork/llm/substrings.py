"""Removal of repeated passages, found by recompression.

A round of recompression first names runs of equal symbols, then splits the alphabet in two by a hash
and names each pair of a left symbol before a right one. A name is a keyed hash of what it stands for:
so all tasks of all Spark rounds give equal strings equal names, and no dictionary has to travel. Four
rounds shorten a text to about a third.

Within a window the names of a round don't depend on what is around it but near its edges, and the
symbols there tell how near (`shrink`): the outer runs, and the symbol beside them where it may be joined
to them, are set aside as they are; what is left between are whole symbols of the next round. What four
rounds set aside, and the few symbols left of the last, is the window's own sequence: equal windows
have equal sequences wherever they stand, and a sequence spells its window.

1. Chains of three consecutive second-round symbols are counted. A window whose interior holds a
   chain that occurs once isn't repeated; what is left are proposals, none of them missed.
2. Each proposed window is named by its sequence (64 bits) and checked by its words' own names
   (15 bits more). Each name's first occurrence is found.
3. Words that repeated windows cover go, but for the windows' first occurrences.

Documents are dealt to groups by a hash, so many that a group has a bounded share of the text. Between
the rounds go names and places in packed arrays, and texts in compressed batches. A task sends each
chain and each group each window once, however often it has it, so a passage that a third of all
documents share meets as one entry a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import alone, characters, documents, numbered, staged, width

WINDOW = 20
CHAIN, ROUNDS = 3, 4
#: Characters that a group of documents has on average at most.
GROUP_CHARS = 16_000_000
#: Words that are handled at once, and chains that a task gathers before it sends them.
BLOCK_WORDS, HELD = 100_000, 1_000_000
#: One chain in so many, by its name, is sent and tested.
TESTED = 2
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def salted(salt: int) -> np.uint64:
    return np.uint64(salt * int(GOLDEN) % (1 << 64))


def joined(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    return mixed(mixed(a + salted(salt)) * np.uint64(3) + b)


def word_names(words: list[bytes]) -> np.ndarray:
    """128-bit names of words, as two 64-bit numbers."""
    import xxhash

    alone("words", dict)
    return numbered(words, xxhash.xxh128_digest, 2)


@dataclass
class Round:
    """A round's input, its runs and the symbols it makes of them."""

    below: np.ndarray
    #: The run that each place of the input is in, where runs start (one more for the end), their names, and which are left symbols.
    run_of: np.ndarray
    edges: np.ndarray
    runs: np.ndarray
    left: np.ndarray
    #: The symbol that each run is in, and the symbols' names.
    symbol_of: np.ndarray
    names: np.ndarray


def recompress(below: np.ndarray, salt: int) -> Round:
    """Name runs, then pairs. below: at least one symbol."""
    n = len(below)
    new = np.flatnonzero(np.concatenate(([True], below[1:] != below[:-1])))
    edges = np.append(new, n)
    length = np.diff(edges)
    runs = below[new]
    long = np.flatnonzero(length > 1)
    runs[long] = joined(runs[long], length[long].astype(np.uint64), salt)
    left = (mixed(runs + salted(salt * 7 + 1)) & np.uint64(1)).astype(bool)
    second = np.zeros(len(runs), bool)
    second[1:] = left[:-1] & ~left[1:]
    heads = np.flatnonzero(~second)
    names = runs[heads]
    paired = np.flatnonzero(second[np.minimum(heads + 1, len(runs) - 1)] & (heads + 1 < len(runs)))
    names[paired] = joined(names[paired], runs[heads[paired] + 1], salt + 50)
    return Round(below, np.repeat(np.arange(len(runs)), length), edges, runs, left, np.cumsum(~second) - 1, names)


def shrink(r: Round, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
    """The part of each stretch [a, b) of r's input that is whole symbols wherever the stretch stands: (first run, last run, low, high, from, to).

    The outer runs may go on outside, so they are set aside. The next run from the left may be joined
    to the outer one if it is a right symbol, and is set aside then; a left one never joins what is
    before it. Mirrored at the other end. low and high tell whether such a run was set aside; it is the one
    beside the outer run. Nothing is left where to <= from.
    """
    first, last = r.run_of[a], r.run_of[b - 1]
    some = last - first >= 2
    low = some & ~r.left[np.minimum(first + 1, len(r.left) - 1)]
    high = some & r.left[np.maximum(last - 1, 0)]
    lead, tail = first + 1 + low, last - 1 - high
    some &= lead <= tail
    start = np.where(some, r.symbol_of[np.minimum(lead, len(r.left) - 1)], 0)
    return first, last, low, high, start, np.where(some, r.symbol_of[np.maximum(tail, 0)] + 1, 0)


def levels(names: np.ndarray, n: int) -> list[Round]:
    """n rounds over the words' names."""
    below, out = names[:, 0] ^ mixed(names[:, 1]), []
    for k in range(n):
        out.append(recompress(below, k + 1))
        below = out[-1].names
    return out


#: Odd numbers that keep the parts of a sequence apart.
APART = np.asarray([(0x9E3779B97F4A7C15 * k | 1) % (1 << 64) for k in range(3, 13, 2)], np.uint64)


def sequences(rounds: list[Round], at: np.ndarray) -> np.ndarray:
    """The name of the window at each place: a hash of all that the rounds set aside, then of the symbols left."""
    h = np.zeros(len(at), np.uint64)
    live, a, b = np.arange(len(at)), at, at + WINDOW
    for k, r in enumerate(rounds):
        first, last, low, high, start, end = shrink(r, a, b)
        # lengths of the outer runs, as far as they are inside; one run alone is both
        sizes = (np.minimum(r.edges[first + 1], b) - a) << 8 | (b - np.maximum(r.edges[last], a))
        own = r.below[a] * APART[0] + r.below[b - 1] * APART[1] + sizes.astype(np.uint64) * APART[2]
        own += np.where(low, r.runs[np.minimum(first + 1, len(r.runs) - 1)], np.uint64(0)) * APART[3]
        own += np.where(high, r.runs[np.maximum(last - 1, 0)], np.uint64(0)) * APART[4]
        h[live] = joined(h[live], own, 200 + k)
        left = np.flatnonzero(end > start)
        live, a, b = live[left], start[left], end[left]
    top = rounds[-1].names
    while len(live):
        h[live] = joined(h[live], top[a], 230)
        left = np.flatnonzero(b - a > 1)
        live, a, b = live[left], a[left] + 1, b[left]
    return h


@dataclass
class Parsed:
    """A document's chains: names, and for each window start the range of chains within its interior."""

    chains: np.ndarray
    first: np.ndarray
    last: np.ndarray
    #: Where each chain starts, in words.
    at: np.ndarray
    rounds: list[Round]


def parse(names: np.ndarray, windows: bool = True, rounds: int = 2) -> Parsed:
    """Chains of the second round. Without `windows`, no ranges of chains."""
    own = levels(names, rounds)
    one, two = own[:2]
    # where symbols start, in words: a symbol's first run, and that run's first word
    heads = lambda r: r.edges[np.flatnonzero(np.concatenate(([True], np.diff(r.symbol_of) > 0)))]
    at = heads(one)[heads(two)]
    s = two.names
    k = max(0, len(s) - CHAIN + 1)
    chains = s[:k]
    for i in range(1, CHAIN):
        chains = joined(chains, s[i : i + k], 90 + i)
    n = max(0, len(names) - WINDOW + 1) if windows else 0
    a, b = np.arange(n), np.arange(n) + WINDOW
    for r in (one, two):
        live = np.flatnonzero(b > a)
        *_, start, end = shrink(r, a[live], b[live])
        a, b = np.zeros(n, np.int64), np.zeros(n, np.int64)
        a[live], b[live] = start, end
    return Parsed(chains, a, b - CHAIN, at[:k], own)


def window_checks(names: np.ndarray, at: np.ndarray) -> np.ndarray:
    """15 bits of every window at the given places: a polynomial of its words' second names, rolled by prefix sums.

    sums[i] = sum of name[j] * r^j for j < i, modulo 2^64; a window's difference times r^(-start) is
    the same wherever it is.
    """
    r = 0xA0761D6478BD642F
    power, back = np.full(len(names), r, np.uint64), np.full(len(names), pow(r, -1, 1 << 64), np.uint64)
    power[0] = back[0] = 1
    power, back = np.cumprod(power, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(names[:, 1]) * power, dtype=np.uint64)))
    return mixed((sums[at + WINDOW] - sums[at]) * back[at]) & np.uint64(0x7FFF)


def tested(chains: np.ndarray) -> np.ndarray:
    return chains[chains % np.uint64(TESTED) == 0]


def member(x: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(x), bool)
    return ordered[np.minimum(np.searchsorted(ordered, x), len(ordered) - 1)] == x


@dataclass
class Block:
    """Some whole documents, one after the other. Names don't stop at their ends: what is around a window never matters."""

    words: list[bytes]
    #: The first document's number, and where each document starts among the words (one more for the end).
    number: int
    edges: np.ndarray

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.edges) - 1), np.diff(self.edges))

    def inside(self, n: int) -> np.ndarray:
        """Whether the window at each of the first n places stays in its document."""
        ends = np.repeat(self.edges[1:], np.diff(self.edges))[:n]
        return np.arange(n) + WINDOW <= ends


def blocks(texts: list[str], first: int = 0) -> Iterator[Block]:
    words: list[bytes] = []
    edges, number = [0], first
    for i, text in enumerate(texts):
        words += text.encode().split()  # bytes split at ASCII white space only
        edges.append(len(words))
        if len(words) >= BLOCK_WORDS or i + 1 == len(texts):
            yield Block(words, number, np.asarray(edges))
            words, edges, number = [], [0], first + i + 1


def six(x: np.ndarray) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def from_six(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").reshape(-1)


LOW = np.uint64((1 << 47) - 1)


def bucket(x: np.ndarray, n: int) -> np.ndarray:
    return ((x >> np.uint64(47)) % np.uint64(n)).astype(np.int64)


def chain_blocks(batches: Iterator[pa.RecordBatch], n_buckets: int) -> Iterator[pa.RecordBatch]:
    """(bucket, g, names) from batches of (g, text): each group's tested chains, once a task, with a low bit if met twice."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def send() -> Iterator[pa.RecordBatch]:
        names, g = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        order = np.lexsort((names, g, bucket(names, n_buckets)))
        names, g = names[order], g[order]
        new = np.flatnonzero(np.concatenate(([True], (names[1:] != names[:-1]) | (g[1:] != g[:-1]))))
        many = np.diff(np.append(new, len(names))) > 1
        names, g = names[new], g[new]
        b = bucket(names, n_buckets)
        edges = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1], [True])))
        packed = ((names & LOW) << np.uint64(1)) | many
        rows = [(int(b[i]), g[i:j].astype("<i4").tobytes(), six(packed[i:j])) for i, j in zip(edges, edges[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True)], ["bucket", "g", "names"])

    for batch in batches:
        groups = batch.column(0).to_numpy(zero_copy_only=False)
        for block in blocks(batch.column(1).to_pylist()):
            if len(block.words) < WINDOW:
                continue
            p = parse(word_names(block.words), windows=False)
            chosen = p.chains % np.uint64(TESTED) == 0
            if chosen.any():
                held.append((p.chains[chosen], groups[block.number + block.owners()[p.at[chosen]]]))
            if sum(len(x) for x, _ in held) >= HELD:
                yield from send()
    if held:
        yield from send()


def shared_chains(table: pa.Table) -> pa.Table:
    """(g, names) of a bucket's chains that occur twice or more, for each group that sent them."""
    names = np.concatenate([from_six(x) for x in table["names"].to_pylist()])
    g = np.concatenate([np.frombuffer(x, "<i4") for x in table["g"].to_pylist()])
    key = names >> np.uint64(1)
    order = np.argsort(key, kind="stable")
    names, key, g = names[order], key[order], g[order]
    new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    n = np.diff(np.append(new, len(key)))
    shared = np.repeat((n > 1) | (np.bitwise_or.reduceat(names, new) & np.uint64(1)).astype(bool), n)
    return by_group(g[shared], key[shared])


def by_group(g: np.ndarray, *values: np.ndarray) -> pa.Table:
    """A row for each group, with the values packed."""
    order = np.lexsort((values[0], g))
    g, values = g[order], [v[order] for v in values]
    edges = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1], [True]))) if len(g) else np.zeros(1, int)
    spans = list(zip(edges, edges[1:], strict=False))
    columns = [pa.array([int(g[i]) for i, _ in spans], pa.int32()), *[pa.array([v[i:j].tobytes() for i, j in spans], pa.binary()) for v in values]]
    return pa.table(columns, names=["g", *["names", "later"][: len(values)]])


def packed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(g, rows): the rows of a batch that belong to a group, as a compressed Arrow stream without the column g."""
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    for batch in batches:
        g = batch.column(0).to_numpy(zero_copy_only=False)
        rest = pa.RecordBatch.from_arrays(batch.columns[1:], batch.schema.names[1:])
        out = []
        for k in np.unique(g):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rest.schema, options=options) as w:
                w.write_batch(rest.take(pa.array(np.flatnonzero(g == k))))
            out.append((int(k), sink.getvalue().to_pybytes()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())], ["g", "rows"])


def unpacked(table: pa.Table) -> pa.Table | None:
    """A group's rows in order of (id, text); a null id comes first. The columns _id and _text lead."""
    parts = [pa.ipc.open_stream(x).read_all() for x in table["rows"].to_pylist()]
    if not parts:
        return None
    rows = pa.concat_tables(parts)
    ids, texts = rows["_id"].to_pylist(), rows["_text"].to_pylist()
    return rows.take(pa.array(sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, texts[i])), pa.int64()))


def windows_of(rows: pa.Table, shared: np.ndarray, n_buckets: int, g: int) -> pa.Table:
    """(bucket, g, hashes, ids, runs, starts): the group's proposed windows, once each, at their first place."""
    found: list[tuple[np.ndarray, ...]] = []
    ids = rows["_id"].fill_null(-(1 << 63)).to_numpy()
    for block in blocks(rows["_text"].to_pylist()):
        if len(block.words) < WINDOW:
            continue
        names = word_names(block.words)
        p = parse(names, rounds=ROUNDS)
        alone = (p.chains % np.uint64(TESTED) == 0) & ~member(p.chains & LOW, shared)
        before = np.concatenate(([0], np.cumsum(alone)))
        first, last = np.clip(p.first, 0, len(alone)), np.clip(p.last + 1, 0, len(alone))
        ok = ((last <= first) | (before[np.maximum(first, last)] == before[first])) & block.inside(len(first))
        at = np.flatnonzero(ok)
        owner = block.owners()[at]
        if len(at):
            found.append((sequences(p.rounds, at), window_checks(names, at), block.number + owner, at - block.edges[owner]))
    if not found:
        return pa.table({"bucket": pa.array([], pa.int32()), "g": pa.array([], pa.int32()), **{x: pa.array([], pa.binary()) for x in ("hashes", "ids", "runs", "starts")}})
    h1, h2, doc, start = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((h2, h1))  # stable: places stay in order
    a, b = h1[order], h2[order]
    new = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
    many = (np.diff(np.append(new, len(a))) > 1).astype(np.uint64)
    one = order[new]
    where = bucket(h1[one], n_buckets)
    place = np.lexsort((one, where))
    one, many, where = one[place], many[place], where[place]
    edges = np.flatnonzero(np.concatenate(([True], where[1:] != where[:-1], [True])))
    out = []
    for i, j in zip(edges, edges[1:], strict=False):
        k = one[i:j]
        d = doc[k]
        heads = np.flatnonzero(np.concatenate(([True], d[1:] != d[:-1])))
        tail = (h2[k] << np.uint64(1) | many[i:j]).astype("<u2")
        out.append((int(where[i]), g, h1[k].astype("<u8").tobytes() + tail.tobytes(), ids[d[heads]].astype("<i8").tobytes(), np.diff(np.append(heads, len(d))).astype("<u4").tobytes(), start[k].astype("<u4").tobytes()))
    types = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
    return pa.table([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names=["bucket", "g", "hashes", "ids", "runs", "starts"])


def repeated_windows(table: pa.Table) -> pa.Table:
    """(g, names, later) of a bucket's windows that occur more than once: later holds the check, and a low bit if the group's first place is the first of all."""
    h1, h2, ids, starts, g = [], [], [], [], []
    for group, data, some, runs, places in zip(*(table[x].to_pylist() for x in ("g", "hashes", "ids", "runs", "starts")), strict=True):
        n = len(places) // 4
        h1.append(np.frombuffer(data, "<u8", n))
        h2.append(np.frombuffer(data, "<u2", n, 8 * n))
        ids.append(np.repeat(np.frombuffer(some, "<i8"), np.frombuffer(runs, "<u4")))
        starts.append(np.frombuffer(places, "<u4"))
        g.append(np.full(n, group, np.int32))
    h1, h2, ids, starts, g = map(np.concatenate, (h1, h2, ids, starts, g))
    order = np.lexsort((starts, g, ids, h2 >> 1, h1))
    h1, h2, g = h1[order], h2[order], g[order]
    first = np.concatenate(([True], (h1[1:] != h1[:-1]) | (h2[1:] >> 1 != h2[:-1] >> 1)))
    use = ~first | (h2 & 1).astype(bool)
    return by_group(g[use], h1[use], (h2 & 0xFFFE | first)[use].astype("<u2"))


def places(h: np.ndarray, checks: np.ndarray, names: np.ndarray, later: np.ndarray) -> np.ndarray:
    """Where each window is among the repeated ones, sorted by (name, check); -1 if it is not."""
    out = np.full(len(h), -1)
    if not len(names):
        return out
    at, live = np.searchsorted(names, h), np.arange(len(h))
    while len(live):  # more than once only where names are equal and checks are not
        same = at < len(names)
        same[same] = names[at[same]] == h[live[same]]
        live, at = live[same], at[same]
        hit = later[at] >> 1 == checks[live]
        out[live[hit]] = at[hit]
        live, at = live[~hit], at[~hit] + 1
    return out


def without_repeats(rows: pa.Table, names: np.ndarray, later: np.ndarray) -> tuple[list[int], list[int], list[str | None]]:
    """For each row: its words, how many of them go, and the rest joined by spaces. names and later: see `repeated_windows`, sorted."""
    n_words, n_removed, kept = [], [], []
    seen = np.zeros(len(later), bool)
    earliest = (later & 1).astype(bool)
    for block in blocks(rows["_text"].to_pylist()):
        n = len(block.words)
        cover = np.zeros(n + 1, np.int64)
        if n >= WINDOW and len(names):
            own = word_names(block.words)
            at = np.flatnonzero(block.inside(n - WINDOW + 1))
            found = places(sequences(levels(own, ROUNDS), at), window_checks(own, at), names, later)
            at, found = at[found >= 0], found[found >= 0]
            again = np.ones(len(at), bool)
            hit = np.flatnonzero(earliest[found])
            which, firsts = np.unique(found[hit], return_index=True)
            again[hit[firsts[~seen[which]]]] = False
            seen[which] = True
            starts = at[again]
            np.add.at(cover, starts, 1)
            np.add.at(cover, starts + WINDOW, -1)
        stays = np.cumsum(cover)[:n] == 0
        sums = np.concatenate(([0], np.cumsum(~stays)))
        for i, j in zip(block.edges.tolist(), block.edges[1:].tolist(), strict=False):
            gone = int(sums[j] - sums[i])
            n_words.append(j - i)
            n_removed.append(gone)
            kept.append(b" ".join(compress(block.words[i:j], stays[i:j].tolist()) if gone else block.words[i:j]).decode())
    return n_words, n_removed, kept


def dealt(docs: DataFrame, id_col: str, text_col: str, groups: int, *rest: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    row = docs.select(F.col(id_col).cast("long").alias("_id"), text.alias("_text"), *[F.col(f"`{x}`").alias(f"c{i}") for i, x in enumerate(rest)])
    return row.select(F.pmod(F.xxhash64("_id", "_text"), F.lit(groups)).cast("int").alias("g"), *row.columns)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256), one row for each of docs; with keep, also `kept` (the text left) and those columns as c0, c1 and so on.

    Earlier means a smaller id, then an earlier start; a null id comes first. Rows with the same id
    stand in an order that depends on their texts alone, and of equal rows the first stays. Null and
    empty texts have no words. An empty table gives an empty one.
    """
    groups = max(width(docs.sparkSession), -(-characters(docs, text_col) // GROUP_CHARS))
    n_buckets = groups

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from chain_blocks(batches, n_buckets)

    def propose(key, left: pa.Table, right: pa.Table) -> pa.Table:
        rows = unpacked(left)
        if rows is None:
            return windows_of(pa.table({"_id": pa.array([], pa.int64()), "_text": pa.array([], pa.string())}), np.zeros(0, np.uint64), n_buckets, 0)
        return windows_of(rows, together(right, "names"), n_buckets, key[0].as_py())

    def finish(key, left: pa.Table, right: pa.Table) -> pa.Table:
        rows = unpacked(left)
        if rows is None:
            return out.empty_table()
        later = np.concatenate([np.frombuffer(x, "<u2") for x in right["later"].to_pylist()] or [np.zeros(0, "<u2")])
        names = np.concatenate([np.frombuffer(x, "<u8") for x in right["names"].to_pylist()] or [np.zeros(0, np.uint64)])
        order = np.lexsort((later, names))
        n_words, n_removed, kept = without_repeats(rows, names[order], later[order])
        columns = [rows["_id"].combine_chunks(), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array([hashlib.sha256(x.encode()).hexdigest() for x in kept], pa.string())]
        if keep:
            # a text of which nothing goes stays as it is, white space included
            texts = [k if r else t for k, r, t in zip(kept, n_removed, rows["_text"].to_pylist(), strict=True)]
            columns += [pa.array(texts, pa.string()), *[rows[f"c{i}"].combine_chunks() for i in range(len(keep))]]
        return pa.table(columns, names=out.names)

    by_name = dict(docs.dtypes)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    if keep:
        schema += ", kept string, " + ", ".join(f"c{i} {by_name[x]}" for i, x in enumerate(keep))
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    out = to_arrow_schema(StructType.fromDDL(schema))

    texts = dealt(docs, id_col, text_col, groups)
    chains = texts.select("g", "_text").mapInArrow(count, "bucket int, g binary, names binary")
    shared = staged(chains.groupBy("bucket").applyInArrow(shared_chains, "g int, names binary"), "chains")
    packed = texts.mapInArrow(packed_rows, "g int, rows binary")
    windows = packed.groupBy("g").cogroup(shared.groupBy("g")).applyInArrow(propose, "bucket int, g int, hashes binary, ids binary, runs binary, starts binary")
    repeated = staged(windows.groupBy("bucket").applyInArrow(repeated_windows, "g int, names binary, later binary"), "windows")
    whole = dealt(docs, id_col, text_col, groups, *keep).mapInArrow(packed_rows, "g int, rows binary")
    return whole.groupBy("g").cogroup(repeated.groupBy("g")).applyInArrow(finish, schema)


def together(table: pa.Table, name: str) -> np.ndarray:
    return np.unique(np.concatenate([np.frombuffer(x, "<u8") for x in table[name].to_pylist()] or [np.zeros(0, np.uint64)]))


def without_repeated_passages(docs: DataFrame) -> DataFrame:
    """docs, same columns, with the words of repeated passages gone from `text`; a null text becomes an empty one."""
    rest = tuple(c for c in docs.columns if c != "text")
    found = remove_repeats(docs, keep=rest)
    names = {c: f"c{i}" for i, c in enumerate(rest)} | {"text": "kept"}
    return found.select(*[F.col(names[c]).alias(c) for c in docs.columns])


def op9_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Every row of documents without its repeated words; see `remove_repeats`."""
    return remove_repeats(documents(spark, sf_dir))
