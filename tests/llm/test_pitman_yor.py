import math
import random
import re
import types
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from knotwork.llm import pitman_yor as py


def cut(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), "\n"]


def held(i):
    return zlib.crc32(str(i).encode()) % 7 == 2


def test_counts_and_base_score(docs, rows, none):
    c = Counter(w for r in rows if not held(r[0]) for w in cut(r[1]))
    n, v = sum(c.values()), len(c)
    want = sorted((r[0], held(r[0]), len(cut(r[1])), sum(c[w] > 0 for w in cut(r[1])), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in cut(r[1])), 6)) for r in rows)
    got = py.score_documents(docs).collect()
    assert sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)
    same = {round(r.score, 9) for r in got if 200 <= r.doc_id < 206 and not r.held_out}
    assert len(same) == 1
    assert py.score_documents(none).count() == 0


def corpus(n=120, words=40, seed=2):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    follows = {w: rng.choices(vocabulary, k=4) for w in vocabulary}
    out = []
    for i in range(n):
        text = [rng.choice(vocabulary)]
        while len(text) < 30:
            text.append(rng.choice(follows[text[-1]]) if rng.random() < 0.7 else rng.choice(vocabulary[: 1 + rng.randrange(words)]))
        out.append((i, " ".join(text)))
    return vocabulary, out


def seats_of(texts, n_rounds, monkeypatch, spread=()):
    """A model of one bucket, without Spark: texts are (held out, text)."""
    monkeypatch.setattr(py, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 0)))
    dealt = py.Dealt(np.asarray([0]), np.sort(np.asarray(spread, np.uint64)))
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array([h for h, _ in texts]), pa.array([t for _, t in texts])], ["doc_id", "held_out", "text"])
    merged = py.merge(pa.Table.from_batches(py.send(iter([batch]), dealt, 0, 1)), dealt)
    m = py.loaded(merged)
    totals, state, shared = py.Totals(), None, []
    for k in range(n_rounds + 1):
        if k:
            before = py.Seats(m, totals, state, shared, dealt)
            state = before.reseated(k)
        seats = py.Seats(m, totals, state, [], dealt)
        if k:
            seats.word_counts, seats.word_tables = before.word_counts, before.word_tables
        answers = py.add(pa.Table.from_batches([py.batch_of(seats.messages(0, dealt), py.STEP)]), totals, k)
        one = answers.to_pylist()
        discounts = totals.discounts if k else (py.discount(one[-1]["one0"], one[-1]["two0"]), *[py.discount(merged[f"one{x}"][0].as_py(), merged[f"two{x}"][0].as_py()) for x in (1, 2)])
        totals = py.Totals(*[one[-1][x] for x in ("customers", "tables", "n", "vocabulary")], discounts)
        shared = [(r["reducer"], r["payload"]) for r in one if r["bucket"] is not None]
    return m, py.Seats(m, totals, state, shared, dealt)


@pytest.mark.parametrize("spread", [(), ("w1", "w3")])
def test_chances_after_a_context_sum_to_one(monkeypatch, spread):
    words, rows = corpus()
    tried = [("w1", "w3"), ("w3", "w17"), ("new", "w1"), ("new", "newer")]
    held_texts = [" ".join(f"{a} {b} {w}" for w in [*words, "unknown"]) for a, b in tried] + [f"{a} {b}" for a, b in tried]
    name = lambda w: py.names_of([w.encode()])
    m, seats = seats_of([(False, t) for _, t in rows] + [(True, t) for t in held_texts], 3, monkeypatch, [int(name(w)[0]) for w in spread])
    assert seats.totals.n == 120 * 31 and seats.totals.vocabulary == 41
    p, word = seats.chances(), m["words"][m["pair_word"][m["pair"]]]
    by_context = defaultdict(dict)
    for k, x in enumerate(m["double"].tolist()):
        by_context[x][int(word[k])] = p[k]
    every = {int(name(w)[0]) for w in [*words, "\n", "unknown"]}
    whole = [x for x in by_context.values() if every <= set(x)]
    assert len(whole) >= len(tried)
    for x in whole:
        assert sum(x[w] for w in every) == pytest.approx(1, abs=1e-9)
    # seats: one table for a customer, at most one each
    c, t = m["counts"], seats.tables
    assert ((t <= c) & ((t > 0) == (c > 0))).all() and (t[c > 1] < c[c > 1]).any()


class Restaurants:
    """A brute-force sampler: every customer's table is kept, and a sweep takes each token out and puts it in again."""

    def __init__(self, discounts, strengths, vocabulary, rng):
        self.d, self.s, self.v, self.rng = discounts, strengths, vocabulary, rng
        self.at = [defaultdict(lambda: defaultdict(list)) for _ in range(3)]  # level -> context -> dish -> sizes of its tables

    def chance(self, level, context, dish):
        if level < 0:
            return 1 / (self.v + 1)
        rooms = self.at[level].get(context, {})
        n = sum(map(sum, rooms.values()))
        t = sum(map(len, rooms.values()))
        own = rooms.get(dish, [])
        up = self.chance(level - 1, context[1:], dish)
        return (sum(own) - self.d[level] * len(own) + (self.s[level] + self.d[level] * t) * up) / (self.s[level] + n)

    def put(self, level, context, dish):
        if level < 0:
            return
        rooms = self.at[level][context]
        t = sum(map(len, rooms.values()))
        tables = rooms[dish]
        weights = [x - self.d[level] for x in tables] + [(self.s[level] + self.d[level] * t) * self.chance(level - 1, context[1:], dish)]
        k = self.rng.choices(range(len(weights)), weights)[0]
        if k < len(tables):
            tables[k] += 1
        else:
            tables.append(1)
            self.put(level - 1, context[1:], dish)

    def take(self, level, context, dish):
        if level < 0:
            return
        tables = self.at[level][context][dish]
        k = self.rng.choices(range(len(tables)), tables)[0]
        tables[k] -= 1
        if not tables[k]:
            del tables[k]
            self.take(level - 1, context[1:], dish)
        if not tables:
            del self.at[level][context][dish]


def test_scores_against_a_sampler_of_customers(spark):
    _, rows = corpus(60, 12)
    training = [(("\n", "\n", *cut(t)), i) for i, t in rows if not held(i)]
    customers = [((x[j - 2], x[j - 1]), x[j]) for x, _ in training for j in range(2, len(x))]
    levels = [Counter(w for w, _ in {(w, c[1]) for c, w in customers}), Counter((c[1], w) for c, w in set(customers)), Counter(customers)]
    discounts = []
    for counts in levels:
        one, two = (sum(x == k for x in counts.values()) for k in (1, 2))
        discounts.append(min(max(one / (one + 2 * two), 0.1), 0.95) if one + two else 0.5)
    model = Restaurants(discounts, py.STRENGTHS, len({w for _, w in customers}), random.Random(1))
    for c, w in customers:
        model.put(2, c, w)
    tried = [(i, ["\n", "\n", *cut(t)]) for i, t in rows if held(i)]
    sums, kept = defaultdict(float), 0
    for sweep in range(14):
        for c, w in customers:
            model.take(2, c, w)
            model.put(2, c, w)
        if sweep >= 6:
            kept += 1
            for i, x in tried:
                for j in range(2, len(x)):
                    sums[i, j] += model.chance(2, (x[j - 2], x[j - 1]), x[j])
    want = {i: sum(math.log10(sums[i, j] / kept) for j in range(2, len(x))) for i, x in tried}
    got = {r.doc_id: r for r in py.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), 12, 4).collect()}
    assert len(want) >= 5
    for i, s in want.items():
        assert got[i].held_out and got[i].score == pytest.approx(s, rel=0.02), (i, got[i].base_score)
        assert got[i].score > got[i].base_score


def test_scores_do_not_depend_on_how_tokens_are_dealt(spark, monkeypatch):
    _, rows = corpus()
    docs = spark.createDataFrame([*rows, (500, "the " * 3000), (501, None), (None, "w1 w2"), (None, "w1 w2")], "doc_id long, text string")
    first = sorted((str(r.doc_id), round(r.score, 8)) for r in py.score_documents(docs).collect())
    monkeypatch.setattr(py, "BUCKET_CHARS", 500)
    monkeypatch.setattr(py, "LOOKED_AT", 1)
    monkeypatch.setattr(py, "SPREAD", 0.5)
    before = py.frequent(docs.selectExpr("doc_id", "false AS held_out", "coalesce(text, '') AS text"), 0.02)
    assert 1 <= len(before) <= 50
    assert sorted((str(r.doc_id), round(r.score, 8)) for r in py.score_documents(docs.repartition(7)).collect()) == first


def test_held_out_texts_are_likelier_than_under_the_base(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    rows = []
    for i in range(500):
        text = rng.choices(words, weights, k=60)
        rows.append((i, " ".join(x for w in text for x in (w, w + "tail"))))
    got = [r for r in py.score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.held_out]
    assert len(got) > 30
    assert sum(r.score for r in got) > 0.75 * sum(r.base_score for r in got)


def test_no_training_documents_and_no_working_tables_left(spark):
    ids = [i for i in range(200) if held(i)][:5]
    got = py.score_documents(spark.createDataFrame([(i, "a b c") for i in ids], "doc_id long, text string")).collect()
    assert len(got) == 5 and all(r.n_known == 0 and r.train_tokens == 0 and r.score <= 0 for r in got)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("knotwork_")]


def test_packed_numbers():
    for x in ([], [0, 255], [256], [1 << 20, 5], [1 << 40]):
        assert py.unpacked(py.packed(np.asarray(x, np.int64))).tolist() == x


def test_names_go_by_all_bytes_of_a_word():
    words = [b"a" * n + end for n in range(20) for end in (b"", b"\0", b"\0\0", b"b", "é".encode())][1:]
    whole = pa.array(words, pa.binary())
    names = py.word_names(whole)
    assert len(set(names.tolist())) == len(set(words))
    assert all(py.names_of([w])[0] == n for w, n in zip(words, names, strict=True))
    assert (py.word_names(whole.slice(7, 30)) == names[7:37]).all() and not len(py.names_of([]))


def test_buckets_go_by_the_text_alone_above_one_a_part(spark):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert py.buckets(spark, 0) == py.buckets(spark, parts * py.BUCKET_CHARS) == parts
    assert py.buckets(spark, parts * py.BUCKET_CHARS + 1) == parts + 1
