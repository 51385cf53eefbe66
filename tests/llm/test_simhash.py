import random

import numpy as np
import xxhash

from knotwork.llm import components as stars
from knotwork.llm import simhash
from knotwork.llm.components import components


def brute_fp(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in low.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(pairs):
    """(doc_id, fp) -> sorted (doc_id, component)."""
    at = list(pairs)
    root = list(range(len(at)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(at)):
        for j in range(i):
            if (at[i][1] ^ at[j][1]).bit_count() <= 2:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(at):
        least[find(i)] = min(d, least.get(find(i), d))
    return sorted((d, least[find(i)]) for i, (d, _) in enumerate(at))


def test_query_rows_against_brute_force(docs, rows, none):
    got = simhash.near_duplicates(docs).collect()
    prints = [(r[0], brute_fp(r[1])) for r in rows]
    assert sorted((r.doc_id, r.fp % (1 << 64)) for r in got) == sorted(prints)
    assert sorted((r.doc_id, r.component_id) for r in got) == brute_components(prints)
    assert simhash.near_duplicates(none).count() == 0


def test_codewords_of_words_within_two_bits_meet():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 3000)
    i, j = rng.integers(0, 23, (2, 3000))
    other = words ^ (1 << i) ^ np.where(rng.random(3000) < 0.7, 1 << j, 0)
    a, b = simhash.codewords(words), simhash.codewords(other)
    assert all(set(x) & set(y) for x, y in zip(a, b, strict=True))
    assert {len(set(x)) for x in a} == {1, 6}


def test_links_with_full_keys(spark):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(40)]
    prints = set(base)
    for b in base[:12]:
        for _ in range(60):
            prints.add(b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (rng.random() < 0.3) << rng.randrange(64))
    prints = sorted(prints)
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p, i) for i, p in enumerate(prints)], "fp long, least long")
    found = {frozenset((r.a % (1 << 64), r.b % (1 << 64))) for r in simhash.links(frame).collect()}
    assert all((min(x) ^ max(x)).bit_count() <= 2 for x in found)
    got = {r.node % (1 << 64): r.component for r in components(simhash.links(frame)).collect()}
    want = brute_components(list(enumerate(prints)))
    classes = {}
    for i, c in want:
        classes.setdefault(c, set()).add(prints[i])
    mine = {}
    for p in prints:
        mine.setdefault(got.get(p, ("alone", p)), set()).add(p)
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, mine.values()))


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(5, i) for i in range(200, 260)] + [(7, 7), (300, 301), (301, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 100 for i in range(100, 141)) and all(got[i] == 5 for i in range(200, 260)) and got[301] == 300


def test_few_edges_take_few_tasks_and_star_rounds_find_the_same(spark, monkeypatch):
    rng = random.Random(3)
    edges = spark.createDataFrame([(rng.randrange(-400, 400), rng.randrange(-400, 400)) for _ in range(380)], "a long, b long")
    spark.sparkContext.setJobGroup("few edges", "")
    got = sorted(map(tuple, components(edges).collect()))
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("few edges"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 8
    monkeypatch.setattr(stars, "TASK_EDGES", 0)
    assert got == sorted(map(tuple, components(edges).collect()))
    assert components(edges.limit(0)).count() == 0


def test_one_of_each_group_stays(docs, none):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    want = {r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert sorted(ids) == sorted(want)
    assert simhash.keep_one(none).count() == 0
