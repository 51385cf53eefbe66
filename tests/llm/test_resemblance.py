import random

from knotwork.llm import resemblance


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def alike(a, b):
    return len(a & b) >= 0.8 * len(a | b) if a or b else True


def brute(rows):
    """The least ids of the groups of (doc_id, text)."""
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if alike(sets[i], sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return sorted(least.values())


def near_rows():
    """Groups of copies with some words changed, so that similarities lie on both sides of 0.8."""
    rng, rows = random.Random(5), []
    for _ in range(12):
        base = [f"v{rng.randrange(3000)}" for _ in range(rng.randint(80, 240))]
        for _ in range(rng.choice([2, 5, 30])):
            words = list(base)
            for at in rng.sample(range(len(words)), rng.randint(1, 6)):
                words[at] = f"n{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(words)))
    return rows


def test_pairs_of_similar_shingles_are_one_group(spark):
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(r.doc_id for r in resemblance.keep_one(docs).collect()) == brute(rows)


def test_one_row_a_group_with_repeated_and_null_ids(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (1, b), (1, b), (2, a), (3, b + " end"), (None, c), (None, c), (None, c + " end"), (None, a)]
    kept = [(r.doc_id, r.text) for r in resemblance.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()]
    assert sorted(kept[i] for i in range(len(kept)) if kept[i][0] is not None) == [(1, a), (1, b)]
    assert len(kept) == 3 and {(None, c), (None, c + " end")} & set(kept)


def test_pairs_below_the_bound_are_dropped_by_their_marks(spark, monkeypatch):
    rng = random.Random(9)
    base = [f"v{i}" for i in range(150)]
    rows = []
    for i in range(200):
        words = list(base)
        for at in rng.sample(range(5, 145, 5), 3):
            words[at] = f"e{at} {rng.randrange(2)}"
        rows.append((i, " ".join(words)))
    looked, similar = [], resemblance.similar

    def counted(pairs, *rest):
        looked.append(pairs.count())
        return similar(pairs, *rest)

    monkeypatch.setattr(resemblance, "similar", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(r.doc_id for r in resemblance.keep_one(docs).collect()) == brute(rows)
    assert sum(looked) < 1000
    a, b = (resemblance.shingle_set(rows[i][1]) for i in (0, 1))
    x, y = (resemblance.marks(s) for s in (a, b))
    lacks = sum(int(p & ~q).bit_count() if p & ~q >= 0 else (int(p & ~q) + (1 << 64)).bit_count() for p, q in zip(x.tolist(), y.tolist(), strict=True))
    found = spark.createDataFrame([(x.tolist(), y.tolist())], "x array<long>, y array<long>").select(resemblance.lacking("x", "y")).first()[0]
    assert 0 < found == lacks <= len(set(a.tolist()) - set(b.tolist()))
