import hashlib
import random

import pytest

from knotwork.llm import spotsigs


def pieces(fp):
    return {fp[i : i + 8] for i in range(0, len(fp), 8)}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def slow_signatures(text):
    words = text.encode().lower().split()
    named = [int.from_bytes(spotsigs._name(w), "little") for w in words]
    content = [i for i, n in enumerate(named) if not n & 1]
    return sum(1 for i, n in enumerate(named) if n & 2 and sum(c > i for c in content) >= 2)


def test_rows_against_brute_force(docs, rows, none):
    got = {}
    for r in spotsigs.compare_edited(docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    order = sorted(rows, key=lambda r: (r[0], r[1] or ""))
    texts = [r[1] or "" for r in order]
    prints = {r.doc_id: r.fingerprint for r in spotsigs.fingerprints(docs).collect()}
    assert sum(map(len, got.values())) == len(rows)
    for i, (row, text) in enumerate(zip(order, texts, strict=True)):
        following = texts[(i + 1) % len(texts)]
        q = len(text) // 4
        edited = text[: len(text) - q] + following[:q]
        digest = hashlib.sha256(edited.encode()).hexdigest()
        mine = [r for r in got[row[0]] if r.edited_sha256 == digest]
        assert mine, row[0]
        r = mine[0]
        assert r.n_chars == len(text) and r.fingerprint == prints[row[0]]
        assert r.near_edited == pytest.approx(jaccard(pieces(r.fingerprint), pieces(r.edited_fingerprint)))
        assert 0 <= r.near_next <= 1
        if len(got[row[0]]) == 1 and order[(i + 1) % len(order)][0] in prints:
            assert r.near_next == pytest.approx(jaccard(pieces(r.fingerprint), pieces(prints[order[(i + 1) % len(order)][0]])))
        assert len(pieces(r.fingerprint)) <= max(1, slow_signatures(text))
    assert spotsigs.compare_edited(none).count() == 0
    assert spotsigs.compare_edited(docs.where("doc_id = 110")).first().near_next == 1


def test_likeness_tells_copies_from_others(spark):
    rng = random.Random(3)
    words = [f"word{i}" for i in range(3000)] + ["the", "of", "and"] * 700
    rows = [(i, " ".join(rng.choice(words) for _ in range(400))) for i in range(40)]
    out = spotsigs.compare_edited(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert min(r.near_edited for r in out) > 0.4 and max(r.near_next for r in out) < 0.05


def test_pairs_against_all_pairs(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(200)] + ["the", "of", "and"] * 30
    rows = []
    for i in range(60):
        text = [rng.choice(words) for _ in range(rng.randint(1, 120))]
        rows.append((3 * i, " ".join(text)))
        if i % 3 == 0:
            rows.append((3 * i + 1, " ".join(text)))
        at = rng.randrange(len(text))
        text[at] = "changed"
        rows.append((3 * i + 2, " ".join(text)))
    prints = spotsigs.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).cache()
    classes, pairs = spotsigs.near_pairs(prints)
    local = {r.doc_id: r.fingerprint for r in prints.collect()}
    by_print = {}
    for d, f in sorted(local.items()):
        by_print.setdefault(f, d)
    assert {r.doc_id: r["class"] for r in classes.collect()} == {d: by_print[f] for d, f in local.items()}
    want = {}
    heads = sorted((d, pieces(f)) for f, d in by_print.items())
    for i, (a, x) in enumerate(heads):
        for b, y in heads[i + 1 :]:
            if jaccard(x, y) >= 0.8:
                want[a, b] = jaccard(x, y)
    assert {(r.a, r.b): pytest.approx(r.likeness) for r in pairs.collect()} == want and want
