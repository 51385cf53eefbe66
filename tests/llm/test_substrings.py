import hashlib
import random
import re

import numpy as np
import pytest

from knotwork.llm import substrings


def brute(rows):
    """rows (id, text) -> sorted (id, n_words, n_removed, digest), by the definition."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, rows[i][1] or ""))
    seen, out = set(), []
    for i in order:
        w = words[i]
        gone = [False] * len(w)
        for s in range(len(w) - 19):
            key = tuple(w[s : s + 20])
            if key in seen:
                gone[s : s + 20] = [True] * 20
            seen.add(key)
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((rows[i][0], len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def test_rows_against_brute_force(docs, rows, none):
    got = substrings.remove_repeats(docs).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == brute([(r[0], r[1]) for r in rows])
    assert substrings.remove_repeats(none).count() == 0
    out = substrings.without_repeated_passages(docs)
    assert out.columns == docs.columns and out.count() == len(rows)


@pytest.mark.parametrize("size", [2, 5, 60])
def test_runs_and_small_alphabets(spark, size):
    rng = random.Random(size)
    rows = []
    for i in range(80):
        words = []
        while len(words) < rng.randint(0, 160):
            words += [f"v{rng.randrange(size)}"] * rng.choice([1, 1, 1, 2, 3, 25])
        if rows and rng.random() < 0.5:
            other = rng.choice(rows)[1].split()
            at = rng.randrange(len(other) + 1)
            words[rng.randrange(len(words) + 1) : 0] = other[at : at + rng.choice([19, 20, 21, 50])]
        rows.append((rng.choice([i, i, 7, None]), " ".join(words)))
    got = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    ids = [r[0] for r in rows]
    unique = {x for x in ids if x is not None and ids.count(x) == 1}
    want = brute(rows)
    mine = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str)
    assert len(mine) == len(want) and sum(x[2] for x in want) > 0
    if len(unique) == len(ids):
        assert mine == want


def test_no_repeated_window_is_ruled_out():
    """Equal windows in different surroundings have the same chains in their safe interiors."""
    rng = np.random.default_rng(4)
    for size in (2, 3, 8, 1000):
        table = substrings.mixed(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(77))
        for _ in range(150):
            window = rng.integers(0, size, 20)
            chains = []
            for _ in range(2):
                before, after = rng.integers(0, size, (2, 30))
                if rng.random() < 0.3:
                    before[-rng.integers(1, 5) :] = window[0]
                x = table[np.concatenate((before, window, after))]
                p = substrings.parse(np.stack((x, x), axis=1))
                chains.append((p.chains[max(p.first[30], 0) : max(p.last[30] + 1, 0)], set(p.chains.tolist())))
            assert set(chains[0][0].tolist()) <= chains[1][1]
            assert set(chains[1][0].tolist()) <= chains[0][1]


@pytest.mark.parametrize("size", [2, 3, 8, 1000])
def test_sequences_name_windows(size):
    """Windows have equal sequences if and only if they have equal words, whatever is around them."""
    rng = np.random.default_rng(size)
    table = substrings.mixed(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(77))
    words = rng.integers(0, size, 6000)
    for _ in range(60):  # copies in other surroundings
        n = rng.integers(15, 90)
        a, b = rng.integers(0, 5900, 2)
        words[b : b + n] = words[a : a + n][: len(words) - b]
    x = table[words]
    at = np.arange(len(words) - substrings.WINDOW + 1)
    got = substrings.sequences(substrings.levels(np.stack((x, x * np.uint64(3)), axis=1), substrings.ROUNDS), at)
    known = {}
    for i, h in enumerate(got.tolist()):
        known.setdefault(tuple(words[i : i + 20].tolist()), set()).add(h)
    assert all(len(h) == 1 for h in known.values())
    assert len(set(got.tolist())) == len(known) < len(at)


def test_nothing_is_found_without_the_rounds(monkeypatch):
    """If rounds named symbols by their places too, no window would equal its copy."""
    names = substrings.word_names([b"w%d" % i for i in range(40)])
    at = np.arange(21)
    monkeypatch.setattr(substrings, "recompress", lambda below, salt, real=substrings.recompress: real(below + np.arange(len(below), dtype=np.uint64), salt))
    twice = np.concatenate((names, names))
    got = substrings.sequences(substrings.levels(twice, substrings.ROUNDS), np.concatenate((at, at + 40)))
    assert not set(got[:21].tolist()) & set(got[21:].tolist())


def test_checks_do_not_depend_on_place():
    words = [b"a", b"b", b"c", b"d", b"e"] * 30
    names = substrings.word_names(words)
    checks = substrings.window_checks(names, np.arange(100))
    assert len(set(checks.tolist())) == 5 and (checks[:5] == checks[95:]).all()


def test_equal_names_are_told_apart_by_their_checks():
    names, later = np.asarray([5, 5, 9], np.uint64), np.asarray([2 << 1, 7 << 1 | 1, 3 << 1], np.uint16)
    h, checks = np.asarray([5, 5, 5, 9, 1, 10], np.uint64), np.asarray([7, 2, 4, 3, 0, 0], np.uint64)
    assert substrings.places(h, checks, names, later).tolist() == [1, 0, -1, 2, -1, -1]


def test_a_long_text_many_groups_and_few_groups(spark, monkeypatch):
    rng = random.Random(8)
    passage = [f"p{rng.randrange(500)}" for _ in range(60)]
    rows = [(i, " ".join([f"w{rng.randrange(10**6)}" for _ in range(40)] + passage * (i % 3 == 0))) for i in range(60)]
    rows.append((100, " ".join(f"w{rng.randrange(3000)}" for _ in range(200_000)) + " " + " ".join(passage)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    for chars in (10_000_000, 20_000):
        monkeypatch.setattr(substrings, "GROUP_CHARS", chars)
        got = substrings.remove_repeats(frame).collect()
        assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == want
