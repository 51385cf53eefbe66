import re
from collections import Counter

import pytest

from knotwork.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def test_counts(docs, rows, none):
    got = quality.measured(docs).collect()
    assert sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == sorted((r[0], *brute(r[1])) for r in rows)
    assert quality.measured(none).count() == 0


def test_binomial_cdf(spark):
    from math import comb

    from pyspark.sql import functions as F

    cases = [(0, 10, 0.1), (3, 200, 0.05), (7, 1000, 0.01), (1, 1, 0.5)]
    for k, n, p in cases:
        want = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        got = spark.range(1).select(quality.binomial_cdf(F.lit(k).cast("long"), F.lit(n).cast("long"), p)).first()[0]
        assert got == pytest.approx(want, rel=1e-9)


def test_cutoffs_keep_good_documents(spark):
    rows = [(i, " ".join(f"word{(i * 37 + j * j) % 997}" for j in range(80)) + (" ###" * 60 if i % 4 == 0 else ""), "en") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(4000)], "doc_id long, quality int")
    m = quality.measured(docs).cache()
    limits = quality.cutoffs(m, labels)
    out = {r.doc_id: r.kept for r in quality.judge(m, limits).collect()}
    good = [out[i] for i in range(4000) if i % 4]
    bad = [out[i] for i in range(0, 4000, 4)]
    assert sum(good) / len(good) >= 1 - quality.RISK and sum(bad) == 0
    none = quality.judge(m, quality.cutoffs(m, labels.limit(0)))
    assert none.where("kept").count() == none.where("not base_failed").count()
