import random

import numpy as np

from knotwork.llm import language, toxicity
from knotwork.llm.sampling import labelled_sample


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_size_and_rows_of_a_sample(spark):
    rows = [(i, f"text {i}", "ab"[i % 10 == 0]) for i in range(6000)]
    docs = spark.createDataFrame([*rows, (3, "again", "a"), (None, "no id", "a"), (9000, None, "c"), (9001, "x", None)], "doc_id long, text string, lang string")
    got = labelled_sample(docs, docs.selectExpr("doc_id", "lang AS label"), 500).collect()
    by = {k: [r.doc_id for r in got if r.label == k] for k in "abc"}
    assert 400 < len(set(by["a"])) < 600 and 400 < len(by["b"]) < 600 and by["c"] == [9000]
    assert all(r.doc_id is not None and r.text is not None for r in got)
    few = labelled_sample(docs, docs.selectExpr("doc_id", "lang AS label"), 700).where("label = 'b'").count()
    assert few == 600  # a label with fewer documents is taken whole
    assert labelled_sample(docs.limit(0), docs.limit(0).selectExpr("doc_id", "lang AS label"), 5).count() == 0


def test_nothing_but_counts_is_dealt_by_label(spark, monkeypatch):
    """Whatever Spark may broadcast by itself, rows are never exchanged by label before the sample is thinned."""
    plans = []
    monkeypatch.setattr("knotwork.llm.sampling.staged", lambda frame, name: plans.append(plan_of(frame)) or frame)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = spark.createDataFrame([(i, "t", "ab"[i % 2]) for i in range(100)], "doc_id long, text string, lang string")
        labelled_sample(docs, docs.selectExpr("doc_id", "lang AS label"), 10)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    (plan,) = plans
    assert "Window" not in plan and "SortMergeJoin" not in plan
    dealt = [x for x in plan.splitlines() if "hashpartitioning(label" in x]
    assert len(dealt) == 1  # of the partial counts


def test_a_long_text_is_counted_the_same_however_it_is_cut():
    rng = random.Random(3)
    text = "".join(rng.choice("abcdef \n") for _ in range(30_000))
    whole = [np.bincount(f, minlength=1 << language.BITS) for f in language.hashed(np.frombuffer(text.encode("utf-32-le"), np.uint32))]
    for size in (997, 4096, 50_000):
        total = [np.zeros(1 << language.BITS, int) for _ in whole]
        for block in language.blocks(["short", text, "tail"][1:2], size):
            for t, f in zip(total, block.features(), strict=True):
                t += np.bincount(f[block.own], minlength=1 << language.BITS)
        assert all((a == b).all() for a, b in zip(whole, total, strict=True))


def test_many_languages_and_a_long_text(spark):
    rows = [(i, f"{chr(97 + i % 26) * 3} {chr(97 + i // 26)}", f"l{i:03d}") for i in range(120)] + [(500, "aaa " * 400_000, "l000")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language.identify(docs).collect()}
    assert len(got) == 121 and got[500] in {f"l{i:03d}" for i in range(120)}


def test_toxicity_of_odd_rows(docs, none, rows, spark):
    labels = spark.createDataFrame([(100 + i, i % 2) for i in range(60)], "doc_id long, toxic int")
    scored = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    assert len(scored) == len(rows) and all(0 <= r.score <= 1 for r in scored)
    same = {r.score for r in scored if r.doc_id is not None and 200 <= r.doc_id < 206}
    assert len(same) == 1  # repeated texts
    assert toxicity.score(none, toxicity.train(none, labels.limit(0))).count() == 0


def test_k_of_the_extreme_value_law_is_recovered():
    rng = np.random.default_rng(5)
    n = rng.integers(20, 400, 40_000)
    k, rate = 0.03, 1.4
    best = np.maximum(0, -np.log(rng.exponential(size=len(n)) / (k * n)) / rate)
    got = toxicity.extreme_value_k(best, n, rate)
    assert abs(got - k) < 0.002
    assert abs((got * n * np.exp(-rate * best) <= 0.05).mean() - 0.0488) < 0.005  # one harmless text in twenty has a passage of E-value 0.05
    best[:400] = 100  # mislabelled ones don't set the law
    assert abs(toxicity.extreme_value_k(best, n, rate) - k) < 0.003
    assert toxicity.extreme_value_k(np.zeros(0), np.zeros(0), 1.0) > 0
