import math
import random

import numpy as np

from knotwork.llm import language, toxicity


def tongue(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


def made(spark, n=400):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        lang = ["aa", "bb", "cc"][i % 3]
        rows.append((i, tongue(rng, {"aa": "aeioumn", "bb": "xzkqtrp", "cc": "äöüßsch"}[lang], rng.randint(5, 60)), lang))
    rows += [(n, None, "aa"), (n + 1, "123 !!", "bb"), (n + 2, "", None), (n + 3, "aeiou " * 100_000, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_languages_of_held_out_texts(spark):
    docs = made(spark)
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    want = {r.doc_id: r.lang for r in docs.collect()}
    held = [i for i in range(400) if got[i].held_out]
    assert len(held) > 50 and sum(got[i].lang_pred == want[i] for i in held) / len(held) > 0.98
    assert [got[i].lang_pred for i in (400, 401, 402, 403)] == ["und", "und", "und", "aa"]
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_score_is_naive_bayes(spark):
    sample = made(spark, 60).where("doc_id < 60").selectExpr("doc_id", "text", "lang AS label")
    languages, table = language.fit(sample)
    text = "aeion xzk"
    sums = np.zeros(len(languages))
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    for n, features in enumerate(language.hashed(points)):
        for f in features:
            sums += table[(n << language.BITS) + f]
    predicted, score = language.judged([text], languages, table)
    p = np.exp(sums - sums.max()) / np.exp(sums - sums.max()).sum()
    assert predicted[0] == languages[int(sums.argmax())] and math.isclose(score[0], p.max(), rel_tol=1e-4)


def test_language_of_odd_rows(docs, none, rows):
    assert language.identify(docs).count() == len(rows)
    assert language.identify(none).count() == 0
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns and kept.where("doc_id = 300").count() == 0


def test_segments_against_all_intervals():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randint(1, 14)
        values = [rng.choice([None, None, 1.0, 2.5, 0.5]) for _ in range(n)]
        negative = -0.7
        places = [i for i, v in enumerate(values) if v is not None]
        found = toxicity.segments(places, [values[i] for i in places], negative)
        full = [negative if v is None else v for v in values]

        def maximal(a, b, full=full):
            """The recursive definition: the best interval, then the best ones left and right of it."""
            best = max(((sum(full[i:j]), -(j - i), -i) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0, 0, 0))
            if best[0] <= 1e-12:
                return []
            i, j = -best[2], -best[2] - best[1]
            return [*maximal(a, i), (i, j, best[0]), *maximal(j, b)]

        want = maximal(0, n)
        assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in want]
        assert np.allclose([s for *_, s in found], [s for *_, s in want])


def test_toxic_passages_stand_out(spark):
    rng = random.Random(5)
    words = [f"{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    rows, labels = [], []
    for i in range(900):
        text = [rng.choice(words) for _ in range(rng.randint(10, 120))]
        toxic = i % 5 == 0
        if toxic:
            at = rng.randrange(len(text))
            text[at:at] = rng.sample(["moron", "scumbag", "trashy", "loser"], 3)
        elif i % 7 == 0:
            text.append("moron")
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame([*rows, (5000, None), (5001, "")], "doc_id long, text string")
    table = spark.createDataFrame([*labels, (None, 1), (7000, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, table)
    got = {r.doc_id: r for r in toxicity.score(docs, model, with_passages=True).collect()}
    right = sum((got[i].score >= 0.3) == bool(t) for i, t in labels) / len(labels)
    assert right > 0.97 and got[5000].score == got[5001].score < 0.3
    assert got[0].passages and got[0].passages[0].end - got[0].passages[0].first >= 3
    untaught = toxicity.train(docs, table.limit(0))
    assert toxicity.score(docs, untaught).count() == len(rows) + 2
