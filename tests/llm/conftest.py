import random

import pytest

ODD = ["", " ", "\n\n", "a", "x" * 4000, "🙂 é ﬁ\x1c\x85 z", "token = abcdef123456 and AKIA" + "Q" * 16, "\t\x0b\f\r one\ttwo", "the the the the the the", "9" * 30 + " " + "a" * 30]


@pytest.fixture(scope="session")
def rows():
    """(doc_id, text, lang, source, n_chars) with nulls, empty and long texts, copies, ties and repeated rows."""
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(300)] + ["the", "of", "and", "a", "is"] * 20
    out = [(i, t, "en", "s", len(t)) for i, t in enumerate(ODD)]
    shared = " ".join(rng.choice(vocabulary) for _ in range(60))
    for i in range(60):
        body = " ".join(rng.choice(vocabulary) + rng.choice(["", ".", ",", "\n"]) for _ in range(rng.randint(0, 200)))
        if i % 5 == 0:
            body = f"{body} {shared} {body[:50]}"
        if i % 9 == 0:
            body += ' password: "hunter2hunter2" deadbeefdeadbeefdeadbeef00'
        out.append((100 + i, body, rng.choice(["en", "fr", None]), "s", len(body)))
    out += [(200 + i, out[20][1], "en", "s", 1) for i in range(6)] + [out[20], out[30], (300, None, None, None, None)]
    out.append((301, " ".join(rng.choice(vocabulary) for _ in range(5000)), "en", "s", 0))
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows as documents, with further columns whose names the operators use themselves."""
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("blob", "found", "label", "score", "length", "words", "stratum", "_n", "at", "g"):
        frame = frame.selectExpr("*", f"'clash' AS `{name}`")
    return frame.repartition(5)


@pytest.fixture(scope="session")
def none(docs):
    return docs.limit(0)
