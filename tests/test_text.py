"""Text functions against Python restatements of their definitions."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from knotwork.functions import text as T
from knotwork.functions.text import ADDRESS_STOP, BUSINESS_STOP

#: Letters of several scripts, marks, digits that aren't ASCII, punctuation and white space, put together by a seeded rule.
PARTS = ["kelp", "Zander", "ÖRE", "naïf", "ß", "İ", "漁港", "うみ", "рыба", "سمك", "मछली", "ΟΔΟΣ", "fi", "ﬁ", "½", "②", "Ⅳ", "e\u0301", "7", "٣", "_", "-", "...", "&", "(", ")", "'", "\x1c", "\x85", "\xa0", "\t", "\n", "  ", " ", " "]
_rng = random.Random(20)
TEXTS = [None, "", "  ", "ab", "a b", "Ünter  WASSER-Werke (Nord)", *["".join(_rng.choice(PARTS) for _ in range(_rng.randint(1, 12))) for _ in range(60)]]
#: Numbers and codes of many lengths beside letters and signs.
ADDRESSES = [None, "", *[" ".join(_rng.choice(["12", "407", "55218", "1234567", "x99", "99x", "_44", "31-72", "AB1 2CD", "q7 8zz", "N16 5", "EC4N1TX", "१२३४", "quay", "lane,"]) for _ in range(_rng.randint(1, 8))) for _ in range(40)]]


def rows(spark, values, column):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "x string").select(column).collect()]


def python_normal(x, fold):
    x = fold(x or "")
    return re.sub(r"\s+", " ", re.sub(r"[^\w\s]", " ", x)).strip()


def test_normalize(spark):
    assert rows(spark, TEXTS, T.normalize(F.col("x"))) == [python_normal(x, str.lower) for x in TEXTS]
    exact = rows(spark, TEXTS, T.normalize(F.col("x"), exact=True))
    assert exact == [python_normal(x, lambda s: unicodedata.normalize("NFC", s).casefold()) for x in TEXTS]
    assert rows(spark, ["Fuß İda"], T.normalize(F.col("x"), exact=True)) == ["fuss i da"]
    assert rows(spark, ["मछली"], T.normalize(F.col("x"))) == ["मछल"]
    assert rows(spark, ["मछली"], T.normalize(F.col("x"), keep_marks=True)) == ["मछली"]


def test_tokens(spark):
    got = rows(spark, ["kelp reef kelp ltd reef", None, "q.r. tide"], T.tokenize(T.normalize(F.col("x"))))
    assert got == [["kelp", "reef", "ltd"], [], ["q", "r", "tide"]]
    stop, street = BUSINESS_STOP[0], ADDRESS_STOP[0]
    assert rows(spark, [f"kelp {stop} z"], T.name_terms(T.tokenize(F.col("x")))) == [["kelp"]]
    assert rows(spark, [f"31 quay {street} ab 55218"], T.address_terms(T.tokenize(F.col("x")))) == [["quay", "55218"]]


@pytest.mark.parametrize("n", [3, 4])
def test_ngrams(spark, n):
    def want(x):
        c = re.sub(r"\s+", "", x or "")
        return [] if not c else [c] if len(c) <= n else list(dict.fromkeys(c[i : i + n] for i in range(len(c) - n + 1)))

    assert rows(spark, TEXTS, T.char_ngrams(F.col("x"), n)) == [want(x) for x in TEXTS]


def test_postal_tokens(spark):
    def want(x):
        found = re.findall(r"\b\d{3,6}\b", x or "") + [re.sub(r"\s+", "", m).casefold() for m in re.findall(r"\b[A-Za-z]{1,2}\d{1,2}[A-Za-z]?\s*\d[A-Za-z]{2}\b", x or "")]
        return list(dict.fromkeys(found))

    assert rows(spark, ADDRESSES, T.postal_tokens(F.col("x"))) == [want(x) for x in ADDRESSES]


def test_keys_and_lists(spark):
    assert rows(spark, [" us ", None], T.country_key(F.col("x"))) == ["US", ""]
    assert rows(spark, ["S2-1", "S3-x-1"], T.source_of(F.col("x"))) == ["S2", "S3"]
    assert rows(spark, [" S2-31 , S2-15,, ", None, ""], T.id_list(F.col("x"))) == [["S2-31", "S2-15"], [], []]
    assert rows(spark, ["a:0.5,b:1"], T.score_map(F.col("x"))) == [{"a": 0.5, "b": 1.0}]
    assert rows(spark, ["x"], T.format_scores(F.array(F.lit("a")), F.array(F.lit(0.25)))) == ["a:0.2500"]
