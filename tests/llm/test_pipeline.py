import re
import zlib

import corpus_pipeline
import pytest
import test_packing
import test_secrets
import test_simhash
import test_substrings

from knotwork.llm import secrets


@pytest.fixture(scope="module")
def stages(spark, docs, tmp_path_factory):
    """What each stage got and returned, written and read again as in a run."""
    folder = str(tmp_path_factory.mktemp("stages"))
    now = docs.select("doc_id", "text", "lang", "source", "n_chars")
    now.write.parquet(f"{folder}/documents.parquet")
    now, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, folder).write.parquet(f"{folder}/{k}")
        after = spark.read.parquet(f"{folder}/{k}")
        out.append((now, after))
        now = after
    return folder, out


def texts(frame):
    return sorted(((r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()), key=str)


def test_language_stage_keeps_texts_with_letters(stages):
    before, after = stages[1][0]
    assert after.columns == before.columns
    kept = {r[0] for r in texts(after)}
    assert all((d in kept) == any(map(str.isalpha, t or "")) for d, t in texts(before) if d not in (3, 4, 8)), "plain texts stay"


def test_near_duplicate_stage(stages):
    before, after = stages[1][1]
    groups = test_simhash.brute_components([(d, test_simhash.brute_fp(t)) for d, t in texts(before)])
    assert [d for d, _ in texts(after)] == sorted({c for _, c in groups}, key=lambda c: str((c, dict(texts(after))[c])))


def test_substring_stage(stages):
    before, after = stages[1][2]
    want = {d: (n, gone) for d, n, gone, _ in test_substrings.brute(texts(before))}
    old = dict(texts(before))
    for d, t in texts(after):
        n, gone = want[d]
        assert t == old[d] if not gone else len(re.findall(r"[^\x20\x09-\x0D]+", t)) == n - gone


def test_secret_stage(stages):
    before, after = stages[1][3]
    old = dict(texts(before))
    for d, t in texts(after):
        if test_secrets.brute(old[d])[4]:
            assert "[secret]" in t and test_secrets.brute(t)[4] == ""
        elif not any(re.search(r.pattern.replace(r"\s", "[ \t]"), old[d]) for r in secrets.MORE):
            assert t == old[d]


def test_packing_stage_and_run(spark, stages):
    folder, out = stages
    before, after = out[4]
    test_packing.check(after.collect(), texts(before))
    ran = corpus_pipeline.run(spark, folder)
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in ran.collect()) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in after.collect())
    assert corpus_pipeline.ORACLE_SQL is None and zlib
