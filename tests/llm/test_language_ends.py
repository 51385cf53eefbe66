import numpy as np

from knotwork.llm import language


def test_a_text_is_judged_alike_alone_and_beside_others(monkeypatch):
    weights = np.random.default_rng(3).normal(size=(len(language.ORDERS) << language.BITS, 3)).astype(np.float32)
    texts = ["a", "the cat", "", "a", "und so", "é", "xy", "a"]
    _, together = language.judged(texts, ["de", "en", "fr"], weights)
    alone = [language.judged([t], ["de", "en", "fr"], weights)[1][0] for t in texts]
    assert np.allclose(together, alone, atol=1e-9)
    long = "abcdefghij" * 3
    whole = language.judged([long], ["de", "en", "fr"], weights)[1]
    monkeypatch.setattr(language, "BLOCK", 7)
    assert np.allclose(language.judged([long, "a"], ["de", "en", "fr"], weights)[1][0], whole, atol=1e-6)
