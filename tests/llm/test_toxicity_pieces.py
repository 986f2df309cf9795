"""The toxicity model is learnt from texts read a piece at a time."""

import numpy as np

from wxgrid.llm import toxicity


def test_sample_is_read_in_pieces(monkeypatch):
    rng = np.random.default_rng(2)
    words = [f"wort{i}" for i in range(200)] + ["é", "漢字", "a"]
    toxic = np.arange(120) % 3 == 0
    texts = [" ".join(rng.choice(words, 40)) + (" vile slur" * int(rng.integers(1, 4)) if y else "") + "." * int(rng.integers(0, 3)) for y in toxic]
    whole = toxicity.fit(texts, toxic)
    sizes, made = [], toxicity.Tokens.__init__
    monkeypatch.setattr(toxicity.Tokens, "__init__", lambda self, buf, off: sizes.append(len(buf)) or made(self, buf, off))
    monkeypatch.setattr(toxicity, "FIT_PIECE_BYTES", 1000, raising=False)
    parts = toxicity.fit(texts, toxic)
    assert max(sizes) <= 1000 < sum(map(len, texts))
    assert np.array_equal(whole.weights, parts.weights) and whole.bias == parts.bias and np.array_equal(whole.trans, parts.trans)
    assert np.allclose(whole.doc, parts.doc)
    assert toxicity.fit([], np.zeros(0)) is None
