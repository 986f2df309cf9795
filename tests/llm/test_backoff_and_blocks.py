"""Stupid-backoff scores against a plain restatement; language vectors in blocks."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wxgrid.llm import backoff_lm, language_id

ROWS = [(1, "the cat sat on the mat and the cat ran"), (2, "the cat sat on a hat"), (3, "A dog sat on the mat; the cat ran"), (4, None), (5, ""),
        (6, "one"), (7, "the the the the"), (8, "one two"), (2, "the cat sat on a hat"), (None, "on the mat and on the hat"), (9, "é 漢字 the cat é 漢字 the " * 40)]


def expected(rows, order):
    docs = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)})) for _, t in rows]
    grams = lambda w: Counter(tuple(w[i - n + 1:i + 1]) for n in range(1, order + 1) for i in range(n - 1, len(w)))
    total = sum(map(grams, docs), Counter())
    out = []
    for (i, _), w in zip(rows, docs):
        own = grams(w)
        rest = max(sum(map(len, docs)) - len(w), 1)

        def s(g):
            """(score of the last word of g, whether it backed off)"""
            c = total[g] - own[g]
            if len(g) == 1:
                return (c or backoff_lm.BACKOFF) / rest, False
            if c > 0:
                return c / max(total[g[:-1]] - own[g[:-1]], 1), False
            return backoff_lm.BACKOFF * s(g[1:])[0], True

        each = [s(tuple(w[max(k - order + 1, 0):k + 1])) for k in range(len(w))]
        z = sum(math.log10(p) for p, _ in each)
        out.append((i, len(w), sum(b for _, b in each), round(z, 6) if w else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_backoff_scores(spark, monkeypatch, order):
    monkeypatch.setattr(backoff_lm, "PIECE_BYTES", 60)  # several pieces
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("piece", "block", "words", "h")})
    got = [(r.doc_id, r.n_words, r.n_backoff, None if r.log10_score is None else round(r.log10_score, 6)) for r in backoff_lm.score(docs, order=order).collect()]
    assert sorted(got, key=repr) == expected(ROWS, order)


def test_backoff_empty_table(spark):
    assert backoff_lm.report(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_registered_order():
    assert backoff_lm.ORDER >= 3


def test_language_vectors_in_blocks(monkeypatch):
    texts = ["".join(chr(0x4E00 + (i * 7919) % 20000) for i in range(3000)), "plain words, twice: plain words", "", "Ünïcode ß"]
    raw = [t.encode() for t in texts]
    off = np.cumsum([0, *map(len, raw)])
    whole = language_id.bundles(b"".join(raw), off)
    monkeypatch.setattr(language_id, "GRAM_BLOCK", 100)
    assert np.array_equal(whole, language_id.bundles(b"".join(raw), off))
    assert not whole[2].any() and whole[[0, 1, 3]].any(axis=1).all()


def test_language_rows(spark):
    rows = [(i, "the quick brown fox jumps over the lazy dog", "en") for i in range(20)] + [(i, "der schnelle braune fuchs springt über den faulen hund", "de") for i in range(20, 40)]
    rows += [(40, None, "en"), (41, "123 !", "en"), (42, "", None), (3, rows[3][1], "en"), (43, "fuchs und hund " * 20_000, None), (44, "the dog and the fox", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({c: F.lit("x") for c in ("lang_pred", "score", "held_out", "x", "dim")})
    got = language_id.report(docs).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r.lang_pred for r in got}
    assert [by[k] for k in (40, 41, 42, 43, 44)] == ["und", "und", "und", "de", "en"]
