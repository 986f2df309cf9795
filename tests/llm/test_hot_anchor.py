"""One passage in many documents with contexts of their own: no shard of the
suffix sort outgrows its bound, and the strings' smallest documents stay right."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import test_operators
from wxgrid.llm import induced, suffix_dedup


def segments(n=400):
    rng = random.Random(5)
    word = lambda k: bytes(rng.choice(b"abcdefgh") for _ in range(k))
    passage = word(30)
    rows = [(7, i, i + (i % 3), word(rng.randint(1, 20)) + passage + word(26)) for i in range(n)]
    rows += [(7, n + i, n + i, rows[i][3][:-5] + word(5)) for i in range(n)]  # strings that an earlier row holds too
    rows += [(a, 2 * n + a, 2 * n + a, word(60)) for a in range(8, 12)]
    return rows


def runs(out):
    return {(r["anchor"], r["sh"], f, x["top"]) for b in out for r in b.to_pylist() for x in r["runs"] for f in range(x["f"], x["t"] - suffix_dedup.LENGTH + 1)}


def test_shards_of_one_anchor(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 3000)
    sizes, minima = [], suffix_dedup.shard_minima
    monkeypatch.setattr(suffix_dedup, "shard_minima", lambda seg, top: sizes.append(sum(map(len, seg.to_pylist()))) or minima(seg, top))
    rows, length = segments(), suffix_dedup.LENGTH
    first = {}
    for _, top, _, seg in rows:
        for k in range(len(seg) - length + 1):
            first[seg[k:k + length]] = min(top, first.get(seg[k:k + length], top))
    expect = {(a, i, k, first[seg[k:k + length]]) for i, (a, _, most, seg) in enumerate(rows) for k in range(len(seg) - length + 1)
              if first[seg[k:k + length]] < most}
    batch = pa.table({"anchor": pa.array([r[0] for r in rows], pa.int64()), "sh": pa.array(range(len(rows)), pa.int64()),
                      "top": pa.array([r[1] for r in rows], pa.int64()), "most": pa.array([r[2] for r in rows], pa.int64()),
                      "seg": pa.array([r[3] for r in rows], pa.binary())})
    got = runs(suffix_dedup._shards(iter(batch.to_batches(max_chunksize=50))))
    assert got == expect and expect
    assert max(sizes, default=0) <= 2 * 3000


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(test_operators.corpus(), "doc_id long, text string")


def test_hot_anchors_by_string(docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_DOCUMENTS", 2)
    hot, written = [], suffix_dedup.written

    def seen(df, name):
        out = written(df, name)
        if name == "suffix-hot":
            hot.append(out.count())
        return out

    monkeypatch.setattr(suffix_dedup, "written", seen)
    test_operators.test_suffix_dedup(docs)
    assert hot[0] > 0


def test_permuted_common_prefixes():
    rng = random.Random(4)
    for _ in range(200):
        text = [rng.randint(1, rng.choice([1, 2, 5])) for _ in range(rng.randint(1, 80))] * rng.choice([1, 2]) + [0]
        s = np.array(text, np.int32)
        order = induced.suffix_array(s, 6)
        order = order[np.array([rng.random() < 0.7 for _ in text])]
        got = induced.permuted_common_prefixes(s, order)
        for k, p in enumerate(order):
            q = order[k - 1]
            same = next((i for i in range(len(text)) if p + i >= len(text) or q + i >= len(text) or text[p + i] != text[q + i]), len(text))
            assert got[p] == (same if k else -1)


def test_doubling():
    rng = random.Random(5)
    for _ in range(100):
        x = [rng.randint(0, rng.choice([1, 3, 50])) for _ in range(rng.randint(1, 90))] * rng.choice([1, 3])
        names = np.unique(x, return_inverse=True)[1]
        assert induced._by_doubling(names).tolist() == sorted(range(len(x)), key=lambda i: x[i:])
