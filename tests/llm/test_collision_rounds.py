"""The collision search against a plain restatement that starts every query at
the first window, and how many rounds it counts for that."""

from statistics import NormalDist

import numpy as np
import pytest

from wxgrid.llm import collision_ann as ann


def plain(ids, x, most, query_id, q, k):
    extra = np.sqrt(np.maximum(most * most - (x * x).sum(axis=1), 0))
    dirs = ann.directions(x.shape[1] + 1)
    p = (np.c_[x, extra] / most) @ dirs
    unit = q / np.linalg.norm(q)
    at, need = np.append(unit, 0.0) @ dirs, int(np.ceil(ann.SHARE * ann.PROJECTIONS))
    sure = ann.SHARE + ann.MARGIN * np.sqrt(ann.SHARE * (1 - ann.SHARE) / ann.PROJECTIONS)
    reach, width, others = NormalDist().inv_cdf((1 + sure) / 2), ann.FIRST_WINDOW, ids != query_id
    while True:
        rows = np.flatnonzero((((p >= at - width) & (p <= at + width)).sum(axis=1) >= need) & others)
        best = rows[np.lexsort((ids[rows], -(x[rows] @ unit)))][:k]
        if len(best) == min(k, others.sum()) and (len(rows) == others.sum() or np.sqrt(max(0, 2 - 2 * (x[best[-1]] @ unit) / most)) <= width / reach):
            return ids[best].tolist()
        width *= ann.GROWTH


@pytest.mark.parametrize("spread", [0.0, 3.0])
def test_rounds_of_the_last_query_are_not_counted_again(monkeypatch, spread):
    rng = np.random.default_rng(4)
    n, dim, k = 3000, 12, 10
    x = rng.standard_normal((n, dim)) + spread * rng.standard_normal((30, dim))[rng.integers(30, size=n)]
    x[-100:] *= 0.01  # short vectors: many rounds
    scale = float(np.abs(x).max())
    ids = rng.permutation(n).astype(np.int64)
    index = ann.Index(ids, x, scale, float(np.sqrt(((x / scale) ** 2).sum(axis=1)).max()))
    calls, count = [], ann.Index.colliding
    monkeypatch.setattr(ann.Index, "colliding", lambda self, *a: calls.append(1) or count(self, *a))
    monkeypatch.setattr(ann, "CHUNK", 700)
    asked = list(range(0, n, 60))
    got = {int(ids[j]): index.nearest(int(ids[j]), x[j], k)[0].tolist() for j in asked}
    assert got == {int(ids[j]): plain(ids, x / scale, index.most, int(ids[j]), x[j], k) for j in asked}
    assert len(calls) <= 4 * len(asked)


def test_more_rows_than_a_place_of_two_bytes():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((66_000, 3))
    ids = np.arange(len(x))
    most = float(np.sqrt((x * x).sum(axis=1)).max())
    found, score = ann.Index(ids, x, 1.0, most).nearest(65_990, x[65_990], 5)
    assert found.tolist() == plain(ids, x, most, 65_990, x[65_990], 5) and np.allclose(score, x[found] @ x[65_990])
