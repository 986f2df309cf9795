"""Orders are counted in turn: the shuffled n-grams of one pass are gone before
the next, and the counts that stay are those of one joint count."""

import glob

import pytest

from wxgrid.llm import backoff_lm

ROWS = [(i, f"w{i % 7} the cat {i % 3} sat on w{i % 5} the mat") for i in range(40)] + [(None, None), (50, "")]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_orders_are_counted_in_turn(spark, monkeypatch, order):
    seen, keep = [], backoff_lm.written

    def written(df, name):
        out = keep(df, name)
        seen.append(sorted({r.n for r in out.select("n").distinct().collect()}))
        assert glob.glob(f"{out.inputFiles()[0].removeprefix('file://').rsplit('/', 1)[0]}/*.parquet")
        return out

    monkeypatch.setattr(backoff_lm, "written", written)
    monkeypatch.setattr(backoff_lm, "PIECE_BYTES", 100)  # several pieces
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    in_turn = sorted(map(tuple, backoff_lm.score(docs, order=order).collect()), key=repr)
    assert seen == [[1, 2], [3], [4]][:max(order - 1, 1)] if order > 1 else [[1]]
    monkeypatch.setattr(backoff_lm, "passes", lambda order: [list(range(1, order + 1))])
    together = sorted(map(tuple, backoff_lm.score(docs, order=order).collect()), key=repr)
    assert in_turn == together and len(in_turn) == len(ROWS)
