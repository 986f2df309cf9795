"""Approximate nearest neighbours by collision counting.

Largest inner product becomes smallest distance: with M the largest norm, data
vectors get one more component sqrt(M^2 - |x|^2) and queries 0, both scaled to
unit length.  Each of ``PROJECTIONS`` random directions is one sorted array of
projections.  A query opens a window around its own projection in every array
and widens all of them by ``GROWTH`` a round (virtual rehashing); a vector that
falls into the windows of at least ``SHARE`` of the arrays is verified with its
exact inner product.  A query stops when its k-th verified distance is within
the radius at which a vector would have reached that count with the confidence
of ``MARGIN`` standard deviations, or when all vectors are verified.  Nothing
caps windows or candidates.

A window is a range of places in its sorted array, so collisions are counted
on the places of the rows, array after array.  The round at which a query
stops is looked for from the one at which the query before it did.

Data rows are dealt into blocks of about ``BLOCK_ROWS``, queries into blocks of
``QUERY_ROWS``; every query block meets every data block, each pair in a task
of its own that holds one block's index, and the k nearest of the blocks merge
per query.

Defined cases: vectors that are null, zero, of another length than most, or
hold null or non-finite components take no part, nor do rows without an id;
rows that repeat id and vector count once; a query never finds its own id;
rows of one id with different vectors are all searched for and found under it,
and their neighbours ranked together; scores beyond the double range are
infinite; equal scores go to the smaller id; other columns are not read.
"""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PROJECTIONS = 80
SHARE = 0.6
MARGIN = 1.0
GROWTH = 1.1
FIRST_WINDOW = 0.8
BLOCK_ROWS = 65_536
QUERY_ROWS = 512
CHUNK = 16_384
SEED = 7


def directions(dim: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dim, PROJECTIONS))


class Index:
    """Sorted projections of one data block.  ``scale``: the largest component
    of all vectors; the search works on vectors divided by it, so that no
    square of a finite vector overflows.  ``most``: their largest norm."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, scale: float, most: float):
        self.ids, self.raw, self.x, self.most = ids, vectors, vectors / scale, most
        self.rough = self.x.astype(np.float32)
        extra = np.sqrt(np.maximum(most * most - (self.x * self.x).sum(axis=1), 0))
        unit = np.c_[self.x, extra] / most
        self.dirs = directions(unit.shape[1])
        p = (unit @ self.dirs).T
        order = np.argsort(p, axis=1)
        self.sorted = np.take_along_axis(p, order, axis=1)
        # place of every row in each sorted array
        self.place = np.empty(p.shape, np.uint16 if len(ids) <= 1 << 16 else np.uint32)
        np.put_along_axis(self.place, order, np.arange(len(ids), dtype=self.place.dtype)[None, :], axis=1)
        self.turn = 0  # the round in which the last query stopped

    def colliding(self, at: np.ndarray, width: float, need: int) -> np.ndarray:
        """Rows in the windows at -+ width of at least ``need`` arrays."""
        kind = self.place.dtype.type
        windows = []
        for j, (s, a) in enumerate(zip(self.sorted, at)):
            lo, hi = s.searchsorted(a - width, "left"), s.searchsorted(a + width, "right")
            if hi > lo:
                windows.append((j, kind(lo), kind(hi - 1 - lo)))
        found = []
        for a in range(0, len(self.ids), CHUNK):
            place = self.place[:, a:a + CHUNK]
            counts, after, hit = (np.zeros(place.shape[1], t) for t in (np.uint8, kind, bool))
            for j, lo, size in windows:
                np.subtract(place[j], lo, out=after)  # places before the window wrap round
                np.less_equal(after, size, out=hit)
                np.add(counts, hit.view(np.uint8), out=counts)
            found.append(a + np.flatnonzero(counts >= need))
        return np.concatenate(found)

    def kth_score(self, rows: np.ndarray, unit: np.ndarray, rough: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, float]:
        """(rows that may be among the k best, their scores, the k-th score)."""
        least = np.partition(rough, len(rows) - k)[len(rows) - k]
        best = rows[rough >= least - 1e-6 * len(unit) * self.most]
        score = self.x[best] @ unit
        return best, score, float(np.partition(score, len(best) - k)[len(best) - k])

    def nearest(self, query_id: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.ids)
        unit = q / np.abs(q).max()
        unit /= np.linalg.norm(unit)
        own = self.ids == query_id
        wanted = min(k, n - int(own.sum()))
        if wanted == 0:
            return np.zeros(0, np.int64), np.zeros(0)
        at = np.append(unit, 0.0) @ self.dirs
        need = int(np.ceil(SHARE * PROJECTIONS))
        sure = SHARE + MARGIN * np.sqrt(SHARE * (1 - SHARE) / PROJECTIONS)
        reach = NormalDist().inv_cdf((1 + sure) / 2)
        q32 = unit.astype(np.float32)
        rough, known = np.zeros(n, np.float32), own.copy()

        def verified(turn: int):
            """(rows that may be among the nearest, their scores, distance of
            the k-th, all rows verified) of a round."""
            rows = self.colliding(at, FIRST_WINDOW * GROWTH ** turn, need)
            todo = rows[~known[rows]]
            rough[todo] = self.rough[todo] @ q32
            known[todo] = True
            rows = rows[~own[rows]]
            if len(rows) < wanted:
                return rows, np.zeros(0), -np.inf, np.inf, False
            best, score, kth = self.kth_score(rows, unit, rough[rows], wanted)
            return best, score, kth, np.sqrt(max(0.0, 2 - 2 * kth / self.most)), len(rows) == n - int(own.sum())

        def enough(turn: int, distance: float, all_in: bool) -> bool:
            return all_in or distance <= FIRST_WINDOW * GROWTH ** turn / reach

        # windows only grow and distances shrink, so after a round that may
        # stop all may: the first is looked for from where the last query stopped
        turn = self.turn
        best, score, kth, distance, all_in = verified(turn)
        up = not enough(turn, distance, all_in)
        while up and not enough(turn, distance, all_in):
            turn += 1
            best, score, kth, distance, all_in = verified(turn)
        while not up and turn > 0 and enough(turn - 1, distance, all_in):
            *before, all_before = verified(turn - 1)
            if not enough(turn - 1, before[3], all_before):
                break
            turn, (best, score, kth, distance), all_in = turn - 1, before, all_before
        self.turn = turn
        # equal vectors must get equal scores: the last sums row by row
        keep = score >= kth - 1e-9 * self.most
        best, score = best[keep], score[keep]
        with np.errstate(over="ignore", invalid="ignore"):
            exact = np.einsum("ij,j->i", self.raw[best], q)
        lost = np.isnan(exact)  # sums that overflow both ways: by their sign
        exact[lost] = np.where(score[lost] > 0, np.inf, -np.inf)
        top = np.lexsort((self.ids[best], -exact))[:wanted]
        return self.ids[best[top]], exact[top]


RESULT = "query_id long, vec_id long, score double"


def _search(scale: float, most: float, k: int):
    def run(group: pa.Table) -> pa.Table:
        ids = group["vec_id"].to_numpy()
        x = group["v"].combine_chunks()
        x = (x if isinstance(x, pa.Array) else x.chunk(0)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(ids), -1)
        query = group["is_query"].to_numpy()
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if query.any() and not query.all():
            index = Index(ids[~query], x[~query], scale, most)
            for q, v in zip(ids[query], x[query]):
                found, score = index.nearest(int(q), v, k)
                out.append((np.full(len(found), q), found, score))
        cols = [np.concatenate(c) if out else np.zeros(0) for c in (zip(*out) if out else ((), (), ()))]
        return pa.table({"query_id": pa.array(cols[0].astype(np.int64)), "vec_id": pa.array(cols[1].astype(np.int64)), "score": pa.array(cols[2].astype(float))})

    return run


def usable(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, v) of the vectors that take part."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = rows.where(F.col(vec_id).isNotNull() & F.col(vector).isNotNull()).select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))
    some = some.where(finite & F.exists("v", lambda x: x != 0))
    size = some.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return some.where(F.size("v") == (size["n"] if size else 0)).dropDuplicates(["vec_id", "v"])


def nearest(rows: DataFrame, is_query, k: int = 20, *, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for every usable
    row that ``is_query`` (a condition on ``vec_id``) selects."""
    data = usable(rows, vec_id, vector)
    largest = F.array_max(F.transform("v", lambda x: F.abs(x)))
    n, n_query, scale = data.agg(F.count("*"), F.count(F.when(is_query, 1)), F.max(largest)).first()
    scale = float(scale or 1.0)
    most = data.agg(F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + (x / scale) * (x / scale))))).first()[0]
    blocks, query_blocks = max(1, -(-n // BLOCK_ROWS)), max(1, -(-n_query // QUERY_ROWS))
    deal = F.xxhash64("vec_id")
    base = data.withColumn("b", F.pmod(deal, F.lit(blocks)).cast("int"))
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    # block numbers only: a row goes once to each block it has to meet
    side = base.select("vec_id", "v", F.lit(False).alias("is_query"), "b", every(query_blocks).alias("q"))
    queries = data.where(is_query).select("vec_id", "v", F.lit(True).alias("is_query"), every(blocks).alias("b"),
                                          F.pmod(deal, F.lit(query_blocks)).cast("int").alias("q"))
    found = side.unionByName(queries).groupBy("b", "q").applyInArrow(_search(scale, float(most or 1.0), k), RESULT)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def report(rows: DataFrame) -> DataFrame:
    return nearest(rows, F.col("vec_id") % 20 == 0)
