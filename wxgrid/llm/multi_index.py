"""Hard negatives by an inverted multi-index.

Vectors are scaled to integers and cut in two halves; each half has a codebook
of ``CENTRES`` centres, fitted on a bounded sample, and a pair of centres is a
cell.  Every vector is filed under its cell, and a cell's radius in a half is
the largest distance of its vectors from the half's centre, so

    q.x <= q1.c1 + |q1| r1 + q2.c2 + |q2| r2

holds for all its vectors, and the mirrored sum bounds them from below.

For an anchor the multi-sequence heap walks pairs of centres in descending
order of the summed half bounds (with each centre's largest radius; a cell
whose own radii give a lower bound is skipped if that excludes it).  Rounds are
Spark jobs: a round lists the cells that every open anchor visits next, deals
the visits to the shards that hold those cells, scores them there exactly and
merges the best.  While a window lacks rows, an anchor visits cells of about
``FIRST_ROWS`` rows, ``WIDER`` times as many a round; once it has them, it
visits every cell whose bound reaches the worst row of a window, and is then
certified: no cell it left out can hold a better row.  So results are exact
whatever the codebooks; they only decide how much is visited.

1. positives: the first ``n_positive`` other rows of the anchor's label;
2. negatives: per positive score p the first ``n_negative`` rows of other
   labels whose score s has low * p <= 100 * s <= high * p.

A shard holds whole cells of about ``SHARD_ROWS`` rows in all; a larger cell (a
vector that very many rows repeat) is dealt over several by row.  Visits
stream past their shard in batches.  What is sent to all tasks is the codebooks
and one entry per cell, at most ``CENTRES ** 2``.

Defined cases: rows with a null id, label or vector, or a null or non-finite
component, take no part; shorter vectors are continued with zeros; components
are held within +-2**62 and scores within +-9 * 10**18; rows repeating id, label and
vector count once; rows of one id with different labels or vectors are rows of
their own, but never each other's positives or negatives; an anchor without a
row of its label, or without a row in a window, has no result there; other
columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, partitions, written

CENTRES = 32
SAMPLE_ROWS = 8192
SHARD_ROWS = 8192
FIRST_ROWS = 512
WIDER = 16
LIMIT = 2 ** 62
SCORE_LIMIT = 9 * 10 ** 18
SCALE = 256
SEED = 11


# codebooks

def fit(x: np.ndarray, k: int = CENTRES, turns: int = 12) -> np.ndarray:
    """Centres of the rows of ``x`` by k-means."""
    rng = np.random.default_rng(SEED)
    x = np.unique(x, axis=0)
    if len(x) <= k:
        return x if len(x) else np.zeros((1, x.shape[1]))
    c = x[np.sort(rng.choice(len(x), k, replace=False))]
    for _ in range(turns):
        near = _nearest(x, c)
        for j in range(k):
            mine = x[near == j]
            if len(mine):
                c[j] = mine.mean(axis=0)
    return c


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmin((c * c).sum(axis=1) - 2 * (x @ c.T), axis=1)


def halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = (x.shape[1] + 1) // 2
    return x[:, :cut], x[:, cut:]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Arrays of integers as rows of ``dim`` numbers, continued with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), dim), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


FILED = "id long, label string, x array<long>, v binary, cell int, r1 double, r2 double"


def _file(books: tuple[np.ndarray, np.ndarray], dim: int):
    """Cell, distances from its centres and packed vector of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), dim)
            near, far = [], []
            for h, c in zip(halves(x.astype(np.float64)), books):
                j = _nearest(h, c)
                near.append(j)
                far.append(np.sqrt(((h - c[j]) ** 2).sum(axis=1)))
            cell = near[0] * len(books[1]) + near[1]
            packed = pa.array([row.tobytes() for row in x], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), packed, pa.array(cell.astype(np.int32)), pa.array(far[0]), pa.array(far[1])],
                                             names=["id", "label", "v", "cell", "r1", "r2"])

    return run


# walking cells

class Directory:
    """Codebooks and one entry per cell that holds rows: row count, radii and
    shards.  Bounded by ``CENTRES ** 2`` entries."""

    def __init__(self, books: tuple[np.ndarray, np.ndarray], cells: list):
        self.books, self.width = books, len(books[1])
        n = len(books[0]) * self.width
        self.rows = np.zeros(n, np.int64)
        self.radius = np.zeros((2, n))
        for c, rows, r1, r2 in cells:
            self.rows[c], self.radius[0, c], self.radius[1, c] = rows, r1, r2
        # each centre's largest radius, for the order of the walk
        grid = self.radius.reshape(2, -1, self.width)
        self.outer = grid[0].max(axis=1), grid[1].max(axis=0)
        self.shard, self.spread, at, held = np.zeros(n, np.int64), np.ones(n, np.int64), 0, 0
        for c in np.flatnonzero(self.rows):
            if self.rows[c] > SHARD_ROWS or held + self.rows[c] > SHARD_ROWS:
                at, held = at + (held > 0), 0
            self.shard[c] = at
            if self.rows[c] > SHARD_ROWS:
                self.spread[c] = -(-int(self.rows[c]) // SHARD_ROWS)
                at += int(self.spread[c])
            else:
                held += int(self.rows[c])

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
        """(upper, lower) bounds of all cells and the half bounds of the
        centres, with room for rounding."""
        mid, size, slack = [], [], []
        for h, c, outer in zip(halves(q[None].astype(np.float64)), self.books, self.outer):
            norm = float(np.sqrt((h[0] * h[0]).sum()))
            dot = c @ h[0]
            mid.append(dot)
            size.append(norm)
            slack.append(1 + 1e-9 * norm * (np.sqrt((c * c).sum(axis=1)) + outer))
        centre = (mid[0][:, None] + mid[1][None]).ravel()
        reach = size[0] * self.radius[0] + size[1] * self.radius[1] + (slack[0][:, None] + slack[1][None]).ravel()
        half = tuple(m + n * o + s for m, n, o, s in zip(mid, size, self.outer, slack))
        return centre + reach, centre - reach, half

    def walk(self, half: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[float, int]]:
        """(bound, cell) in descending order of summed half bounds: the
        multi-sequence heap over the two sorted lists of centres."""
        order = np.argsort(-half[0], kind="stable"), np.argsort(-half[1], kind="stable")
        best = half[0][order[0]], half[1][order[1]]
        heap, seen = [(-(best[0][0] + best[1][0]), 0, 0)], {(0, 0)}
        while heap:
            bound, a, b = heapq.heappop(heap)
            yield -bound, int(order[0][a]) * self.width + int(order[1][b])
            for i, j in ((a + 1, b), (a, b + 1)):
                if i < len(best[0]) and j < len(best[1]) and (i, j) not in seen:
                    seen.add((i, j))
                    heapq.heappush(heap, (-(best[0][i] + best[1][j]), i, j))

    def visits(self, q: np.ndarray, start: int, rows: int, least: float, enough: bool, most: float) -> tuple[list[int], int, bool]:
        """(cells to visit, walk position after them, certified) from position
        ``start`` on.  ``least``: score below which nothing is wanted; ``most``:
        above which; ``enough``: ``least`` is certain to be the last wanted, so
        all that reach it are visited, else cells of about ``rows`` rows."""
        upper, lower, half = self.bounds(q)
        cells, held, at = [], 0, 0
        for at, (bound, c) in enumerate(self.walk(half)):
            if bound < least:
                return cells, at, True
            if at < start:
                continue
            if not enough and held >= rows:
                return cells, at, False
            if self.rows[c] and upper[c] >= least and lower[c] <= most:
                cells.append(c)
                held += int(self.rows[c])
        return cells, at + 1, True


# scoring

def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of two integer matrices, within the limit."""
    room = 2.0 ** 52 / max(1, x.shape[1])
    big_q, big_x = np.abs(q).max(axis=1, initial=0).astype(np.float64), np.abs(x).max(axis=1, initial=0).astype(np.float64)
    out = (q.astype(np.float64) @ x.T.astype(np.float64))
    wide = big_q[:, None] * big_x[None] >= room
    out = np.where(wide, 0, out).astype(np.int64)
    for i, j in np.argwhere(wide):
        exact = sum(int(a) * int(b) for a, b in zip(q[i], x[j]))
        out[i, j] = max(-SCORE_LIMIT, min(SCORE_LIMIT, exact))
    return out


PACKED = "shard long, ids binary, labels array<string>, cells binary, matrix binary"


def _pack(dim: int):
    """One row per shard; repeated rows count once."""
    def run(t: pa.Table) -> pa.Table:
        rows = sorted(set(zip(t["cell"].to_pylist(), t["id"].to_pylist(), t["label"].to_pylist(), t["v"].to_pylist())))
        ids, cells = np.array([r[1] for r in rows], np.int64), np.array([r[0] for r in rows], np.int32)
        return pa.table({"shard": t["shard"].slice(0, 1), "ids": pa.array([ids.tobytes()], pa.binary()), "labels": pa.array([[r[2] for r in rows]], pa.list_(pa.string())),
                         "cells": pa.array([cells.tobytes()], pa.binary()), "matrix": pa.array([b"".join(r[3] for r in rows)], pa.binary())})

    return run


HITS = "k long, hits array<struct<w:int,score:long,id:long>>"
_HITS = pa.list_(pa.struct([("w", pa.int32()), ("score", pa.int64()), ("id", pa.int64())]))
SIDE = "shard long, kind int, ids binary, labels array<string>, cells binary, matrix binary, k long, id long, label string, v binary, visit array<int>, lo array<long>, hi array<long>"


def _top(score: np.ndarray, ids: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The first ``k`` of positions ``at`` by descending score, then id."""
    if len(at) > k:
        cut = np.partition(score[at], len(at) - k)[len(at) - k]
        at = at[score[at] >= cut]
    return at[np.lexsort((ids[at], -score[at]))[:k]]


def _score(dim: int, same_label: bool, k: int):
    """Rows of a shard, its packed row first, then the visits to it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            keys, hits = [], []
            col = {n: batch.column(n) for n in batch.schema.names}
            shards, kinds = col["shard"].to_numpy(), col["kind"].to_numpy()
            edge = np.flatnonzero(np.r_[True, (shards[1:] != shards[:-1]) | (kinds[1:] != kinds[:-1]), True])
            for a, b in zip(edge[:-1], edge[1:]):
                if kinds[a] == 0:
                    shard = shards[a]
                    ids = np.frombuffer(col["ids"][a].as_py(), np.int64)
                    names, of = np.unique(np.array(col["labels"][a].as_py(), str), return_inverse=True)
                    code = dict(zip(names.tolist(), range(len(names))))
                    cells = np.frombuffer(col["cells"][a].as_py(), np.int32)
                    x = np.frombuffer(col["matrix"][a].as_py(), np.int64).reshape(len(ids), dim)
                    continue
                if shard != shards[a]:
                    raise RuntimeError("visits to a shard that holds no rows")
                for p in range(a, b, 256):
                    n = min(256, b - p)
                    q = np.frombuffer(b"".join(col["v"].slice(p, n).to_pylist()), np.int64).reshape(n, dim)
                    s = products(q, x)
                    rows = [col[c].slice(p, n).to_pylist() for c in ("k", "id", "label", "visit", "lo", "hi")]
                    for i, (key, own, label, visit, lo, hi) in enumerate(zip(*rows)):
                        ok = np.isin(cells, visit) & (ids != own) & ((of == code.get(label, -1)) == same_label)
                        found = []
                        at = np.flatnonzero(ok)
                        for w, (f, t) in enumerate(zip(lo, hi)):
                            mine = at[(s[i][at] >= f) & (s[i][at] <= t)]
                            found += [{"w": w, "score": int(s[i][j]), "id": int(ids[j])} for j in _top(s[i], ids, mine, k)]
                        if found:
                            keys.append(key)
                            hits.append(found)
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(hits, _HITS)], names=["k", "hits"])

    return run


STATE = "k long, id long, label string, v binary, lo array<long>, hi array<long>, at int, hits array<struct<w:int,score:long,id:long>>"
PLAN = STATE + ", visit array<int>, certified boolean"


def _plan(directory: Directory, rows: int, k: int):
    """Every open anchor's next cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            visit, position, certified = [], [], []
            cols = [batch.column(c).to_pylist() for c in ("v", "lo", "hi", "at", "hits")]
            for v, lo, hi, at, hits in zip(*cols):
                worst, enough = [], True
                for w, (f, t) in enumerate(zip(lo, hi)):
                    if f > t:
                        continue
                    found = [h["score"] for h in hits if h["w"] == w]
                    full = len(found) >= k
                    enough &= full
                    worst.append(min(found) if full else f)
                least = min(worst, default=float("inf"))
                most = max(hi, default=float("-inf"))
                # scores held at the limit may stand for any beyond it
                least, most = (-np.inf if least <= -SCORE_LIMIT else least), (np.inf if most >= SCORE_LIMIT else most)
                cells, to, done = directory.visits(np.frombuffer(v, np.int64), at, rows, least, enough, most)
                visit.append(cells)
                position.append(to)
                certified.append(done)
            data = {n: batch.column(n) for n in batch.schema.names} | {
                "at": pa.array(position, pa.int32()), "visit": pa.array(visit, pa.list_(pa.int32())), "certified": pa.array(certified, pa.bool_())}
            yield pa.RecordBatch.from_arrays(list(data.values()), names=list(data))

    return run


def _search(state: DataFrame, packed: DataFrame, directory: Directory, dim: int, same_label: bool, k: int) -> DataFrame:
    """(k, id, label, v, lo, hi, hits): the best ``k`` rows of every window of
    every anchor, in rounds until all are certified."""
    spark = state.sparkSession
    cells = [(int(c), int(directory.shard[c]), int(directory.spread[c])) for c in np.flatnonzero(directory.rows)]
    where = F.broadcast(spark.createDataFrame(cells or [(0, 0, 1)], "cell int, base long, spread long"))  # at most CENTRES ** 2 rows
    keep = ["k", "id", "label", "v", "lo", "hi", "at", "hits"]
    names, empty = [], {}
    for field in SIDE.split(", "):
        name, kind = field.split(" ")
        names.append(name)
        empty[name] = F.lit(None).cast(kind).alias(name)
    side = packed.withColumn("kind", F.lit(0)).select(*(n if n in (*packed.columns, "kind") else empty[n] for n in names))
    done, rows = None, FIRST_ROWS
    open_ = state.select(*keep)
    while True:
        # the few anchors of one file are dealt to all tasks: walking cells is the work
        plan = written(open_.repartition(partitions(spark)).mapInArrow(_plan(directory, rows, k), PLAN), "multi-index-plan")
        visits = plan.select("k", "id", "label", "v", "lo", "hi", F.explode("visit").alias("cell")).join(where, "cell") \
            .select("*", F.explode(F.sequence(F.col("base"), F.col("base") + F.col("spread") - 1)).alias("shard")) \
            .groupBy("k", "shard").agg(F.collect_list("cell").alias("visit"), *(F.first(c).alias(c) for c in ("id", "label", "v", "lo", "hi")))
        asks = visits.withColumn("kind", F.lit(1)).select(*(n if n in (*visits.columns, "kind") else empty[n] for n in names))
        hits = side.unionByName(asks).repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(_score(dim, same_label, k), HITS)
        new = hits.groupBy("k").agg(F.flatten(F.collect_list("hits")).alias("new"))
        both = plan.join(new, "k", "left")
        every = F.when(F.col("new").isNull(), F.col("hits")).otherwise(F.concat("hits", "new"))
        order = F.sort_array(F.transform(every, lambda h: F.struct(h["w"].alias("w"), (-h["score"]).alias("s"), h["id"].alias("id"))))
        windows = F.transform(F.sequence(F.lit(0), F.size("lo") - 1), lambda w: F.slice(F.filter(F.col("o"), lambda h: h["w"] == w), 1, k))
        best = F.transform(F.flatten(windows), lambda h: F.struct(h["w"].alias("w"), (-h["s"]).alias("score"), h["id"].alias("id")))
        merged = both.withColumn("o", order).withColumn("hits", F.when(F.size("lo") > 0, best).otherwise(F.col("hits"))).select(*keep, "certified")
        merged = written(merged, "multi-index-round")
        ready = merged.where("certified").drop("certified")
        done = ready if done is None else done.unionByName(ready)
        open_ = merged.where("NOT certified").drop("certified")
        if open_.isEmpty():
            return done
        rows *= WIDER


def prepared(rows: DataFrame, vec_id: str, vector: str, label: Column, scale: int) -> DataFrame:
    """(id, label, x): rows that take part, as integers."""
    v = F.col(vector).cast("array<double>")
    some = rows.select(F.col(vec_id).cast("long").alias("id"), label.cast("string").alias("label"), v.alias("d")) \
        .where("id is not null and label is not null and d is not null")
    some = some.where(F.forall("d", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    held = F.transform("d", lambda x: F.floor(F.greatest(F.least(x * float(scale), F.lit(float(LIMIT))), F.lit(-float(LIMIT)))).cast("long"))
    return some.select("id", "label", held.alias("x"))


def mine(rows: DataFrame, is_anchor: Column, *, n_positive: int = 5, n_negative: int = 3, low: int = 50, high: int = 95,
         vec_id: str = "vec_id", vector: str = "embedding", label: Column | None = None, scale: int = SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score); ``is_anchor`` is a condition on ``id``."""
    spark = rows.sparkSession
    bounded_batches(spark)
    data = prepared(rows, vec_id, vector, F.col("label") if label is None else label, scale)
    n, dim = data.agg(F.count("*"), F.max(F.size("x"))).first()
    dim = max(2, dim or 0)
    # a sample by hash, of SAMPLE_ROWS rows on average and never twice as many
    parts = 1 << 40
    share = min(parts, parts * SAMPLE_ROWS // max(1, n))
    taken = data.where(F.pmod(F.xxhash64("id", "label", "x"), F.lit(parts)) < share).limit(2 * SAMPLE_ROWS).select("x").toArrow()
    x = _matrix(taken["x"].combine_chunks(), dim).astype(np.float64) if taken.num_rows else np.zeros((0, dim))
    books = tuple(fit(h) for h in halves(x))
    filed = written(data.mapInArrow(_file(books, dim), FILED.replace("x array<long>, ", "")), "multi-index-rows")
    cells = filed.groupBy("cell").agg(F.count("*"), F.max("r1"), F.max("r2")).collect()  # at most CENTRES ** 2 rows
    directory = Directory(books, sorted(map(tuple, cells)))
    homes = F.broadcast(spark.createDataFrame([(int(c), int(directory.shard[c]), int(directory.spread[c])) for c in np.flatnonzero(directory.rows)] or [(0, 0, 1)],
                                              "cell int, base long, spread long"))
    shard = F.col("base") + F.pmod(F.xxhash64("id"), F.col("spread"))
    # a cell that is spread is visited in all its shards
    packed = filed.join(homes, "cell").select(shard.alias("shard"), "id", "label", "cell", "v").groupBy("shard").applyInArrow(_pack(dim), PACKED)
    packed = written(packed, "multi-index-shards")
    none = F.array().cast("array<struct<w:int,score:long,id:long>>")
    anchors = filed.where(is_anchor).select("id", "label", "v").distinct().withColumn("k", F.monotonically_increasing_id())
    anchors = written(anchors.withColumns({"lo": F.array(F.lit(-SCORE_LIMIT)), "hi": F.array(F.lit(SCORE_LIMIT)),
                                           "at": F.lit(0), "hits": none}), "multi-index-anchors")
    positive = _search(anchors, packed, directory, dim, True, n_positive)
    # windows in exact integers: low * p <= 100 * s <= high * p
    windows = positive.select(
        "k", "id", "label", "v", F.transform("hits", lambda h: _ceil_div(h["score"], low)).alias("lo"),
        F.transform("hits", lambda h: _floor_div(h["score"], high)).alias("hi"), F.lit(0).alias("at"), none.alias("hits"), F.col("hits").alias("pos"))
    windows = written(windows, "multi-index-windows")
    negative = _search(windows.where(F.size("lo") > 0), packed, directory, dim, False, n_negative)
    pairs = negative.select("k", F.explode("hits").alias("h")).join(windows.select("k", "id", "pos"), "k")
    p = F.element_at("pos", F.col("h.w") + 1)
    order = Window.partitionBy("k", "h.w").orderBy(F.desc("h.score"), "h.id")
    return pairs.select(F.col("id").alias("anchor_id"), p["id"].alias("positive_id"), F.row_number().over(order).alias("rank"),
                        F.col("h.id").alias("negative_id"), p["score"].alias("positive_score"), F.col("h.score").alias("negative_score"))


def _floor_div(score: Column, part: int) -> Column:
    """floor(part * score / 100) without overflow."""
    rest = F.pmod(score, F.lit(100).cast("long"))
    return F.call_function("div", score - rest, F.lit(100).cast("long")) * part + F.call_function("div", rest * part, F.lit(100).cast("long"))


def _ceil_div(score: Column, part: int) -> Column:
    return -_floor_div(-score, part)


def report(rows: DataFrame) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows, F.col("id") % 50 == 0, label=label)
