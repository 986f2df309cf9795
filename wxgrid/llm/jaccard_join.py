"""N-gram Jaccard join as a blocked sparse matrix product.

The matrix has a row per document and a column per distinct word shingle.

1. Column blocks.  Documents are hashed to shingles where they are read and
   the entries are dealt by column block.  A block finds its columns with more
   than one entry; only those can overlap.  A column that repeats within a
   piece already is sent once as a mark, so a passage that a third of all
   documents share does not gather in one block.
2. Size-derived bound on rows.  A link needs an overlap of at least
   threshold * size with the own set, so a document with fewer shared entries
   than that has no link and goes.  Equal sets collapse to a class.
3. Columns of the classes are counted again, rarest first; a link needs a
   common entry among the first size - ceil(threshold * size) + 1, so only
   those entries pair rows.
4. Two rounds pair every row with one row of its columns, which joins most
   members of a group of copies at the cost of one pair a row.
5. Row blocks.  Rows with a live column (one that still holds rows of two
   components) are blocked by their smallest live column, and every pair of row
   blocks that shares a live column is multiplied in one task: overlaps
   accumulate over blocks of columns, the bound on the overlap drops pairs, and
   of the links that join different components a spanning forest comes out.

The components are those of all links: a pair is left out only when its rows
are connected already.  No column, pair or group is capped.

Defined cases: null and empty texts have an empty set and are their own
component; rows with a null doc_id get their set size and a null component;
repeated rows (same id and text) are one document; rows with one id and
different texts are separate rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrowtext as A
from .common import bounded_batches, partitions, written
from .components import components

SHINGLE = 5
PERCENT = 80
PIECE_BYTES = 2_000_000
STAR_ROUNDS = 2
ROW_BLOCK = 512
COLUMN_BLOCK = 2048

WORD_BYTE = np.ones(256, bool)
WORD_BYTE[[0x20, 9, 10, 11, 12, 13]] = False
_K = np.uint64(0x9E3779B97F4A7C15)


def shingles(buf: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the distinct shingles, sorted."""
    low = A.LOWER[buf]
    starts, ends = A.word_spans(WORD_BYTE[low], offsets)
    words, counts = A.segment_hashes(low, starts, ends), A.counts_per_doc(starts, offsets)
    n, last = len(words), np.cumsum(counts)
    doc = np.repeat(np.arange(len(counts)), counts)
    full = np.arange(n) + size <= np.repeat(last, counts)
    at = np.flatnonzero(full)
    h = np.full(len(at), size, np.uint64)
    for k in range(size):
        h = h * _K + words[at + k]
    short = np.flatnonzero((counts > 0) & (counts < size))
    extra = np.zeros(len(short), np.uint64)
    for i, d in enumerate(short.tolist()):
        x = int(counts[d])
        for w in words[last[d] - counts[d]:last[d]].tolist():
            x = (x * int(_K) + w) & 0xFFFFFFFFFFFFFFFF
        extra[i] = x
    h = A.mix(np.concatenate([h, extra]))
    doc = np.concatenate([doc[at], short])
    order = np.argsort(h)
    order = order[np.argsort(doc[order].astype(np.uint16 if len(counts) < 65536 else np.int64), kind="stable")]
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], h[new]


def _starts(sorted_ids: np.ndarray, n: int) -> np.ndarray:
    return np.searchsorted(sorted_ids, np.arange(n + 1))


_LONGS = pa.list_(pa.int64())
ENTRY = "block int, r long, id long, n int, fp1 long, fp2 long, h array<long>, d array<long>"
PART = "bucket int, r long, id long, n int, fp1 long, fp2 long, h array<long>, d array<long>"
ROW = "r long, id long, n int, fp1 long, fp2 long, h array<long>"


def _lists(values: np.ndarray, edge: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.array(values.view(np.int64)))


def entries(blocks: int, hasher):
    """Arrow task: rows of the matrix into column blocks.  ``hasher`` gives the
    sorted distinct (document, hash) pairs of a piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = A.byte_buffer(batch.column("text"))
            r_all, id_all = batch.column("r").to_numpy(), batch.column("id").to_numpy()
            for a, b in A.pieces(off, PIECE_BYTES):
                m = b - a
                doc, h = hasher(buf[off[a]:off[b]], off[a:b + 1] - off[a])
                edge = _starts(doc, m)
                n = np.diff(edge)
                fp1, fp2 = np.zeros(m, np.uint64), np.zeros(m, np.uint64)
                if (n > 0).any():
                    fp1[n > 0] = np.add.reduceat(h, edge[:-1][n > 0])
                    fp2[n > 0] = np.add.reduceat(A.mix(h ^ _K), edge[:-1][n > 0])
                # columns that repeat within the piece: known to be shared
                order = np.argsort(h)
                by = h[order]
                head = np.ones(len(by), bool)
                head[1:] = by[1:] != by[:-1]
                alone = head.copy()
                alone[:-1] &= head[1:]
                mine = np.zeros(len(h), bool)
                mine[order[~alone]] = True
                marks = by[head & ~alone]
                shared, s_doc = h[mine], doc[mine]
                r = r_all[a:b]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((r.astype(np.uint64) % np.uint64(blocks)).astype(np.int32)), pa.array(r), pa.array(id_all[a:b]), pa.array(n, pa.int32()),
                     pa.array(fp1.view(np.int64)), pa.array(fp2.view(np.int64)), _lists(shared, _starts(s_doc, m)),
                     pa.nulls(m, _LONGS)], names=_NAMES)
                # all other entries, and one mark for each repeated column, by block
                col = np.concatenate([h[~mine], marks])
                who = np.concatenate([r[doc[~mine]], np.full(len(marks), -1, np.int64)])
                is_mark = np.r_[np.zeros(len(col) - len(marks), bool), np.ones(len(marks), bool)]
                block = ((col >> np.uint64(32)) % np.uint64(blocks)).astype(np.int32)
                order = np.argsort(block.astype(np.uint16) if blocks < 65536 else block, kind="stable")
                col, who, is_mark, block = col[order], who[order], is_mark[order], block[order]
                head = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(block) else np.zeros(0, np.int64)
                edge = np.r_[head, len(block)] if len(block) else np.zeros(1, np.int64)
                k = len(head)
                # marks of a block come last: n says how many
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block[head]), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()),
                     pa.array(np.add.reduceat(is_mark, head).astype(np.int32) if k else np.zeros(0, np.int32)),
                     pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), _lists(col, edge), _lists(who, edge)], names=_NAMES)

    return run


_NAMES = ["block", "r", "id", "n", "fp1", "fp2", "h", "d"]


def _flat(col: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(all values, list lengths) of a list column without nulls."""
    one = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return one.flatten().to_numpy(zero_copy_only=False), np.diff(one.offsets.to_numpy())


def shared(buckets: int):
    """Group task, one column block: the rows of documents go through; of the
    entries only those of columns with a mark or a second entry stay, as one
    row for each bucket of documents."""

    def run(group: pa.Table) -> pa.Table:
        is_row = group["d"].is_null().combine_chunks()
        rows = group.filter(is_row)
        bucket = pa.array((rows["r"].to_numpy().astype(np.uint64) % np.uint64(buckets)).astype(np.int32))
        out = [pa.table({"bucket": bucket, **{c: rows[c] for c in ("r", "id", "n", "fp1", "fp2", "h")}, "d": pa.nulls(len(bucket), _LONGS)})]
        entries = group.filter(pc.invert(is_row))
        if entries.num_rows:
            h, size = _flat(entries["h"])
            d, _ = _flat(entries["d"])
            marks = entries["n"].to_numpy()
            end = np.cumsum(size)
            is_mark = np.arange(len(h)) >= np.repeat(end - marks, size)
            order = np.argsort(h.view(np.uint64))
            h, d, is_mark = h[order], d[order], is_mark[order]
            head = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            n = np.diff(np.r_[head, len(h)])
            keep = np.repeat((n > 1) | np.add.reduceat(is_mark, head).astype(bool), n) & ~is_mark
            h, d = h[keep], d[keep]
            b = (d.view(np.uint64) % np.uint64(buckets)).astype(np.int32)
            order = np.lexsort((d, b))  # equal ids side by side compress well
            h, d, b = h[order], d[order], b[order]
            head = np.flatnonzero(np.r_[True, b[1:] != b[:-1]]) if len(b) else np.zeros(0, np.int64)
            edge, k = (np.r_[head, len(b)] if len(b) else np.zeros(1, np.int64)), len(head)
            out.append(pa.table({"bucket": pa.array(b[head]), **{c: pa.nulls(k, t) for c, t in (("r", pa.int64()), ("id", pa.int64()), ("n", pa.int32()), ("fp1", pa.int64()), ("fp2", pa.int64()))},
                                 "h": _lists(h, edge), "d": _lists(d, edge)}))
        return pa.concat_tables(out)

    return run


def gather(percent: int):
    """Group task, one bucket of documents: every document with its shared
    columns, or null where they are fewer than ``percent`` of its set."""

    def run(group: pa.Table) -> pa.Table:
        is_row = group["d"].is_null().combine_chunks()
        rows = group.filter(is_row).combine_chunks()
        r = rows["r"].to_numpy()
        order = np.argsort(r)
        rows, r = rows.take(pa.array(order)), r[order]
        own, size = _flat(rows["h"])
        part = group.filter(pc.invert(is_row))
        h, d = (np.concatenate([x, _flat(part[c])[0]]) if part.num_rows else x for c, x in (("h", own), ("d", np.repeat(r, size))))
        at = np.searchsorted(r, d)
        order = np.argsort(at, kind="stable")
        at, h = at[order], h[order]
        count = np.bincount(at, minlength=len(r))
        keep = (count > 0) & (count * 100 >= rows["n"].to_numpy() * percent)
        kept = _lists(h[keep[at]], np.r_[0, np.cumsum(np.where(keep, count, 0))])
        none = pa.nulls(1, _LONGS)
        lists = pc.if_else(pa.array(keep), kept, none[0]) if len(r) else kept
        return pa.table({**{c: rows[c] for c in ("r", "id", "n", "fp1", "fp2")}, "h": lists})

    return run


def need(n: str | F.Column, percent: int) -> F.Column:
    """ceil(percent / 100 * n) in whole numbers."""
    n = F.col(n) if isinstance(n, str) else n
    return F.floor((n * percent + 99) / 100)


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(r, id, text) of the rows with an id: r is the id where ids are unique,
    else a hash of id and text, and rows that repeat both stay once."""
    rows = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    if rows.groupBy("id").count().where("count > 1").limit(1).count():
        return rows.dropDuplicates(["id", "text"]).select(F.xxhash64("id", "text").alias("r"), "id", "text")
    return rows.select(F.col("id").alias("r"), "id", "text")


def with_shared_columns(rows: DataFrame, hasher, percent: int) -> DataFrame:
    """(r, id, n, fp1, fp2, h) of every row of ``keyed``: the size and
    fingerprint of its set of hashes, and those that another row has too; null
    where these are fewer than ``percent`` of the set, or none."""
    spark = rows.sparkSession
    bounded_batches(spark)
    blocks = 2 * partitions(spark)
    parts = rows.select("r", "id", "text").mapInArrow(entries(blocks, hasher), ENTRY).groupBy("block").applyInArrow(shared(blocks), PART)
    return parts.groupBy("bucket").applyInArrow(gather(percent), ROW)


def sets(docs: DataFrame, *, doc_id: str, text: str, size: int, percent: int) -> DataFrame:
    """(r, id, n, fp1, fp2, h): every document's set size and fingerprint, and
    its shared columns unless the bound on rows rules out any link."""
    return with_shared_columns(keyed(docs, doc_id, text), lambda buf, off: shingles(buf, off, size), percent)


def classes(found: DataFrame) -> DataFrame:
    """(rep, n, h) of the distinct sets that may have links."""
    return (found.where("h is not null").groupBy("n", "fp1", "fp2")
            .agg(F.min("r").alias("rep"), F.min_by("h", "r").alias("h")).select("rep", "n", "h"))


def ordered_rows(found: DataFrame, percent: int) -> DataFrame:
    """(rep, n, own, h): each class's shared columns, rarest first.  ``own``:
    columns that no other class has, which stand before them."""
    entry = classes(found).select("rep", "n", F.explode("h").alias("c"))
    column = entry.groupBy("c").agg(F.count("*").alias("df")).where("df > 1")
    kept = (entry.join(column, "c").groupBy("rep", "n")
            .agg(F.array_sort(F.collect_list(F.struct("df", "c"))).alias("x")))
    return kept.where(F.size("x") >= need("n", percent)).select("rep", "n", (F.col("n") - F.size("x")).alias("own"), F.col("x.c").alias("h"))


def _links(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """The pairs whose exact overlap reaches the threshold."""
    a = rows.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("h").alias("ha"))
    b = rows.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("h").alias("hb"))
    both = pairs.join(a, "a").join(b, "b").withColumn("o", F.size(F.array_intersect("ha", "hb")))
    return both.where(F.col("o") * 100 >= (F.col("na") + F.col("nb") - F.col("o")) * percent).select(F.col("a").alias("u"), F.col("b").alias("v"))


def _union(edges: np.ndarray) -> np.ndarray:
    """The edges (positions) of a spanning forest of label pairs."""
    parent: dict[int, int] = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for i, (u, v) in enumerate(edges.tolist()):
        u, v = find(u), find(v)
        if u != v:
            parent[max(u, v)] = min(u, v)
            kept.append(i)
    return np.array(kept, np.int64)


def _dense(rows: np.ndarray, cols: np.ndarray, n: int, lo: int, hi: int) -> np.ndarray:
    out = np.zeros((n, hi - lo), np.float32)
    a, b = np.searchsorted(cols, [lo, hi])
    out[rows[a:b], cols[a:b] - lo] = 1
    return out


def product(percent: int):
    """Group task, one pair of row blocks: overlaps accumulate over column
    blocks; the links that join different labels come out as a forest."""

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        side, rep, n, label = (group[c].to_numpy() for c in ("side", "rep", "n", "label"))
        h, size = _flat(group["h"])
        one = not side.any()
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == (0 if one else 1))
        place = np.empty(len(side), np.int64)
        place[left] = np.arange(len(left))
        place[right] = np.arange(len(right))
        entry = np.repeat(np.arange(len(side)), size)
        col, both = np.unique(h, return_inverse=True)
        on_left, on_right = (np.bincount(both, side[entry] == k, minlength=len(col)) for k in (0, 1))
        use = (on_left > 1) if one else (on_left > 0) & (on_right > 0)
        number = np.cumsum(use) - 1
        keep = use[both]
        entry, c = entry[keep], number[both[keep]]
        order = np.argsort(c, kind="stable")
        entry, c = entry[order], c[order]
        mine = side[entry] == 0
        overlap = np.zeros((len(left), len(right)), np.float32)
        for lo in range(0, int(use.sum()), COLUMN_BLOCK):
            hi = min(lo + COLUMN_BLOCK, int(use.sum()))
            x = _dense(place[entry[mine]], c[mine], len(left), lo, hi)
            y = x if one else _dense(place[entry[~mine]], c[~mine], len(right), lo, hi)
            overlap += x @ y.T
        o = overlap.astype(np.int64)
        link = o * (100 + percent) >= (n[left][:, None] + n[right][None, :]) * percent
        link &= label[left][:, None] != label[right][None, :]
        i, j = np.nonzero(link)
        kept = _union(np.stack([label[left][i], label[right][j]], axis=1)) if len(i) else np.zeros(0, np.int64)
        return pa.table({"u": pa.array(rep[left][i[kept]], pa.int64()), "v": pa.array(rep[right][j[kept]], pa.int64())})

    return run


def _live(posting: DataFrame, labels: DataFrame | None, turn: int) -> DataFrame:
    """Entries of the columns that still hold two labels, with the row of the
    column that this turn's order puts first."""
    at = posting.withColumn("label", F.col("rep")) if labels is None else \
        posting.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    column = at.groupBy("c").agg(F.min("label").alias("lo"), F.max("label").alias("hi"),
                                 F.min(F.struct(F.xxhash64("rep", F.lit(turn)).alias("o"), "rep", "n", "label")).alias("first"))
    return at.join(column.where("lo <> hi").select("c", "first"), "c")


def link_components(rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(rep, label): the smallest class each linked class can reach."""
    prefix = F.col("n") - need("n", percent) + 1 - F.col("own")
    posting = written(rows.select("rep", "n", F.explode(F.slice("h", F.lit(1), F.greatest(prefix, F.lit(0)).cast("int"))).alias("c"))
                      .select("c", "rep", "n"), "jaccard-postings")
    labels, edges = None, None
    for turn in range(STAR_ROUNDS):
        live = _live(posting, labels, turn).where("label <> first.label")
        live = live.where(F.least("n", "first.n") * 100 >= F.greatest("n", "first.n") * percent)
        pairs = live.groupBy("rep").agg(F.min("first").alias("f")).select(F.col("rep").alias("a"), F.col("f.rep").alias("b"))
        edges = _more(edges, _links(pairs, rows, percent))
        labels = written(components(edges), "jaccard-labels")
    return written(components(_more(edges, _block_links(_live(posting, labels, STAR_ROUNDS), rows, percent))), "jaccard-labels") \
        .withColumnRenamed("node", "rep")


def _more(edges: DataFrame | None, new: DataFrame) -> DataFrame:
    new = written(new, "jaccard-links")
    return new if edges is None else edges.unionByName(new)


def _block_links(live: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Links that join labels, over all pairs of row blocks that share a live
    column.  A row's block is its smallest live column, cut into parts of about
    ROW_BLOCK rows, so rows that look alike share blocks."""
    home = live.groupBy("rep", "label").agg(F.min("c").alias("home"))
    parts = home.groupBy("home").agg(F.ceil(F.count("*") / ROW_BLOCK).alias("parts"))
    home = written(home.join(parts, "home").select("rep", "label", F.xxhash64("home", F.pmod(F.xxhash64("rep"), F.col("parts"))).alias("block")), "jaccard-blocks")
    on = live.select("c", "rep").join(home, "rep").select("c", "block").distinct()
    pairs = on.join(on.withColumnRenamed("block", "other"), "c").where("block <= other").select("block", "other").distinct()
    body = home.join(rows.select("rep", "n", "h"), "rep")
    left = pairs.join(body, "block").select("block", "other", F.lit(0).alias("side"), "rep", "n", "label", "h")
    right = pairs.where("block < other").join(body.withColumnRenamed("block", "other"), "other").select("block", "other", F.lit(1).alias("side"), "rep", "n", "label", "h")
    return left.unionByName(right).groupBy("block", "other").applyInArrow(product(percent), "u long, v long")


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    found = written(sets(docs, doc_id=doc_id, text=text, size=size, percent=percent), "jaccard-sets")
    rows = written(ordered_rows(found, percent), "jaccard-rows")
    labels = link_components(rows, percent)
    member = found.where("h is not null").select("r", "id", "n", "fp1", "fp2")
    rep = member.groupBy("n", "fp1", "fp2").agg(F.min("r").alias("rep"))
    rep = rep.join(labels, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    member = member.join(rep, ["n", "fp1", "fp2"]).select("r", "id", "label")
    smallest = member.groupBy("label").agg(F.min("id").alias("component"))
    member = member.join(smallest, "label").select("r", "component")
    out = found.join(member, "r", "left").select(F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"),
                                                 F.coalesce("component", "id").alias("component_id"))
    nameless = docs.where(F.col(doc_id).isNull()).select(F.lit(0).cast("long").alias("r"), F.lit(0).cast("long").alias("id"), F.col(text).alias("text"))
    nameless = nameless.mapInArrow(entries(1, lambda buf, off: shingles(buf, off, size)), ENTRY).where("r is not null").select(
        F.lit(None).cast("long").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return out.unionByName(nameless)


def report(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without those that have a near duplicate with a smaller id;
    rows with a null id stay, rows that repeat an id stay only once."""
    gone = near_duplicates(docs, doc_id=doc_id, text=text).where("component_id < doc_id").select(F.col("doc_id").alias("__gone")).distinct()
    kept = docs.join(gone, F.col(doc_id) == F.col("__gone"), "left_anti")
    if docs.where(F.col(doc_id).isNotNull()).groupBy(doc_id).count().where("count > 1").limit(1).count():
        named = kept.where(F.col(doc_id).isNotNull()).dropDuplicates([doc_id, text])
        kept = named.unionByName(kept.where(F.col(doc_id).isNull()))
    return kept
