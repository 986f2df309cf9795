"""Suffix-array dedup of repeated byte strings across documents.

A string of ``LENGTH`` bytes can only repeat where its anchor repeats: the
smallest hash of its ``GRAM``-byte grams.  So

0. of equal texts only the one with the smallest doc_id goes on: it holds all
   their strings, and a larger document with the same text loses all of it;
1. anchors that stand in more than one document are found by hash blocks
   (the column blocks of the Jaccard join);
2. runs of neighbouring strings with one such anchor become segments; equal
   segments are one row with the smallest document that holds them, whatever
   the size of a group of copies;
3. segments are dealt and sorted by anchor and cut into shards of about
   ``SHARD_BYTES``.  A shard's suffix array is built by induced sorting
   (``induced``); suffixes next to each other whose permuted common prefix
   reaches ``LENGTH`` hold the same string, and each such group's smallest
   document is written back to its strings.  The strings of an anchor of more
   than ``HOT_DOCUMENTS`` texts are segments each, dealt by their own hash.  A
   colder anchor whose segments still outgrow a shard is cut into shards by the
   hash of its strings;
4. every occurrence of a segment takes the strings whose smallest document is
   smaller than its own, and the covered bytes of a document are merged and
   cut out.

Matches never cross documents and are judged on the input.  Defined cases:
null and empty texts lose nothing; rows with a null doc_id neither lose bytes
nor make others lose them; repeated rows (same id and text) are one document
and each row is answered; rows of one id do not make each other lose bytes;
other columns are only carried along.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrowtext as A
from .common import bounded_batches, written
from .induced import permuted_common_prefixes, suffix_array
from .jaccard_join import with_shared_columns

LENGTH = 50
GRAM = 24
SHARD_BYTES = 1_500_000
#: Strings around one occurrence of an anchor, and so in a segment, at most.
SEGMENT_STRINGS = LENGTH - GRAM + 1
#: So many texts with segments of their own fill a shard.
HOT_DOCUMENTS = SHARD_BYTES // (LENGTH + SEGMENT_STRINGS - 1)
PIECE_BYTES = 1_500_000


def anchor_runs(buf: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first string, number of strings, document, anchor) of the runs of
    neighbouring strings of ``length`` bytes with one anchor; strings lie in
    one document."""
    n, gram = len(buf), min(GRAM, length)
    if n < length:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    pw, inv = A.powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * pw, out=total[1:])
    x = A.mix((total[gram:] - total[:-gram]) * inv[:n - gram + 1])
    width, span = length - gram + 1, 1
    while span * 2 <= width:  # smallest over a sliding width
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    if width > span:
        x = np.minimum(x[:span - width], x[width - span:])
    good = np.maximum(np.diff(offsets) - length + 1, 0)
    # a run ends where the anchor changes, and with its document's strings
    head = np.ones(len(x) + 1, bool)
    np.not_equal(x[1:], x[:-1], out=head[1:-1])
    some = good > 0
    head[offsets[:-1][some]] = True
    head[(offsets[:-1] + good)[some]] = True
    first = np.flatnonzero(head)
    first, count = first[:-1], np.diff(first)
    doc = np.searchsorted(offsets, first, side="right") - 1
    inside = first < offsets[doc] + good[doc]
    first, count, doc = first[inside], count[inside], doc[inside]
    return first, count, doc, x[first]


def anchor_sets(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct (document, anchor) pairs."""
    _, _, doc, x = anchor_runs(buf, offsets)
    order = np.lexsort((x, doc))
    doc, x = doc[order], x[order]
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], x[new]


SEGMENT = "r long, id long, pos int, anchor long, seg binary"
DISTINCT = "anchor long, top long, most long, seg binary"


def _distinct_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct segments of a piece, with their smallest and largest
    document: copies within a piece leave the task as one row."""
    for batch in _segments(batches):
        t = pa.Table.from_batches([batch.select(["anchor", "id", "seg"])]).group_by(["anchor", "seg"]).aggregate([("id", "min"), ("id", "max")])
        t = t.select(["anchor", "id_min", "id_max", "seg"]).rename_columns(["anchor", "top", "most", "seg"])
        yield from t.combine_chunks().to_batches()


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of neighbouring strings that share one shared anchor; a longer run
    (an anchor that repeats within it) is several segments, and the strings of
    a hot anchor are a segment each, with their hash for an anchor."""
    for batch in batches:
        buf, off = A.byte_buffer(batch.column("text"))
        r, ids, sets, hot = batch.column("r").to_numpy(), batch.column("id").to_numpy(), batch.column("h"), batch.column("hot")
        for a, b in A.pieces(off, PIECE_BYTES):
            base = off[a]
            data, edges = buf[base:off[b]], off[a:b + 1] - base
            start, count, doc, x = anchor_runs(data, edges)
            known = np.unique(sets.slice(a, b - a).flatten().to_numpy(zero_copy_only=False).view(np.uint64))
            if len(x) == 0 or len(known) == 0:
                continue
            # an anchor shared by any document of the piece is looked up for all of them
            hit = known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x
            start, count, doc, x = start[hit], count[hit], doc[hit], x[hit]
            if len(x) == 0:
                continue
            warm = np.unique(hot.slice(a, b - a).flatten().to_numpy(zero_copy_only=False).view(np.uint64))
            alone = np.isin(x, warm) if len(warm) else np.zeros(len(x), bool)
            # runs cut into segments of so many strings
            most = np.where(alone, 1, SEGMENT_STRINGS)
            parts = -(-count // most)
            k = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
            lo = np.repeat(start, parts) + k * np.repeat(most, parts)
            size = np.minimum(np.repeat(start + count, parts) - lo, np.repeat(most, parts)) + LENGTH - 1
            d, x, alone = np.repeat(doc, parts), np.repeat(x, parts), np.repeat(alone, parts)
            if alone.any():
                x[alone] = _string_hash(data, lo[alone])
            edge = np.r_[0, np.cumsum(size)]
            step = max(1, int(np.searchsorted(edge, 4 * PIECE_BYTES)))
            for p in range(0, len(lo), step):
                q = min(p + step, len(lo))
                n = size[p:q]
                at = np.repeat(lo[p:q] - (edge[p:q] - edge[p]), n) + np.arange(int(n.sum()))
                seg = pa.Array.from_buffers(pa.binary(), q - p, [None, pa.py_buffer((edge[p:q + 1] - edge[p]).astype(np.int32)), pa.py_buffer(data[at])])
                pos = lo[p:q] - edges[d[p:q]]
                yield pa.RecordBatch.from_arrays([pa.array(r[a:b][d[p:q]]), pa.array(ids[a:b][d[p:q]]), pa.array(pos.astype(np.int32)),
                                                  pa.array(x[p:q].view(np.int64)), seg], names=["r", "id", "pos", "anchor", "seg"])


def _string_hash(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hash of the string of ``LENGTH`` bytes at each position."""
    h = np.zeros(len(at), np.uint64)
    for k in range(LENGTH):
        h = (h + data[at + k] + np.uint64(1)) * np.uint64(A._R)
    return A.mix(h)


FOUND = "anchor long, sh long, runs array<struct<f:int,t:int,top:long>>"
_RUNS = pa.list_(pa.struct([("f", pa.int32()), ("t", pa.int32()), ("top", pa.int64())]))


def shard_minima(segments: pa.Array, top: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array of one shard: (segment, offset, smallest document) of every
    string of ``length`` bytes in the shard's segments."""
    buf, off = A.byte_buffer(segments)
    n = len(off) - 1
    # segments one after the other, each closed by the symbol 1; 0 closes all
    shift = np.repeat(np.arange(n), np.diff(off))
    text = np.ones(len(buf) + n + 1, np.int32)
    text[np.arange(len(buf)) + shift] = buf.astype(np.int32) + 2
    text[-1] = 0
    begin = off[:-1] + np.arange(n)
    good = np.maximum(np.diff(off) - length + 1, 0)
    owner = np.full(len(text), -1, np.int32)
    seg = np.repeat(np.arange(n), good)
    where = np.repeat(begin - (np.cumsum(good) - good), good) + np.arange(int(good.sum()))
    owner[where] = seg
    whole = suffix_array(text, 258)
    sa = whole[owner[whole] >= 0]
    head = permuted_common_prefixes(text, sa)[sa] < length
    group = np.cumsum(head) - 1
    least = np.empty(len(text), np.int64)
    if len(sa):
        least[sa] = np.minimum.reduceat(top[owner[sa]], np.flatnonzero(head))[group]
    return seg, where - begin[seg], least[where]


def _found(t: pa.Table, seg: np.ndarray, at: np.ndarray, least: np.ndarray) -> pa.RecordBatch:
    """FOUND rows of segments ``t``: runs of offsets with one smallest
    document, where another document can lose them."""
    use = least < t["most"].to_numpy()[seg]
    seg, at, least = seg[use], at[use], least[use]
    head = np.ones(len(seg), bool)
    head[1:] = (seg[1:] != seg[:-1]) | (at[1:] != at[:-1] + 1) | (least[1:] != least[:-1])
    h = np.flatnonzero(head)
    last = np.r_[h[1:], len(seg)] - 1 if len(h) else h
    edge = np.searchsorted(seg[h], np.arange(t.num_rows + 1)).astype(np.int32)
    runs = pa.StructArray.from_arrays([pa.array(at[h].astype(np.int32)), pa.array((at[last] + LENGTH).astype(np.int32)), pa.array(least[h])],
                                      names=["f", "t", "top"])
    out = pa.RecordBatch.from_arrays([_one(t["anchor"]), _one(t["sh"]), pa.ListArray.from_arrays(pa.array(edge), runs).cast(_RUNS)],
                                     names=["anchor", "sh", "runs"])
    return out.filter(pa.array(np.diff(edge) > 0))


def _one(col: pa.ChunkedArray) -> pa.Array:
    col = col.combine_chunks()
    return col if isinstance(col, pa.Array) else col.chunk(0)


def _by_string(t: pa.Table) -> Iterator[pa.RecordBatch]:
    """FOUND rows of one anchor's segments that outgrow a shard: its strings
    are shards by their hash, so equal ones meet; a segment has a row of each."""
    top = t["top"].to_numpy()
    buf, off = A.byte_buffer(t["seg"].combine_chunks())
    good = np.maximum(np.diff(off) - LENGTH + 1, 0)
    ends = np.cumsum(good)
    shards = -(-int(ends[-1]) * LENGTH // SHARD_BYTES)
    span = max(1, SHARD_BYTES // LENGTH)

    def strings(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Segment and offset of the strings a..b."""
        k = np.arange(a, b)
        seg = np.searchsorted(ends, k, side="right")
        return seg, k - (ends[seg] - good[seg])

    def hashes(a: int, b: int) -> np.ndarray:
        seg, at = strings(a, b)
        return (_string_hash(buf, off[seg] + at) % np.uint64(shards)).astype(np.int32)

    shard = np.concatenate([hashes(a, min(a + span, int(ends[-1]))) for a in range(0, int(ends[-1]), span)])
    for j in range(shards):
        mine = np.flatnonzero(shard == j)
        if not len(mine):
            continue
        seg = np.searchsorted(ends, mine, side="right")
        at = mine - (ends[seg] - good[seg])
        data = buf[(off[seg] + at)[:, None] + np.arange(LENGTH)]
        # equal strings of one shard are one, with their smallest document
        same, inverse = np.unique(data.view(f"V{LENGTH}").ravel(), return_inverse=True)
        low = np.full(len(same), np.iinfo(np.int64).max)
        np.minimum.at(low, inverse, top[seg])
        yield _found(t, seg, at, low[inverse])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut rows sorted by anchor into shards at borders between anchors, and
    within an anchor that outgrows one."""
    held: list[pa.RecordBatch] = []
    held_bytes = 0

    def flush(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(rows).combine_chunks()
        size, x = pc.binary_length(t["seg"]).to_numpy(), t["anchor"].to_numpy()
        if int(size.sum()) > SHARD_BYTES and len(x):
            head = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
            large = np.add.reduceat(size.astype(np.int64), head) > SHARD_BYTES
            edge = np.r_[head, len(x)]
            for k in np.flatnonzero(large):
                yield from _by_string(t.slice(int(edge[k]), int(edge[k + 1] - edge[k])).combine_chunks())
            t = t.filter(pa.array(~np.repeat(large, np.diff(edge)))).combine_chunks()
        if t.num_rows:
            yield _found(t, *shard_minima(_one(t["seg"]), t["top"].to_numpy()))

    for batch in batches:
        while batch.num_rows:
            x = batch.column("anchor").to_numpy()
            size = np.cumsum(pc.binary_length(batch.column("seg")).to_numpy())
            cut = batch.num_rows
            if held_bytes + int(size[-1]) >= SHARD_BYTES:  # at the first border beyond the size
                k = int(np.searchsorted(size, max(SHARD_BYTES - held_bytes, 0)))
                if held and held_bytes >= SHARD_BYTES and x[0] != held[-1].column("anchor")[-1].as_py():
                    cut = 0
                else:
                    borders = np.flatnonzero(x[1:] != x[:-1]) + 1
                    borders = borders[borders > k]
                    cut = int(borders[0]) if len(borders) else batch.num_rows
                    held.append(batch.slice(0, cut))
                    held_bytes += int(size[cut - 1])
                    batch = batch.slice(cut)
                    if not batch.num_rows:
                        break  # the anchor may go on in the next batch
                yield from flush(held)
                held, held_bytes = [], 0
                continue
            held.append(batch)
            held_bytes += int(size[-1])
            break
    if held:
        yield from flush(held)


def distinct_texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(r, id, text): every text that is long enough once, with its 64-bit
    hash r, by which texts are told apart, and its smallest document."""
    some = docs.where(F.col(doc_id).isNotNull() & (F.octet_length(text) >= LENGTH)).select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    return some.groupBy(F.xxhash64("text").alias("r")).agg(F.min("id").alias("id"), F.min("text").alias("text"))


def covered(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(distinct texts, spans): per text r the byte ranges (f, t) that strings
    of smaller documents cover, unmerged."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = distinct_texts(docs, doc_id, text)
    some = written(with_shared_columns(rows, anchor_sets, 0).where("h is not null").select("r", "h"), "suffix-anchors")
    both = rows.join(some, "r").select("r", "id", "text", "h")
    pairs = some.select("r", F.explode("h").alias("anchor"))
    hot = written(pairs.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > HOT_DOCUMENTS).select("anchor"), "suffix-hot")
    none = F.array().cast("array<long>")
    if hot.isEmpty():
        both = both.withColumn("hot", none)
    else:
        mine = pairs.join(hot, "anchor").groupBy("r").agg(F.collect_list("anchor").alias("hot"))
        both = both.join(mine, "r", "left").withColumn("hot", F.coalesce("hot", none))
    occurrence = both.mapInArrow(_segments, SEGMENT).withColumn("sh", F.xxhash64("seg"))
    # dealt by anchor once: neither the grouping nor the sort shuffles again;
    # the hash that tells segments apart is made where they arrive
    dealt = both.mapInArrow(_distinct_segments, DISTINCT).repartition("anchor").withColumn("sh", F.xxhash64("seg")) \
        .groupBy("anchor", "sh").agg(F.min("top").alias("top"), F.max("most").alias("most"), F.min("seg").alias("seg")) \
        .sortWithinPartitions("anchor")
    found = dealt.select("anchor", "sh", "top", "most", "seg").mapInArrow(_shards, FOUND)
    hit = occurrence.select("r", "id", "pos", "anchor", "sh").join(found, ["anchor", "sh"])
    lose = F.filter("runs", lambda x: x["top"] < F.col("id"))
    spans = hit.select("r", F.transform(lose, lambda x: F.struct((x["f"] + F.col("pos")).alias("f"), (x["t"] + F.col("pos")).alias("t"))).alias("s")) \
        .where(F.size("s") > 0).groupBy("r").agg(F.flatten(F.collect_list("s")).alias("spans"))
    return rows, spans


CUT = "id long, v long, n_removed long, n_spans long, kept binary"


def _cut(digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = A.byte_buffer(batch.column("text"))
            raw, spans = buf.tobytes(), batch.column("spans")
            lists, flat = spans.offsets.to_numpy(), spans.flatten()
            base = lists[0] if len(lists) else 0
            f, t = flat.field("f").to_numpy(zero_copy_only=False), flat.field("t").to_numpy(zero_copy_only=False)
            kept, removed, n_spans = [], [], []
            for k in range(batch.num_rows):
                text = raw[off[k]:off[k + 1]]
                a, b = lists[k] - base, lists[k + 1] - base
                order = np.argsort(f[a:b], kind="stable")
                lo, hi = f[a:b][order], np.maximum.accumulate(t[a:b][order])
                head = np.r_[True, lo[1:] > hi[:-1]]
                lo, hi = lo[head], hi[np.r_[np.flatnonzero(head)[1:] - 1, len(head) - 1]]
                parts = [text[x:y] for x, y in zip([0, *hi.tolist()], [*lo.tolist(), len(text)])]
                kept.append(b"".join(parts))
                removed.append(int((hi - lo).sum()))
                n_spans.append(len(lo))
            if digest:
                kept = [hashlib.sha256(x).hexdigest().encode() for x in kept]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()),
                                              pa.array(kept, pa.binary())], names=["id", "v", "n_removed", "n_spans", "kept"])

    return run


def dedup(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every row; ``kept``: the
    remaining bytes, or their SHA-256 in hexadecimal when ``digest``."""
    rows, spans = covered(docs, doc_id=doc_id, text=text)
    cut = rows.join(spans, "r").select("id", F.col("r").alias("v"), "text", "spans").mapInArrow(_cut(digest), CUT)
    cut = cut.select(F.col("id").alias("cut_id"), F.col("v").alias("cut_v"), "n_removed", "n_spans", "kept")
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    # what every row needs without its spans: its size, its whole checksum
    base = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("v"), F.octet_length(raw).cast("long").alias("n_bytes"),
                       (F.sha2(raw, 256).cast("binary") if digest else raw).alias("whole"))
    least = base.where(F.col("id").isNotNull()).groupBy("v", "n_bytes").agg(F.min("id").alias("least")).where(F.col("n_bytes") >= LENGTH)
    both = base.join(least, ["v", "n_bytes"], "left").join(cut, (F.col("id") == F.col("cut_id")) & (F.col("v") == F.col("cut_v")), "left")
    copy = F.col("id") > F.col("least")
    empty = F.lit(hashlib.sha256(b"").hexdigest() if digest else "").cast("binary")
    return both.select(
        F.col("id").alias(doc_id), "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, empty).otherwise(F.coalesce("kept", "whole")).alias("kept"))


def report(docs: DataFrame) -> DataFrame:
    return dedup(docs, digest=True).withColumn("kept_sha256", F.col("kept").cast("string")).drop("kept")
