"""Stupid-backoff language model scores.

Documents are dealt into pieces of about ``PIECE_BYTES``.  A piece explodes its
texts into word n-grams of every order up to ``ORDER`` and sends each distinct
n-gram once, with its count, to the block its hash belongs to.  A block holds
one slice of the count tables: it adds up the counts of its n-grams and joins
them back to the pieces that asked.  A piece then meets its counts and sums the
scores of its documents.  What is gathered grows with the corpus, no table is
ever whole in one place, and a frequent n-gram costs one entry per piece.
Orders are counted in turn (``passes``) and only their counts are kept, so the
shuffled n-grams of one pass are gone before the next.

The score leaves the document's own counts out, so a text does not predict
itself: S(w | context) is c(context w) / c(context) where that is seen in
other documents, else BACKOFF times the score with a context shorter by a
word; a word unseen elsewhere scores BACKOFF / N, N being the words of all
other documents.

Defined cases: null and empty texts have no words and a null score; repeated
rows count as documents of their own; rows with a null id are scored and
counted like others; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrowtext as A
from .common import bounded_batches, partitions, written
from .decontaminate import words_of

ORDER = 3
BACKOFF = 0.4
PIECE_BYTES = 4_000_000
_K = np.uint64(0x9E3779B97F4A7C15)


def ngrams(col: pa.Array, orders) -> tuple[np.ndarray, list[np.ndarray]]:
    """Words per document, and for each n of ``orders`` the hash of the n-gram
    that ends at each word (0 where the document has fewer words before it)."""
    buf, off = A.byte_buffer(col)
    hashes, counts = [], []
    for a, b in A.pieces(off, 2_000_000):
        po = off[a:b + 1] - off[a]
        _, s, _, h = words_of(buf[off[a]:off[b]], po)
        hashes.append(h)
        counts.append(A.counts_per_doc(s, po))
    words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    n_words = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    at = np.arange(len(words)) - np.repeat(np.cumsum(n_words) - n_words, n_words)
    out = []
    # hash of the last n words, from the oldest to the newest
    for n in orders:
        h = np.zeros(len(words), np.uint64)
        for k in range(n - 1, -1, -1):
            h = h * _K
            h[k:] += words[:len(words) - k] if k else words
        h = A.mix(h + np.uint64(n))
        h[at < n - 1] = 0
        out.append(h)
    return n_words, out


def _distinct(h: np.ndarray, blocks: int):
    """Distinct hashes sorted by (block, hash), their counts, their blocks'
    edges, and where each n-gram of the piece stands among them."""
    real = h != 0
    keys, inverse, n = np.unique(h[real], return_inverse=True, return_counts=True)
    block = ((keys >> np.uint64(32)) % np.uint64(blocks)).astype(np.int64)
    deal = np.argsort(block, kind="stable")
    place = np.empty(len(keys), np.int64)
    place[deal] = np.arange(len(keys))
    where = np.full(len(h), -1, np.int64)
    where[real] = place[inverse]
    return keys[deal], n[deal], np.searchsorted(block[deal], np.arange(blocks + 1)), where


def passes(order: int) -> list[list[int]]:
    """Orders counted together: there are few words, so they go with the
    pairs; each longer n-gram alone."""
    return [list(range(1, min(order, 2) + 1)), *([n] for n in range(3, order + 1))]


ASK = "block int, piece long, n int, h array<long>, c array<int>"
GIVE = "block int, piece long, n int, c array<long>, words long"


def _ask(orders: list[int], blocks: int):
    def run(group: pa.Table) -> pa.Table:
        piece = group["piece"][0].as_py()
        parts = []
        for n, h in zip(orders, ngrams(group["text"].combine_chunks(), orders)[1]):
            keys, counts, edge, _ = _distinct(h, blocks)
            e = pa.array(edge.astype(np.int32))
            parts.append(pa.table({"block": pa.array(np.arange(blocks, dtype=np.int32)), "piece": pa.array(np.full(blocks, piece)),
                                   "n": pa.array(np.full(blocks, n, np.int32)), "h": pa.ListArray.from_arrays(e, pa.array(keys.view(np.int64))),
                                   "c": pa.ListArray.from_arrays(e, pa.array(counts.astype(np.int32)))}))
        return pa.concat_tables(parts)

    return run


def _count(group: pa.Table) -> pa.Table:
    """One block of the count tables: total count of every n-gram asked for."""
    group = group.combine_chunks()
    out = []
    words = 0
    for n in sorted(set(group["n"].to_pylist())):
        rows = group.filter(pc.equal(group["n"], n)).combine_chunks()
        h, c = rows["h"].combine_chunks(), rows["c"].combine_chunks()
        h, c = (x if isinstance(x, pa.Array) else x.chunk(0) for x in (h, c))
        edge = pc.list_value_length(h).to_numpy().cumsum()
        _, inverse = np.unique(h.flatten().to_numpy(zero_copy_only=False), return_inverse=True)
        counts = c.flatten().to_numpy(zero_copy_only=False)
        total = np.bincount(inverse, counts, minlength=1).astype(np.int64)[inverse]
        if n == 1:
            words = int(counts.sum())
        out.append(pa.table({"block": rows["block"], "piece": rows["piece"], "n": rows["n"],
                             "c": pa.ListArray.from_arrays(pa.array(np.r_[0, edge].astype(np.int32)), pa.array(total)),
                             "words": pa.array(np.full(rows.num_rows, words))}))
    return pa.concat_tables(out)


SCORE = "doc_id long, n_words long, n_backoff long, log10_score double"


def _score(order: int, blocks: int):
    def run(texts: pa.Table, counts: pa.Table) -> pa.Table:
        if texts.num_rows == 0:
            return pa.table({"doc_id": pa.array([], pa.int64()), "n_words": pa.array([], pa.int64()), "n_backoff": pa.array([], pa.int64()),
                             "log10_score": pa.array([], pa.float64())})
        n_words, grams = ngrams(texts["text"].combine_chunks(), range(1, order + 1))
        n_docs, doc = len(n_words), np.repeat(np.arange(len(n_words)), n_words)
        counts = counts.sort_by([("n", "ascending"), ("block", "ascending")]).combine_chunks()
        words = sum(counts.filter(pc.equal(counts["n"], 1))["words"].to_pylist())
        other = []  # per word and order: count of the n-gram that ends there, in other documents
        for n, h in enumerate(grams, 1):
            keys, _, _, where = _distinct(h, blocks)
            total = counts.filter(pc.equal(counts["n"], n))["c"].combine_chunks()
            total = (total if isinstance(total, pa.Array) else total.chunk(0)).flatten().to_numpy(zero_copy_only=False)
            real = np.flatnonzero(where >= 0)
            pair, inverse, own = np.unique(doc[real] * max(len(keys), 1) + where[real], return_inverse=True, return_counts=True)
            left = np.zeros(len(where), np.int64)
            left[real] = total[where[real]] - own[inverse]
            other.append(left)
        rest = np.maximum(words - n_words, 1)[doc]
        score = np.log10(np.where(other[0] > 0, other[0], BACKOFF) / rest)
        level = np.ones(len(doc), np.int64)
        at = np.arange(len(doc)) - np.repeat(np.cumsum(n_words) - n_words, n_words)
        for n in range(2, order + 1):
            has = at >= n - 1
            seen = has & (other[n - 1] > 0)
            before = np.zeros(len(doc), np.int64)
            before[1:] = other[n - 2][:-1]  # the context ends one word earlier
            # the context's count is at least the n-gram's; a document's own tail may tie it
            score = np.where(seen, np.log10(np.maximum(other[n - 1], 1) / np.maximum(before, 1)),
                             np.where(has, np.log10(BACKOFF) + score, score))
            level = np.where(seen, n, level)
        backoff = level < np.minimum(at + 1, order)
        return pa.table({"doc_id": texts["doc_id"], "n_words": pa.array(n_words), "n_backoff": pa.array(np.bincount(doc[backoff], minlength=n_docs)),
                         "log10_score": pa.array(np.bincount(doc, score, n_docs).astype(np.float64), mask=n_words == 0)})

    return run


def score(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """(doc_id, n_words, n_backoff, log10_score) of every row."""
    spark = docs.sparkSession
    bounded_batches(spark)
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n_pieces, blocks = max(1, -(-size // PIECE_BYTES)), partitions(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                       F.pmod(F.xxhash64(doc_id, text), F.lit(n_pieces)).alias("piece"))
    given = [written(rows.groupBy("piece").applyInArrow(_ask(orders, blocks), ASK).groupBy("block").applyInArrow(_count, GIVE), "backoff-counts")
             for orders in passes(order)]
    given = reduce(DataFrame.unionByName, given)
    return rows.groupBy("piece").cogroup(given.groupBy("piece")).applyInArrow(_score(order, blocks), SCORE)


def report(docs: DataFrame) -> DataFrame:
    out = score(docs)
    mean = F.col("log10_score") / F.col("n_words")
    return out.select("doc_id", "n_words", "n_backoff", F.round("log10_score", 4).alias("log10_score"), F.round(mean, 6).alias("mean_log10"))
