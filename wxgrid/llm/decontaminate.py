"""Benchmark decontamination with an FM-index per training shard.

Documents are read in their scan order; each task cuts its documents into
shards of about ``SHARD_WORDS`` words (a longer document is cut into pieces
that overlap by the longest phrase less one word).  For a shard it builds

* the sorted vocabulary of word hashes and the suffix array of the word
  sequence (ranks of three symbols at a time, then only unresolved groups),
* the Burrows-Wheeler transform in a wavelet matrix with ranks per level,
* suffix positions sampled every ``SAMPLE`` text positions,

then searches all phrases backwards at once, walks each hit back to a sampled
position, compares the located words' bytes with the phrase (an exact check
against hash collisions) and merges the removal spans per document.  No
shuffle: index, search and merge all happen where the document was read.

The phrases are the only thing sent to every task.  They are sent in blocks of
at most ``BLOCK_BYTES`` of text, each block one more pass over the shards in
the same stage, so their total size is not bounded by a broadcast.

Defined cases: null or empty texts have no words; items without words have no
phrase; repeated items count once per item_id, a null item_id is listed as the
empty string; repeated documents each get their own row; columns other than
the id and the text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrowtext as A
from .common import bounded_batches

WINDOW = 10
SHARD_WORDS = 600_000
PIECE_BYTES = 2_000_000
SAMPLE = 16
BLOCK_BYTES = 32 << 20

WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[0x30:0x3A] = WORD_BYTE[0x61:0x7B] = WORD_BYTE[0x80:] = True


def words_of(buf: np.ndarray, offsets: np.ndarray):
    """(lower-cased bytes, word starts, word ends, word hashes)."""
    low = A.LOWER[buf]
    starts, ends = A.word_spans(WORD_BYTE[low], offsets)
    return low, starts, ends, A.segment_hashes(low, starts, ends)


class Phrases:
    """The distinct windows of a block of items: word hashes (-1 padded
    matrix), word texts, and the items of each window."""

    def __init__(self, items: list[tuple[str, str]]):
        col = pa.array([t for _, t in items], pa.string())
        buf, off = A.byte_buffer(col)
        low, s, e, h = words_of(buf, off)
        n = A.counts_per_doc(s, off)
        first = np.r_[0, np.cumsum(n)]
        windows: dict[tuple[bytes, ...], set[str]] = {}
        hashes: dict[tuple[bytes, ...], np.ndarray] = {}
        raw = low.tobytes()
        for i, (name, _) in enumerate(items):
            a, b = int(first[i]), int(first[i + 1])
            size = min(WINDOW, b - a)
            for k in range(a, b - size + 1) if size else ():
                key = tuple(raw[s[j]:e[j]] for j in range(k, k + size))
                windows.setdefault(key, set()).add(name)
                hashes[key] = h[k:k + size]
        self.keys = list(windows)
        self.items = [sorted(windows[k]) for k in self.keys]
        self.length = np.array([len(k) for k in self.keys], np.int64)
        self.matrix = np.zeros((len(self.keys), WINDOW), np.uint64)
        for i, k in enumerate(self.keys):
            self.matrix[i, :len(k)] = hashes[k]
        self.vocab, word = np.unique(self.matrix, return_inverse=True)
        self.word = word.reshape(self.matrix.shape)


class FMIndex:
    """FM-index of one shard: a sequence of symbols 1..sigma with 0 between
    documents."""

    def __init__(self, hashes: np.ndarray, doc_end: np.ndarray):
        """``doc_end``: for each word, whether its document (piece) ends there."""
        order = np.argsort(hashes)
        by = hashes[order]
        new = np.r_[True, by[1:] != by[:-1]] if len(by) else np.zeros(0, bool)
        self.vocab = by[new]
        ids = np.empty(len(hashes), np.int64)
        ids[order] = np.cumsum(new)
        # word i of the shard stands at text position i + number of borders before it
        self.shift = np.r_[0, np.cumsum(doc_end)[:-1]] if len(hashes) else np.zeros(0, np.int64)
        text = np.zeros(len(hashes) + int(doc_end.sum()) + 1, np.int64)
        self.position = np.arange(len(hashes)) + self.shift
        text[self.position] = ids
        self.word_at = np.full(len(text), -1, np.int64)
        self.word_at[self.position] = np.arange(len(hashes))
        self.n = len(text)
        sa = self._suffix_array(text)
        self.bits = max(1, int(len(self.vocab)).bit_length())
        self.first = np.r_[0, np.cumsum(np.bincount(text, minlength=len(self.vocab) + 1))]
        self._wavelet(text[sa - 1])  # row of position 0 reads the closing 0
        # document starts are sampled too, so no walk crosses a border
        marked = (sa % SAMPLE == 0) | (text[sa - 1] == 0)
        self.marked = marked
        self.marks = np.r_[0, np.cumsum(marked)]
        self.sampled = sa[marked]

    @staticmethod
    def _suffix_array(text: np.ndarray) -> np.ndarray:
        """Sort by three symbols, then by three ranks (nine symbols); after
        that only the suffixes that still tie, by pairs of ranks."""
        n = len(text)
        rank, depth = text, 1
        while True:  # whole rounds
            top = int(rank.max() + 1).bit_length()
            many = 3 if 3 * top <= 63 else 2
            padded = np.zeros(n + (many - 1) * depth, np.int64)
            padded[:n] = rank
            padded[:n] += 1
            key = padded[:n].copy()
            for k in range(1, many):
                key <<= top
                key |= padded[k * depth:k * depth + n]
            sa = np.argsort(key)
            key = key[sa]
            new = np.empty(n, bool)
            new[0] = True
            np.not_equal(key[1:], key[:-1], out=new[1:])
            depth *= many
            rank = np.empty(n, np.int64)
            heads = np.flatnonzero(new)
            rank[sa] = np.repeat(heads, np.diff(heads, append=n))
            slots = FMIndex._ties(new)
            if len(slots) < n // 2 and depth >= 9 or len(slots) == 0:
                break
        while len(slots):  # rounds over the slots whose suffixes still tie
            todo = sa[slots]
            low, far = rank[todo], np.zeros(len(todo), np.int64)
            inside = todo + depth < n
            far[inside] = rank[todo[inside] + depth] + 1
            order = np.lexsort((far, low))
            todo, low, far = todo[order], low[order], far[order]
            sa[slots] = todo
            new = np.r_[True, (low[1:] != low[:-1]) | (far[1:] != far[:-1])]
            heads = np.flatnonzero(new)
            rank[todo] = np.repeat(slots[heads], np.diff(heads, append=len(todo)))
            depth *= 2
            slots = slots[FMIndex._ties(new)]
        return sa

    @staticmethod
    def _ties(new: np.ndarray) -> np.ndarray:
        """Members of groups of two or more; ``new`` marks each group's first."""
        alone = new.copy()
        alone[:-1] &= new[1:]
        return np.flatnonzero(~alone)

    def _wavelet(self, bwt: np.ndarray) -> None:
        self.ones, self.zeros = [], []
        bwt = bwt.astype(np.int32)
        for level in range(self.bits - 1, -1, -1):
            bit = (bwt & np.int32(1 << level)) != 0
            ones = np.zeros(len(bwt) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(bwt) - int(ones[-1]))
            bwt = np.concatenate([bwt[~bit], bwt[bit]])

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands in the transform before ``row``."""
        lo, hi = np.zeros_like(row), row
        for k, level in enumerate(range(self.bits - 1, -1, -1)):
            one = (symbol >> level & 1).astype(bool)
            a, b = self.ones[k][lo].astype(np.int64), self.ones[k][hi].astype(np.int64)
            lo = np.where(one, self.zeros[k] + a, lo - a)
            hi = np.where(one, self.zeros[k] + b, hi - b)
        return hi - lo

    def step(self, row: np.ndarray) -> np.ndarray:
        """Row of the suffix that starts one position earlier."""
        at, symbol = row, np.zeros_like(row)
        for k in range(self.bits):
            a, b = self.ones[k][at].astype(np.int64), self.ones[k][at + 1].astype(np.int64)
            one = b > a
            symbol = symbol * 2 + one
            at = np.where(one, self.zeros[k] + a, at - a)
        return self.first[symbol] + self.rank(symbol, row)

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """Symbols of word hashes; 0 where the shard lacks the word."""
        at = np.minimum(np.searchsorted(self.vocab, hashes), len(self.vocab) - 1)
        return np.where(self.vocab[at] == hashes, at + 1, 0)

    def search(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of all phrases: (phrase, first row, last row + 1)."""
        sym = self.symbols(phrases.vocab)[phrases.word]
        inside = np.arange(WINDOW)[None, :] < phrases.length[:, None]
        alive = np.flatnonzero(((sym > 0) | ~inside).all(axis=1) & (phrases.length > 0))
        lo, hi = np.zeros(len(alive), np.int64), np.full(len(alive), self.n, np.int64)
        for back in range(WINDOW):
            if len(alive) == 0:
                break
            left = phrases.length[alive] - 1 - back
            move = left >= 0
            c = sym[alive, np.maximum(left, 0)]
            lo = np.where(move, self.first[c] + self.rank(c, lo), lo)
            hi = np.where(move, self.first[c] + self.rank(c, hi), hi)
            some = hi > lo
            alive, lo, hi = alive[some], lo[some], hi[some]
        return alive, lo, hi

    def locate(self, row: np.ndarray) -> np.ndarray:
        """Text positions of rows, by walking back to sampled positions."""
        out, walked = np.zeros(len(row), np.int64), 0
        todo = np.arange(len(row))
        while len(todo):
            hit = self.marked[row]
            out[todo[hit]] = self.sampled[self.marks[row[hit]]] + walked
            todo, row = todo[~hit], row[~hit]
            if len(todo):
                row = self.step(row)
                walked += 1
        return out


def shard_ranges(n_words: int, limit: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Pieces of one long document, overlapping by ``overlap`` words."""
    a = 0
    while True:
        b = min(a + limit, n_words)
        yield a, b
        if b == n_words:
            return
        a = b - overlap


def _hits(phrases: Phrases, low: np.ndarray, s, e, h, counts) -> tuple[np.ndarray, np.ndarray]:
    """(first word of the occurrence, phrase) over a piece of documents."""
    found_at, found = [], []
    first = np.r_[0, np.cumsum(counts)]
    groups, a = [], 0
    while a < len(counts):  # documents into shards
        b = max(a + 1, int(np.searchsorted(first, first[a] + SHARD_WORDS, side="right")) - 1)
        groups.append((int(first[a]), int(first[b]), b - a))
        a = b
    for lo, hi, n_docs in groups:
        ranges = [(lo, hi)] if n_docs > 1 else [(lo + x, lo + y) for x, y in shard_ranges(hi - lo, 2 * SHARD_WORDS, WINDOW - 1)]
        for x, y in ranges:
            if y == x:
                continue
            end = np.zeros(y - x, bool)
            border = first[(first > x) & (first <= y)] - 1 - x
            end[border] = True
            index = FMIndex(h[x:y], end)
            which, r0, r1 = index.search(phrases)
            if len(which) == 0:
                continue
            size = r1 - r0
            rows = np.repeat(r0, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            found_at.append(index.word_at[index.locate(rows)] + x)
            found.append(np.repeat(which, size))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, ph = np.concatenate(found_at), np.concatenate(found)
    # exact check of the bytes: equal hashes are not yet equal words
    size = phrases.length[ph]
    gap_free = np.array([
        all(low[s[i + j]:e[i + j]].tobytes() == w for j, w in enumerate(phrases.keys[p]))
        for i, p in zip(at, ph)], bool) if len(at) <= 20_000 else _same_bytes(phrases, low, s, e, at, ph, size)
    return at[gap_free], ph[gap_free]


def _same_bytes(phrases, low, s, e, at, ph, size):
    """The exact check, once per distinct pair of phrase and word bytes."""
    seen: dict[tuple[int, bytes], bool] = {}
    out = np.empty(len(at), bool)
    for k, (i, p, n) in enumerate(zip(at, ph, size)):
        key = (int(p), low[s[i]:e[i + n - 1]].tobytes())
        if key not in seen:
            seen[key] = all(low[s[i + j]:e[i + j]].tobytes() == w for j, w in enumerate(phrases.keys[p]))
        out[k] = seen[key]
    return out


OUT = "n_words long, spans array<struct<word_from:int,word_to:int,byte_from:int,byte_to:int>>, items array<string>"


def find_spans(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
               item_id: str = "item_id", item_text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Every document of ``docs`` with the word and byte spans that phrases of
    ``items`` cover (merged where they overlap or touch), the sorted items
    found and the number of words.  ``keep`` names further columns of ``docs``
    to carry along, as ``__k0``, ``__k1``... beside the id as ``__doc_id``, so
    no name clashes."""
    spark = docs.sparkSession
    bounded_batches(spark)
    keep = keep or []
    rows = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("i"), F.col(item_text).cast("string").alias("t")) \
        .where(F.col("t").isNotNull())
    blocks = _blocks(rows)
    out = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text"), *[F.col(c).alias(f"__k{i}") for i, c in enumerate(keep)],
                      F.expr("cast(array() as array<struct<b:int,n:int>>)").alias("__hit"),
                      F.expr("cast(array() as array<string>)").alias("__items"))
    for k, block in enumerate(blocks):
        sent = spark.sparkContext.broadcast(block)
        last = k == len(blocks) - 1
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema if last is False or f.name not in ("__text", "__hit", "__items"))
        out = out.mapInArrow(_searcher(sent, last), schema + (", " + OUT if last else ""))
    return out.withColumnsRenamed({"__id": doc_id}) if not keep else out.withColumnRenamed("__id", "__doc_id")


def _blocks(rows: DataFrame) -> list[list[tuple[str, str]]]:
    """The items in blocks of at most BLOCK_BYTES (one block at least); each
    block is fetched on its own, so the driver holds one block's source rows
    at a time beside the blocks' own broadcasts."""
    total = rows.agg(F.sum(F.octet_length("t") + F.octet_length("i") + 16)).first()[0] or 0
    n = int(total // BLOCK_BYTES) + 1
    if n == 1:
        return [[(r.i, r.t) for r in rows.collect()]]
    part = rows.withColumn("b", F.pmod(F.xxhash64("i", "t"), F.lit(n)))
    return [[(r.i, r.t) for r in part.where(F.col("b") == k).collect()] for k in range(n)]


_cache: dict[int, Phrases] = {}


def _searcher(sent, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = sent._jbroadcast.id() if getattr(sent, "_jbroadcast", None) else id(sent)
        if key not in _cache:
            _cache.clear()
            _cache[key] = Phrases(sent.value)
        phrases = _cache[key]
        for batch in batches:
            buf, off = A.byte_buffer(batch.column("__text"))
            for a, b in A.pieces(off, PIECE_BYTES):
                part = batch.slice(a, b - a)
                piece, po = buf[off[a]:off[b]], off[a:b + 1] - off[a]
                low, s, e, h = words_of(piece, po)
                counts = A.counts_per_doc(s, po)
                at, ph = _hits(phrases, low, s, e, h, counts) if len(phrases.keys) else (np.zeros(0, np.int64),) * 2
                yield _answer(part, phrases, at, ph, s, e, counts, po, last)

    return run


def _answer(part, phrases, at, ph, s, e, counts, po, last):
    first = np.r_[0, np.cumsum(counts)]
    doc = np.searchsorted(first, at, side="right") - 1
    by_doc: dict[int, list[tuple[int, int]]] = {}
    items: dict[int, set[str]] = {}
    for d, i, p in zip(doc.tolist(), at.tolist(), ph.tolist()):
        by_doc.setdefault(d, []).append((i - int(first[d]), int(phrases.length[p])))
        items.setdefault(d, set()).update(phrases.items[p])
    old_hit, old_items = part.column("__hit"), part.column("__items")
    spans_out, items_out, hits_out = [], [], []
    for d in range(part.num_rows):
        hits = by_doc.get(d, []) + [(x["b"], x["n"]) for x in old_hit[d].as_py()]
        names = sorted(items.get(d, set()) | set(old_items[d].as_py()))
        items_out.append(names)
        if not last:
            hits_out.append([{"b": b, "n": n} for b, n in sorted(set(hits))])
            continue
        merged: list[list[int]] = []
        for b, n in sorted(set(hits)):
            if merged and b <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b + n)
            else:
                merged.append([b, b + n])
        f = int(first[d])
        spans_out.append([{"word_from": b, "word_to": t, "byte_from": int(s[f + b] - po[d]), "byte_to": int(e[f + t - 1] - po[d])}
                          for b, t in merged])
    names = [n for n in part.schema.names if n not in ("__text", "__hit", "__items")]
    if not last:
        cols = [part.column(n) for n in names[:1]] + [part.column("__text")] + [part.column(n) for n in names[1:]]
        hit_type = pa.list_(pa.struct([("b", pa.int32()), ("n", pa.int32())]))
        return pa.RecordBatch.from_arrays(cols + [pa.array(hits_out, hit_type), pa.array(items_out, pa.list_(pa.string()))],
                                          names=part.schema.names)
    span_type = pa.list_(pa.struct([(n, pa.int32()) for n in ("word_from", "word_to", "byte_from", "byte_to")]))
    return pa.RecordBatch.from_arrays(
        [part.column(n) for n in names] + [pa.array(counts, pa.int64()), pa.array(spans_out, span_type),
                                           pa.array(items_out, pa.list_(pa.string()))],
        names=names + ["n_words", "spans", "items"])


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The digest of ``find_spans``: hit words, items and their checksum."""
    found = find_spans(docs, items)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + x["word_to"] - x["word_from"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (n_hit > 0).alias("contaminated"))


def remove_spans(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the spans of benchmark phrases cut out of the text;
    documents without a hit, and null texts, stay as they are."""
    cols = docs.columns
    found = find_spans(docs, items, text=text, keep=cols)
    own = {c: F.col(f"__k{i}") for i, c in enumerate(cols)}
    raw = own[text].cast("binary")
    bounds = F.concat(F.array(F.lit(0)), F.flatten(F.transform("spans", lambda x: F.array(x["byte_from"], x["byte_to"]))),
                      F.array(F.octet_length(own[text])))
    kept = F.transform(F.sequence(F.lit(0), F.size("spans")),
                       lambda i: F.substring(raw, F.element_at(bounds, 2 * i + 1) + 1,
                                             F.element_at(bounds, 2 * i + 2) - F.element_at(bounds, 2 * i + 1)).cast("string"))
    cut = F.when(F.size("spans") > 0, F.concat_ws(" ", F.filter(F.transform(kept, lambda x: F.btrim(x)), lambda x: x != ""))).otherwise(own[text])
    return found.select(*[cut.alias(c) if c == text else own[c].alias(c) for c in cols])
