"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over ``WINDOW`` bytes cuts every text where its low bits are
zero, so equal passages are cut alike wherever they stand.  Documents are
brought together and sorted by their smallest chunk hash: texts that share
chunks meet in one task (Spark splits a partition that grows too large), and a
chunk that occurs again there is encoded once.

A chunk keeps the encoding of its inside: from its first to its last white
space.  At each join the bytes between the last white space before the cut and
the first one after it are encoded anew; the window grows over chunks without
white space until both sides agree.  They agree there exactly: white space is
never part of a pre-token, normalisation does not compose across it, and no
special token contains it, so an encoding starts afresh at every white space.

Inside a task the words of plain Latin-1 text (pre-tokens of letters, single
digits, or other marks) are found with numpy, encoded by the tokenizers
library once per worker and remembered by 64-bit hash, up to ``MEMO`` words;
every other text goes through the library as it is.

Defined cases: null and empty texts have no tokens; bytes that are not UTF-8
read as U+FFFD; repeated rows each get their row; other columns are only
carried when named.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrowtext as A
from .common import bounded_batches
from .toxicity import fold

WINDOW = 16
CUT_BITS = 10  # a cut every 1024 bytes on average
CUT_GAP = 64  # of cuts closer than this only the first counts
MEMO = 2_500_000
PIECE_BYTES = 1_000_000
SPACES = b" \t\n\r"



def chunk_ends(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sorted ends of all chunks: content-defined cuts and document ends."""
    ends = offsets[1:][np.diff(offsets) > 0]
    n = len(buf)
    if n <= WINDOW:
        return ends
    pw, inv = A.powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * pw, out=total[1:])
    h = (total[WINDOW:] - total[:-WINDOW]) * inv[:n - WINDOW + 1]
    cut = np.flatnonzero(((h * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - CUT_BITS)) == 0) + WINDOW
    doc = np.searchsorted(offsets, cut, side="left") - 1  # document of the window's last byte
    inside = cut - WINDOW >= offsets[doc]
    cut, doc = cut[inside], doc[inside]
    first = np.ones(len(cut), bool)
    first[1:] = (np.diff(cut) >= CUT_GAP) | (doc[1:] != doc[:-1])
    cut = cut[first]
    for _ in range(3):  # on to the start of a character
        part = (cut < n) & ((buf[np.minimum(cut, n - 1)] & 0xC0) == 0x80)
        cut = np.where(part, cut + 1, cut)
    return np.unique(np.concatenate([cut, ends]))


def chunks(buf: np.ndarray, offsets: np.ndarray):
    """(starts, ends, hashes, chunks per document)."""
    ends = chunk_ends(buf, offsets)
    starts = np.r_[0, ends[:-1]] if len(ends) else ends
    return starts, ends, A.segment_hashes(buf, starts, ends), A.counts_per_doc(starts, offsets)


class Words:
    """Encodings of plain words by 64-bit word hash: a sorted table and a small
    sorted table of recent words, both pointing into one array of ids."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        none = np.zeros(0, np.int64)
        self.old = self.new = (np.zeros(0, np.uint64), none, none)  # keys, offsets, lengths
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0

    def __len__(self) -> int:
        return len(self.old[0]) + len(self.new[0])

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Offset (-1: unknown) and length of each key."""
        at, size = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        for table, offs, lens in (self.old, self.new):
            if len(table):
                i = np.minimum(np.searchsorted(table, keys), len(table) - 1)
                hit = table[i] == keys
                at[hit], size[hit] = offs[i[hit]], lens[i[hit]]
        return at, size

    def add(self, keys: np.ndarray, ids: np.ndarray, lens: np.ndarray) -> None:
        """Enter sorted new keys with their ids one after the other."""
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[:self.used], np.zeros(self.used + len(ids) + (1 << 16), np.uint32)])
        self.ids[self.used:self.used + len(ids)] = ids
        offs = self.used + np.cumsum(lens) - lens
        self.used += len(ids)
        self.new = self._merge(self.new, (keys, offs, lens))
        if len(self.new[0]) > 100_000:
            self.old, self.new = self._merge(self.old, self.new), (keys[:0], offs[:0], lens[:0])

    @staticmethod
    def _merge(x, y):
        keys = np.concatenate([x[0], y[0]])
        order = np.argsort(keys)
        return keys[order], np.concatenate([x[1], y[1]])[order], np.concatenate([x[2], y[2]])[order]


#: Classes of bytes in plain text: 0 white space, 1 letter, 2 digit, 3 other,
#: 9 not plain.  0xC3 and what follows it are classed by ``classes``.
_CLASS = np.full(256, 9, np.uint8)
_CLASS[[9, 10, 13, 32]] = 0
_CLASS[0x21:0x7F] = 3
_CLASS[0x30:0x3A] = 2
_CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = 1


def classes(buf: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Class of each byte.  ``starts``: where the (non-empty) texts start."""
    c = _CLASS[buf]
    lead = np.flatnonzero(buf == 0xC3)
    lead = lead[lead + 1 < len(buf)]
    nxt = buf[lead + 1]
    two = np.where((nxt == 0x97) | (nxt == 0xB7), 3, 1)
    ok = (nxt >= 0x80) & (nxt <= 0xBF)
    c[lead[ok]], c[lead[ok] + 1] = two[ok], two[ok]
    # a contraction ('s, 'll) or a special token makes a text not plain
    quote = np.flatnonzero(buf == 0x27)
    quote = quote[quote + 1 < len(buf)]
    c[quote[_CLASS[buf[quote + 1]] == 1]] = 9
    angle = np.flatnonzero(buf == 0x3C)
    angle = angle[angle + 1 < len(buf)]
    c[angle[buf[angle + 1] == 0x7C]] = 9
    return c


class Encoder:
    """The tokenizer of one worker, with its remembered words."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_str(spec)
        self.lib.no_truncation()
        self.lib.no_padding()
        size = max(self.lib.get_vocab(with_added_tokens=True).values()) + 1
        self.tokens = [self.lib.id_to_token(i) or "" for i in range(size)]
        self.decimal = [str(i) for i in range(size)]
        self.ends = np.array([t.endswith("</w>") for t in self.tokens], bool)
        self.words = Words()

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.lib.encode(text, add_special_tokens=False).ids, np.uint32)

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        """Encode new words, many in one call; each is one pre-token, whose
        encoding ends with the only token that has the word end."""
        ids, lens = [], []
        for a in range(0, len(words), 4000):
            part = words[a:a + 4000]
            got = np.array(self.lib.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.uint32)
            size = np.diff(np.flatnonzero(self.ends[got]) + 1, prepend=0)
            if len(size) != len(part) or size.sum() != len(got):
                each = [self._whole(w) for w in part]
                got, size = np.concatenate(each), np.array([len(x) for x in each])
            ids.append(got)
            lens.append(size)
        self.words.add(keys, np.concatenate(ids), np.concatenate(lens))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Token ids (as uint32 bytes) of each text, none of which is empty."""
        raw = b"".join(texts)
        buf = np.frombuffer(raw, np.uint8)
        edge = np.r_[0, np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))]
        c = classes(buf, edge[:-1])
        odd = np.maximum.reduceat(c, edge[:-1]) == 9 if len(texts) else np.zeros(0, bool)
        out: list[bytes] = [b""] * len(texts)
        for i in np.flatnonzero(odd).tolist():
            out[i] = self._whole(texts[i].decode("utf-8", "replace")).tobytes()
        c[np.repeat(odd, np.diff(edge))] = 0
        start = np.ones(len(c), bool)
        start[1:] = (c[1:] != c[:-1]) | (c[1:] == 2)
        start[edge[:-1]] = True
        bounds = np.flatnonzero(start)
        word = c[bounds] != 0
        starts, ends = bounds[word], np.append(bounds[1:], len(c))[word]
        low = fold(buf)
        hashes = A.segment_hashes(low, starts, ends)
        keys, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        at, size = self.words.find(keys)
        if (at < 0).any():
            if len(self.words) + int((at < 0).sum()) > MEMO:
                self.words.clear()
                at[:] = -1
            new = at < 0
            text, s, e = low.tobytes(), starts[first[new]].tolist(), ends[first[new]].tolist()
            self._learn(keys[new], [text[x:y].decode() for x, y in zip(s, e)])
            at, size = self.words.find(keys)
        at, size = at[which], size[which]
        total = np.cumsum(size)
        ids = self.words.ids[np.repeat(at - (total - size), size) + np.arange(total[-1] if len(total) else 0)].tobytes()
        cut = np.r_[0, total][np.searchsorted(starts, edge)] * 4
        for i, (x, y) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist())):
            if y > x:
                out[i] = ids[x:y]
        return out

    def digests(self, ids: bytes) -> tuple[int, str, str]:
        """(tokens, checksum of the ids, checksum of the decoded text)."""
        seq = np.frombuffer(ids, np.uint32).tolist()
        dec, tok = self.decimal, self.tokens
        return (len(seq), hashlib.sha256(" ".join([dec[i] for i in seq]).encode()).hexdigest(),
                hashlib.sha256(" ".join([tok[i] for i in seq]).encode("utf-8")).hexdigest())


def encode_documents(encoder: Encoder, buf: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """Ids of every document: chunk insides once per distinct chunk, then the
    windows over the joins, then everything in order."""
    starts, ends, hashes, counts = chunks(buf, offsets)
    raw = buf.tobytes()
    inside_of: dict[bytes, int] = {}  # distinct chunk -> its number
    todo: list[bytes] = []
    again = _repeated(hashes)
    order: list[int] = []  # per document: numbers into todo
    edge, k = [0], 0
    for n in counts.tolist():
        seam = b""
        for j in range(k, k + n):
            chunk = raw[starts[j]:ends[j]]
            first, last = _space_span(chunk)
            if first < 0:
                seam += chunk
                continue
            seam += chunk[:first]
            if seam:
                order.append(len(todo))
                todo.append(seam)
            if last > first:
                body = chunk[first:last]
                at = inside_of.get(chunk, -1) if again[j] else -1
                if at < 0:
                    at = len(todo)
                    todo.append(body)
                    if again[j]:
                        inside_of[chunk] = at
                order.append(at)
            seam = chunk[last:]
        if seam:
            order.append(len(todo))
            todo.append(seam)
        k += n
        edge.append(len(order))
    coded = encoder.encode(todo)
    return [b"".join([coded[i] for i in order[a:b]]) for a, b in zip(edge, edge[1:])]


_SPACE = re.compile(rb"[ \t\n\r]")


def _space_span(chunk: bytes) -> tuple[int, int]:
    """First white space and the position after the last; (-1, -1) if none."""
    m = _SPACE.search(chunk)
    if not m:
        return -1, -1
    return m.start(), max(chunk.rfind(bytes([c])) for c in SPACES) + 1


def _repeated(hashes: np.ndarray) -> np.ndarray:
    _, inverse, n = np.unique(hashes, return_inverse=True, return_counts=True)
    return n[inverse] > 1 if len(hashes) else np.zeros(0, bool)


def together(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` dealt and sorted by the smallest chunk hash (``__anchor``)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    names = docs.columns
    plain = docs.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(names)])
    at = f"__k{names.index(text)}"
    fields = plain.schema.fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = A.byte_buffer(batch.column(at))
            for a, b in A.pieces(off, PIECE_BYTES):
                _, _, h, counts = chunks(buf[off[a]:off[b]], off[a:b + 1] - off[a])
                anchor = np.zeros(b - a, np.int64)
                some = counts > 0
                if some.any():
                    anchor[some] = np.minimum.reduceat(h, (np.cumsum(counts) - counts)[some]).view(np.int64)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(anchor)], names=[*part.schema.names, "__anchor"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    rows = plain.mapInArrow(run, schema + ", __anchor long")
    dealt = spark.sql("SELECT /*+ REBALANCE(__anchor) */ * FROM {rows}", rows=rows)
    return dealt.sortWithinPartitions("__anchor").withColumnsRenamed({f"__k{i}": c for i, c in enumerate(names)})


def encode(docs: DataFrame, tokenizer: str, *, text: str = "text", keep: list[str] | None = None, ids: bool = False) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: all but the text) with
    ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, if asked for, the
    ``token_ids`` themselves; these take the place of columns of their names.
    ``tokenizer``: path of a tokenizers file."""
    spark = docs.sparkSession
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    keep = [c for c in keep if c.lower() not in (*OUT, *["token_ids"] * ids)]
    with open(tokenizer, encoding="utf-8") as f:
        sent = spark.sparkContext.broadcast(f.read())  # one vocabulary file of fixed size
    rows = together(docs.select(*[F.col(c).alias(f"__c{i}") for i, c in enumerate(keep)], F.col(text).alias("__text")), "__text")
    names = [f"__c{i}" for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(sent)
        for batch in batches:
            buf, off = A.byte_buffer(batch.column("__text"))
            for a, b in A.pieces(off, PIECE_BYTES):
                coded = encode_documents(encoder, buf[off[a]:off[b]], off[a:b + 1] - off[a])
                n, x, y = zip(*map(encoder.digests, coded))
                part = batch.slice(a, b - a)
                cols = [part.column(c) for c in names] + [pa.array(n, pa.int64()), pa.array(x), pa.array(y)]
                if ids:
                    flat = np.frombuffer(b"".join(coded), np.uint32).astype(np.int32)
                    edge = np.r_[0, np.cumsum(n)].astype(np.int32)
                    cols.append(pa.ListArray.from_arrays(pa.array(edge), pa.array(flat)))
                yield pa.RecordBatch.from_arrays(cols, names=[*names, *OUT, *["token_ids"] * ids])

    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names)
    schema = ", ".join(filter(None, [schema, "n_tokens long, ids_sha256 string, decoded_sha256 string", "token_ids array<int>" * ids]))
    return rows.mapInArrow(run, schema).withColumnsRenamed({f"__c{i}": c for i, c in enumerate(keep)})


OUT = ("n_tokens", "ids_sha256", "decoded_sha256")
_encoders: dict[str, Encoder] = {}


def _encoder(sent) -> Encoder:
    """One encoder per worker, kept over its tasks."""
    spec = sent.value
    key = hashlib.md5(spec.encode()).hexdigest()
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(spec)
    return _encoders[key]


def report(docs: DataFrame, tokenizer: str) -> DataFrame:
    return encode(docs, tokenizer, keep=["doc_id"])
