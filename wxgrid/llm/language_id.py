"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1.  A letter 3-gram binds
its letters, each permuted by its place; a document bundles (adds) the vectors
of its 3-grams, a language bundles the unit vectors of its training documents.
A document gets the language whose prototype has the largest cosine with it.

Prototypes gather one partial sum per task and language; the documents' own
vectors never leave their task.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
training rows with a null language, or without a letter, teach nothing; without
prototypes everything is ``und``; equal cosines go to the smaller name;
repeated rows are answered alike; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrowtext as A
from .common import bounded_batches, held_out

DIM = 1024
SEED = 20_231
GROUP_DOCS = 128
GROUP_BYTES = 400_000
GRAM_BLOCK = 16_384


@cache
def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=GRAM_BLOCK)
def letter_vector(code: int) -> np.ndarray:
    if code == 32:
        code = 0x110000
    return (np.random.Generator(np.random.PCG64([SEED, code])).integers(0, 2, DIM, dtype=np.int8) * 2 - 1).astype(np.int8)


def trigrams(raw: bytes, offsets: np.ndarray):
    """(document, place in the list of letters, three ways; the letters) of
    every 3-gram over the lower-cased letters of each text; runs of anything
    else read as one border."""
    texts = [" " + raw[a:b].decode("utf-8", "replace").lower() + " " for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    sym = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), size)
    letter = letter_table()[sym]
    sym = np.where(letter, sym, 32)
    first = np.ones(len(sym), bool)
    first[1:] = doc[1:] != doc[:-1]
    keep = letter | first
    keep[1:] |= letter[:-1] & ~first[1:]
    sym, doc = sym[keep], doc[keep]
    seen = np.zeros(0x110000, bool)
    seen[sym] = True
    letters = np.flatnonzero(seen)
    place = np.zeros(0x110000, np.int64)
    place[letters] = np.arange(len(letters))
    at = place[sym]
    ok = doc[2:] == doc[:-2]
    return doc[2:][ok], at[:-2][ok], at[1:-1][ok], at[2:][ok], letters


def bundles(raw: bytes, offsets: np.ndarray) -> np.ndarray:
    """Document vectors (documents by DIM), zero where there is no letter."""
    n = len(offsets) - 1
    doc, a, b, c, letters = trigrams(raw, offsets)
    if len(doc) == 0:
        return np.zeros((n, DIM), np.float32)
    k = len(letters)
    code = (a * k + b) * k + c
    if k ** 3 <= 1 << 24:  # a table of all possible 3-grams
        grams = np.flatnonzero(np.bincount(code, minlength=k ** 3))
        number = np.zeros(k ** 3, np.int64)
        number[grams] = np.arange(len(grams))
        which = number[code]
    else:
        grams, which = np.unique(code, return_inverse=True)
    # a block of 3-grams at a time, as there may be as many as letters in a text;
    # sums of whole numbers, so blocks change nothing
    out = np.zeros((n, DIM), np.float32)
    order = np.argsort(which, kind="stable") if len(grams) > GRAM_BLOCK else slice(None)
    doc, which = doc[order].astype(np.int64), which[order]
    for start in range(0, len(grams), GRAM_BLOCK):
        some = grams[start:start + GRAM_BLOCK]
        x, y = np.searchsorted(which, [start, start + len(some)]) if len(grams) > GRAM_BLOCK else (0, len(which))
        counts = np.bincount(doc[x:y] * len(some) + which[x:y] - start, minlength=n * len(some)).reshape(n, len(some))
        out += counts.astype(np.float32) @ _bound(some // (k * k), some // k % k, some % k, letters)
    return out


def _bound(first: np.ndarray, second: np.ndarray, third: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Vectors of 3-grams given by the places of their letters."""
    used, at = np.unique(np.concatenate([first, second, third]), return_inverse=True)
    a, b, c = at.reshape(3, -1)
    vec = np.stack([letter_vector(int(x)) for x in letters[used]])
    return (np.roll(vec, 2, axis=1)[a] * np.roll(vec, 1, axis=1)[b] * vec[c]).astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def _groups(col: pa.Array) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    buf, off = A.byte_buffer(col)
    for a, b in A.pieces(off, GROUP_BYTES):
        for x in range(a, b, GROUP_DOCS):
            y = min(x + GROUP_DOCS, b)
            yield x, y, buf[off[x]:off[y]].tobytes(), off[x:y + 1] - off[x]


def _partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        lang = np.array(batch.column("lang").to_pylist(), object)
        for a, b, raw, off in _groups(batch.column("text")):
            v = _unit(bundles(raw, off)).astype(np.float64)
            for name in set(lang[a:b]):
                total[name] = total.get(name, 0) + v[lang[a:b] == name].sum(axis=0)
    for name in sorted(total):
        yield pa.RecordBatch.from_arrays([pa.array([name] * DIM), pa.array(range(DIM), pa.int32()), pa.array(total[name])],
                                         names=["lang", "dim", "x"])


def prototypes(rows: DataFrame) -> tuple[list[str], np.ndarray]:
    """Names and unit prototypes, learned from (text, lang): one sum per
    language and dimension comes to the driver."""
    bounded_batches(rows.sparkSession)
    some = rows.where("lang is not null and text is not null").select("text", F.col("lang").cast("string").alias("lang"))
    sums = some.mapInArrow(_partial_sums, "lang string, dim int, x double").groupBy("lang", "dim").agg(F.sum("x").alias("x"))
    got = sums.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("dim", "x"))).alias("v")).select("lang", "v.x").collect()
    got = sorted((r.lang, np.array(r.x)) for r in got)
    got = [(name, v) for name, v in got if np.abs(v).sum() > 0]
    return [name for name, _ in got], _unit(np.stack([v for _, v in got])) if got else np.zeros((0, DIM))


def identify(docs: DataFrame, names: list[str], vectors: np.ndarray, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: all) with ``lang_pred`` and
    its cosine ``score``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    keep = docs.columns if keep is None else keep
    rows = docs.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(keep)], F.col(text).alias("__text"))
    cols = [f"__k{i}" for i in range(len(keep))]
    sent = spark.sparkContext.broadcast((names, vectors.astype(np.float32)))  # languages x DIM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, proto = sent.value
        for batch in batches:
            pred, score = [], []
            for a, b, raw, off in _groups(batch.column("__text")):
                v = bundles(raw, off)
                some = np.abs(v).sum(axis=1) > 0
                if not langs:
                    some[:] = False
                cos = _unit(v) @ proto.T if langs else np.zeros((b - a, 1))
                best = cos.argmax(axis=1)
                pred += [langs[k] if s else "und" for k, s in zip(best.tolist(), some.tolist())]
                score.append(np.where(some, np.clip(cos.max(axis=1), 0, 1), 0.0))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in cols], pa.array(pred, pa.string()),
                                              pa.array(np.concatenate(score).astype(float) if score else np.zeros(0))], names=[*cols, "lang_pred", "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__text")
    return rows.mapInArrow(run, schema + ", lang_pred string, score double").withColumnsRenamed({c: k for c, k in zip(cols, keep)})


def report(docs: DataFrame) -> DataFrame:
    names, vectors = prototypes(docs.where(~held_out("doc_id")).select("text", "lang"))
    out = identify(docs, names, vectors, keep=["doc_id"])
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
