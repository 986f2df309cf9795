"""Toxic spans with a linear-chain conditional random field.

A document is a row of chains of at most ``CHAIN`` words.  A word's emission
is the sum of hashed weights of the word itself and of its character 4- and
5-grams (with the border to its neighbours), so inflected forms share weight.
Forward and backward messages of all chains of a piece run as one array
program; they give each word's marginal and the probability that a chain has
no toxic word.  A document's score is a logistic function of the log-odds that
some word is toxic and of the expected number of toxic words; offending
offsets are the byte ranges of neighbouring words whose marginal is at least
one half.

Training uses a bounded sample: at most ``MAX_TOXIC`` and ``MAX_CLEAN``
labelled rows outside the held-out fold, chosen by the hash of their id, with
texts of at most ``MAX_FIT_BYTES``.  Labels name documents, so tokens are
labelled first: a token of a toxic document is toxic when one of its features
stands in toxic documents significantly more often than chance (binomial
deviance, corrected for the number of features) and in nearly no clean one.
Four fifths of the sample fit the field, the rest fit the document scores.

Defined cases: null and empty texts have no words and get the score of a
document without toxic evidence; without a toxic or a clean labelled row every
score is 0; labels that are null or not 0/1 are left out; repeated rows are
scored alike; other columns are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrowtext as A
from .common import bounded_batches, held_out

CHAIN = 64
BITS = 19
MAX_TOXIC, MAX_CLEAN = 1200, 2800
MAX_FIT_BYTES = 32_000
FIT_PIECE_BYTES = 500_000
ROUNDS = 50
_C4, _C5, _CW = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_SHIFT = np.uint64(64 - BITS)

WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[0x30:0x3A] = WORD_BYTE[0x41:0x5B] = WORD_BYTE[0x61:0x7B] = WORD_BYTE[0x80:] = True


def fold(buf: np.ndarray) -> np.ndarray:
    """Lower-case A-Z and the Latin-1 capitals without moving a byte."""
    low = A.LOWER[buf]
    if len(low) > 1:
        second = np.flatnonzero(low[:-1] == 0xC3) + 1
        b = low[second]
        low[second] = np.where((b >= 0x80) & (b <= 0x9E) & (b != 0x97), b + 0x20, b)
    return low


class Tokens:
    """Words of a piece of documents and their hashed features."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray):
        low = fold(buf)
        self.starts, self.ends = A.word_spans(WORD_BYTE[low], offsets)
        self.counts = A.counts_per_doc(self.starts, offsets)
        self.hash = A.segment_hashes(low, self.starts, self.ends)
        # one border byte around every document, a space for every other byte
        n_docs = len(offsets) - 1
        shift = np.repeat(np.arange(1, n_docs + 1), np.diff(offsets))
        self.padded = np.full(len(low) + n_docs + 9, 32, np.uint8)
        self.padded[np.arange(len(low)) + shift] = np.where(WORD_BYTE[low], low, 32)
        move = np.repeat(np.arange(1, n_docs + 1), self.counts)
        self.a, self.b = self.starts + move - 1, self.ends + move + 1  # with both borders

    def grams(self, n: int) -> np.ndarray:
        """Feature of the n bytes from each position."""
        size = len(self.padded) - 8
        if n == 4:
            v = np.ndarray(size, "<u4", self.padded, 0, (1,)).astype(np.uint64)
            return ((v * _C4) >> _SHIFT).astype(np.int32)
        v = np.ndarray(size, "<u8", self.padded, 0, (1,)) & np.uint64(0xFFFFFFFFFF)
        return ((v * _C5) >> _SHIFT).astype(np.int32)

    def word_feature(self) -> np.ndarray:
        return ((self.hash * _CW) >> _SHIFT).astype(np.int32)

    def emissions(self, weights: np.ndarray) -> np.ndarray:
        out = weights[self.word_feature()].astype(np.float64)
        for n in (4, 5):
            total = np.zeros(len(self.padded) - 7)
            np.cumsum(weights[self.grams(n)], out=total[1:])
            last = self.b - n + 1  # past the last gram of the word
            out += np.where(last > self.a, total[np.maximum(last, self.a)] - total[self.a], 0.0)
        return out

    def distinct(self) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Hashes of the distinct words, sorted, and for each kind of feature
        (word, 4-grams, 5-grams) all words' features and their number by word."""
        words, first = np.unique(self.hash, return_index=True)
        kinds = [(self.word_feature()[first], np.ones(len(first), np.int64))]
        for n in (4, 5):
            size = np.maximum(self.b[first] - n + 1 - self.a[first], 0)
            kinds.append((self.grams(n)[_ranges(self.a[first], size)], size))
        return words, kinds


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All positions of the ranges, one range after the other."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


class Sample:
    """Words of the texts to learn from and their features, read a piece of
    texts at a time: only hashes and the distinct words' features stay."""

    def __init__(self, texts: list[str]):
        self.buf, self.off = A.byte_buffer(pa.array(texts, pa.large_string()))
        self.counts, self.hash = (np.concatenate(x) for x in zip(*((t.counts, t.hash) for t in self.pieces())))

    def pieces(self) -> Iterator[Tokens]:
        for a, b in list(A.pieces(self.off, FIT_PIECE_BYTES)) or [(0, 0)]:
            yield Tokens(self.buf[self.off[a]:self.off[b]], self.off[a:b + 1] - self.off[a])

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word of each token, feature list, word of each feature entry)."""
        words, kinds = zip(*(t.distinct() for t in self.pieces()))
        words, first = np.unique(np.concatenate(words), return_index=True)
        feats, owner = [], []
        for kind in zip(*kinds):
            values, size = (np.concatenate(x) for x in zip(*kind))
            start, size = (np.cumsum(size) - size)[first], size[first]
            feats.append(values[_ranges(start, size)])
            owner.append(np.repeat(np.arange(len(words)), size))
        return np.searchsorted(words, self.hash), np.concatenate(feats), np.concatenate(owner)


class Chains:
    """Tokens laid out as chains: a matrix of steps by chains."""

    def __init__(self, counts: np.ndarray):
        per_doc = -(-counts // CHAIN)
        self.n = int(per_doc.sum())
        first_chain = np.cumsum(per_doc) - per_doc
        first_token = np.cumsum(counts) - counts
        within = np.arange(int(counts.sum())) - np.repeat(first_token, counts)
        self.chain = np.repeat(first_chain, counts) + within // CHAIN
        self.step = within % CHAIN
        self.doc = np.repeat(np.arange(len(counts)), per_doc)
        self.length = np.bincount(self.chain, minlength=self.n)

    def spread(self, values: np.ndarray, fill: float) -> np.ndarray:
        out = np.full((CHAIN, self.n), fill)
        out[self.step, self.chain] = values
        return out


def messages(score: np.ndarray, chains: Chains, trans: np.ndarray):
    """(marginals per token, log probability of no toxic word per chain,
    expected transition counts 01, 10, 11 per step matrix).  ``score``: the
    emission log-odds of each token; ``trans``: log weights of 0-1, 1-0, 1-1
    against 0-0."""
    t01, t10, t11 = np.exp(trans)
    e = np.exp(np.clip(chains.spread(score, -60.0), -60, 30))  # steps past a chain's end stay clean
    fwd = np.empty_like(e)
    bwd = np.ones_like(e)
    a = e[0]
    fwd[0] = a
    for t in range(1, CHAIN):
        a = e[t] * (t01 + a * t11) / (1 + a * t10)
        fwd[t] = a
    b = bwd[-1]
    live = np.arange(CHAIN)[:, None] < chains.length[None, :]
    clean = np.zeros(chains.n)
    for t in range(CHAIN - 2, -1, -1):
        x = e[t + 1] * b
        stay = 1 + t01 * x
        clean -= np.where(live[t + 1], np.log(stay), 0.0)
        b = np.where(live[t + 1], (t10 + t11 * x) / stay, 1.0) if t01 or t11 else b
        bwd[t] = b
    odds = fwd * bwd
    clean -= np.log1p(e[0] * bwd[0])
    return odds, clean, (e, fwd, bwd, live)


def expected_transitions(parts, trans) -> np.ndarray:
    e, fwd, bwd, live = parts
    t01, t10, t11 = np.exp(trans)
    x = e[1:] * bwd[1:]
    w01, w10, w11 = t01 * x, fwd[:-1] * t10, fwd[:-1] * t11 * x
    z = 1 + w01
    z += w10
    z += w11
    m = live[1:]
    return np.array([(w01 / z)[m].sum(), (w10 / z)[m].sum(), (w11 / z)[m].sum()])


@dataclass
class Model:
    weights: np.ndarray  # float32 per hashed feature
    bias: float
    trans: np.ndarray
    doc: np.ndarray  # intercept and two slopes of the document score

    def evidence(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """(marginals per token, the two document features)."""
        n = len(tokens.counts)
        if len(tokens.hash) == 0:
            return np.zeros(0), document_features(np.zeros(n), np.zeros(n))
        chains = Chains(tokens.counts)
        odds, clean, _ = messages(tokens.emissions(self.weights) + self.bias, chains, self.trans)
        p = odds / (1 + odds)
        p = p[chains.step, chains.chain]
        token_doc = np.repeat(np.arange(n), tokens.counts)
        return p, document_features(np.bincount(chains.doc, clean, n), np.bincount(token_doc, p, n))

    def score(self, features: np.ndarray) -> np.ndarray:
        z = self.doc[0] + features @ self.doc[1:]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def document_features(log_clean: np.ndarray, expected: np.ndarray) -> np.ndarray:
    any_toxic = np.clip(np.log(np.maximum(np.expm1(np.maximum(-log_clean, 0)), 1e-12)), -12, 12)
    return np.stack([any_toxic, np.log1p(expected)], axis=1)


def token_labels(tokens: Sample, word, feats, owner, toxic: np.ndarray) -> np.ndarray:
    """1 for tokens of toxic documents that carry a significant feature."""
    order = np.argsort(owner, kind="stable")
    feats, owner = feats[order], owner[order]
    edge = np.searchsorted(owner, np.arange(owner[-1] + 2))
    seen = np.zeros((2, 1 << BITS))
    at = np.r_[0, np.cumsum(tokens.counts)]
    for d, y in enumerate(toxic):
        own = np.unique(word[at[d]:at[d + 1]])
        if len(own):
            size = edge[own + 1] - edge[own]
            idx = np.repeat(edge[own] - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
            seen[y, np.unique(feats[idx])] += 1
    clean, bad = seen
    share = toxic.mean()
    m = clean + bad
    with np.errstate(divide="ignore", invalid="ignore"):
        deviance = np.where(bad > 0, bad * np.log(bad / (m * share)), 0) + np.where(clean > 0, clean * np.log(clean / (m * (1 - share))), 0)
    # clean documents may quote: allow the rate of one in twenty, scaled to the sample's classes
    pure = bad / max(toxic.sum(), 1) >= 20 * clean / max((toxic == 0).sum(), 1)
    strong = (deviance > np.log(max((m > 0).sum(), 2)) + 3) & pure & (bad > m * share)
    flagged = np.zeros(owner[-1] + 1, bool)
    flagged[owner[strong[feats]]] = True
    return flagged[word] & (np.repeat(toxic, tokens.counts) == 1)


def one_of_each(texts: list[str]) -> np.ndarray:
    """Positions of the documents that share no min-hash of three-word
    shingles with an earlier one: copies would vote for their words many times."""
    tokens = Sample(texts)
    h, edge, kept, seen = tokens.hash, np.r_[0, np.cumsum(tokens.counts)], [], set()
    for d in range(len(texts)):
        own = h[edge[d]:edge[d + 1]]
        if len(own) >= 3:
            own = A.mix(own[:-2] * _C4 + own[1:-1] * _C5 + own[2:] * _CW)
        mins = [(k, int((own * np.uint64(2 * k + 1) ^ (own >> np.uint64(7 * k + 5))).min())) for k in range(4)] if len(own) else []
        if not seen.intersection(mins):
            kept.append(d)
        seen.update(mins)
    return np.array(kept, np.int64)


def fit(texts: list[str], toxic: np.ndarray) -> Model | None:
    """Train on labelled documents; None when a class is missing."""
    toxic = np.asarray(toxic, np.int64)
    kept = one_of_each(texts)
    texts, toxic = [texts[k] for k in kept], toxic[kept]
    if toxic.sum() == 0 or (toxic == 0).sum() == 0:
        return None
    parts = np.arange(len(toxic)) % 5 == 4
    for y in (0, 1):  # every class in both parts, if it has two rows at least
        own = np.flatnonzero(toxic == y)
        parts[own] = np.arange(len(own)) % 5 == 4
    tokens = Sample(texts)
    if len(tokens.hash) == 0:
        return None
    word, feats, owner = tokens.distinct()
    y = token_labels(tokens, word, feats, owner, toxic).astype(float)
    chains = Chains(tokens.counts)
    fit_token = ~np.repeat(parts, tokens.counts)
    fit_chain = ~parts[chains.doc]
    weights, bias, trans = np.zeros(1 << BITS), -4.0, np.array([0.0, 0.0, 0.0])
    ym = chains.spread(y, 0.0)
    real = np.array([((1 - ym[:-1]) * ym[1:])[:, fit_chain].sum(), 0.0, (ym[:-1] * ym[1:])[:, fit_chain].sum()])
    live = np.arange(CHAIN)[:, None] < chains.length[None, :]
    real[1] = (ym[:-1] * (1 - ym[1:]) * live[1:])[:, fit_chain].sum()
    g2w, g2b, g2t = np.full(1 << BITS, 1.0), 1.0, np.full(3, 1.0)
    n_words = int(word.max()) + 1
    for _ in range(ROUNDS):
        of_word = np.bincount(owner, weights[feats], n_words)
        odds, _, inner = messages(of_word[word] + bias, chains, trans)
        odds = odds[chains.step, chains.chain]
        r = np.where(fit_token, y - odds / (1 + odds), 0.0)
        gw = np.bincount(feats, np.bincount(word, r, n_words)[owner], 1 << BITS) - 0.02 * weights
        e, f, b, live_ = inner
        gt = real - expected_transitions((e[:, fit_chain], f[:, fit_chain], b[:, fit_chain], live_[:, fit_chain]), trans) - 0.1 * trans
        gb = r.sum()
        g2w += gw * gw
        g2b += gb * gb
        g2t += gt * gt
        weights += 0.4 * gw / np.sqrt(g2w)
        bias += 0.4 * gb / np.sqrt(g2b)
        trans = np.clip(trans + 0.2 * gt / np.sqrt(g2t), -6, 6)
    model = Model(weights.astype(np.float32), float(bias), trans, np.array([0.0, 1.0, 0.0]))
    features = np.concatenate([model.evidence(t)[1] for t in tokens.pieces()])
    held = parts if parts.any() and 0 < toxic[parts].sum() < parts.sum() else np.ones(len(toxic), bool)
    model.doc = _logistic(features[held], toxic[held])
    return model


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps; intercept first."""
    x1 = np.c_[np.ones(len(x)), x]
    w, ridge = np.zeros(x1.shape[1]), np.diag([1e-3] + [0.05] * x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -40, 40)))
        h = (x1 * (p * (1 - p))[:, None]).T @ x1 + ridge
        step = np.linalg.solve(h, x1.T @ (y - p) - ridge @ w)
        w = w + step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
    return w


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic, o): the bounded sample of labelled rows."""
    known = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("o", F.xxhash64("doc_id")))
    ids = known.where("toxic = 1").orderBy("o", "doc_id").limit(MAX_TOXIC).unionByName(
        known.where("toxic = 0").orderBy("o", "doc_id").limit(MAX_CLEAN))
    return (docs.select("doc_id", "text").where(F.octet_length("text").between(1, MAX_FIT_BYTES))
            .join(F.broadcast(ids), "doc_id")  # at most MAX_TOXIC + MAX_CLEAN narrow rows
            .groupBy("doc_id", "o", "toxic").agg(F.min("text").alias("text")).select("text", F.col("toxic").cast("int").alias("toxic"), "o", "doc_id"))


def _fit_group(group: pa.Table) -> pa.Table:
    group = group.sort_by([("o", "ascending"), ("doc_id", "ascending")])
    model = fit(group["text"].to_pylist(), group["toxic"].to_numpy().astype(np.int64))
    return pa.table({"model": pa.array([pickle.dumps(model)], pa.binary())})


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The model, fitted on the bounded sample in one executor task; only the
    weights come to the driver."""
    rows = sample(docs, labels).withColumn("one", F.lit(1)).groupBy("one").applyInArrow(_fit_group, "model binary").collect()
    return pickle.loads(rows[0].model) if rows else None


SPAN = pa.list_(pa.struct([("byte_from", pa.int32()), ("byte_to", pa.int32())]))


def toxic_spans(tokens: Tokens, p: np.ndarray, offsets: np.ndarray) -> list[list[dict]]:
    """Byte ranges of runs of words with a marginal of at least one half."""
    first = np.cumsum(tokens.counts) - tokens.counts
    out: list[list[dict]] = [[] for _ in tokens.counts]
    hits = np.flatnonzero(p >= 0.5)
    docs = np.searchsorted(np.cumsum(tokens.counts), hits, side="right")
    prev = (-1, -2)
    for d, k in zip(docs.tolist(), hits.tolist()):
        a, b = int(tokens.starts[k] - offsets[d]), int(tokens.ends[k] - offsets[d])
        if prev == (d, k - 1) and k > first[d]:
            out[d][-1]["byte_to"] = b
        else:
            out[d].append({"byte_from": a, "byte_to": b})
        prev = (d, k)
    return out


def tag(docs: DataFrame, model: Model | None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: all) with ``toxic_score`` and
    ``toxic_spans``, which take the place of columns of these names."""
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("toxic_score", "toxic_spans")]
    out = _tagged(docs, model, text, keep)
    return out.select(*[F.col(f"__k{i}").alias(c) for i, c in enumerate(keep)], "toxic_score", "toxic_spans")


def _tagged(docs: DataFrame, model: Model | None, text: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` as ``__k0``, ``__k1`` ..., toxic_score, toxic_spans."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(keep)], F.col(text).alias("__text"))
    sent = spark.sparkContext.broadcast(model)
    names = [f"__k{i}" for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            buf, off = A.byte_buffer(batch.column("__text"))
            for a, b in A.pieces(off, 1_500_000):
                part = batch.slice(a, b - a)
                if m is None:
                    score, spans = np.zeros(b - a), [[] for _ in range(b - a)]
                else:
                    po = off[a:b + 1] - off[a]
                    tokens = Tokens(buf[off[a]:off[b]], po)
                    p, features = m.evidence(tokens)
                    score, spans = m.score(features), toxic_spans(tokens, p, po)
                yield pa.RecordBatch.from_arrays([part.column(n) for n in names] + [pa.array(score), pa.array(spans, SPAN)],
                                                 names=names + ["toxic_score", "toxic_spans"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__text")
    return rows.mapInArrow(run, schema + ", toxic_score double, toxic_spans array<struct<byte_from:int,byte_to:int>>")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    out = tag(docs, train(docs, labels), keep=["doc_id"])
    return out.select("doc_id", held_out("doc_id").alias("held_out"), F.col("toxic_score").alias("score"),
                      (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"), F.col("toxic_spans").alias("spans"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents scored below one half, with their own columns."""
    out = _tagged(docs, train(docs, labels), "text", docs.columns)
    return out.where(F.col("toxic_score") < 0.5).select(*[F.col(f"__k{i}").alias(c) for i, c in enumerate(docs.columns)])
