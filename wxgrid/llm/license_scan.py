"""Licence scan: a trained paragraph classifier (DataFrame only).

Features are the word 1- and 2-grams of the licence notices in
``license_templates``.  A softmax regression over them, with a class for other
text, is fitted on the driver: on the notices, whole and in halves, and on at
most ``MAX_NEGATIVE`` units of at most ``MAX_SAMPLE`` documents chosen by
hash, none of which shares a 3-gram with a notice.  Half of those units
stay out of the fit and calibrate the unknown class: a family is named when its
probability exceeds what ``CALIBRATION`` of them reach, a licence-like
unit below that is ``unknown``.

Scanning runs on DataFrame functions alone.  A paragraph is a run of lines with
words.  One with no 2-gram of any notice holding a content word has only the
score of other text; the rest, few, are scored by units: every line, and every
window of neighbouring lines that grows until ``COVER`` words follow its first
line: a notice of the longest kind fits in one, at whatever width it is wrapped.
Units are exploded into grams, joined with the weights and summed per class.
Each prediction is compared with the family's notices by the Dice coefficient
of 2-gram sets and confirmed from ``CONFIRM`` on, or when the unit contains
nearly all of a notice.  Of units that overlap, one is kept only if it is the
best (confirmed, most similar, most probable, shortest) on each of its lines.

The weights and notices that are broadcast are bounded by the templates.

Defined cases: null and empty texts are one empty paragraph without a licence;
repeated rows are scanned once and each gets its row; rows with a null id are
answered like others; other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .license_templates import TEMPLATES

OTHER = "none"
MAX_SAMPLE = 1000
MAX_SAMPLE_BYTES = 20_000
MAX_NEGATIVE = 4000
CALIBRATION = 0.999
CONFIRM = 0.5
CONTAINED = 0.8
FAMILIES = sorted(TEMPLATES)
#: Words that say nothing about a licence on their own (fixed values).
STOP = set("a all an and any are as at be by can for from has in is it may no not of on or other part s source that the this to use with work you".split())


def _words(text: str) -> list[str]:
    return [w for w in re.split("[^a-z0-9]+", text.lower()) if w]


def _grams(words: list[str], n: int) -> list[str]:
    return [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)]


NOTICES = [(f, k, _words(t.replace("#", ""))) for f in FAMILIES for k, t in enumerate(TEMPLATES[f])]
#: Words of the longest notice, and a quarter for other wordings.
COVER = max(len(w) for _, _, w in NOTICES) * 5 // 4
VOCABULARY = sorted({g for _, _, w in NOTICES for n in (1, 2) for g in _grams(w, n)})
ANCHORS = sorted(g for g in VOCABULARY if " " in g and not set(g.split()) <= STOP)


def words(line: Column) -> Column:
    return F.filter(F.split(F.lower(line), "[^a-z0-9]+"), lambda x: x != "")


def _once(value: Column, then) -> Column:
    """``then(value)`` with the value computed once, not in each use of it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def pairs(words_of: Column) -> Column:
    """The 2-grams of a list of words."""
    return _once(words_of, lambda w: F.when(F.size(w) >= 2, F.transform(F.sequence(F.lit(1), F.size(w) - 1), lambda i: F.concat_ws(
        " ", F.element_at(w, i), F.element_at(w, i + 1)))).otherwise(F.array().cast("array<string>")))


UNIT = ["id", "version", "par", "line", "n"]


def split_paragraphs(text: Column) -> Column:
    """Runs of lines with words, in lower case; one empty one without words."""
    bare = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "(?md)^[^a-z0-9\n]+$", "")
    return F.split(F.regexp_replace(bare, r"\A\n+|\n+\z", ""), "\n\n+", -1)


def paragraphs(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, version, par, lines) of every paragraph."""
    return docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("version"), F.posexplode(split_paragraphs(F.col(text))).alias("par", "lines"))


def _reach(sizes: Column, i: Column) -> Column:
    """Lines of the longest window from line i (from 1) on; every line has a
    word, so it ends within ``COVER`` lines after the first."""
    start = F.struct(F.lit(0).alias("words"), F.lit(1).alias("n"))
    grown = lambda a, x: F.when(a["words"] < COVER, F.struct((a["words"] + x).alias("words"), (a["n"] + 1).alias("n"))).otherwise(a)
    return F.aggregate(F.slice(sizes, i + 1, COVER), start, grown, lambda a: a["n"])


def units(pars: DataFrame) -> DataFrame:
    """(id, version, par, line, n, w): the words of every window of n lines from
    ``line`` on."""
    lines = F.split("lines", "\n")
    sizes = F.transform(lines, lambda x: F.size(words(x)))
    # a window's lines alone go on, not its paragraph
    ahead = pars.select("id", "version", "par", F.posexplode(_once(F.struct(lines.alias("x"), sizes.alias("s")), lambda p: F.transform(
        F.sequence(F.lit(1), F.size(p["x"])), lambda i: F.slice(p["x"], i, _reach(p["s"], i))))).alias("line", "ahead"))
    each = ahead.select("id", "version", "par", "line", F.posexplode(F.transform(
        F.sequence(F.lit(1), F.size("ahead")), lambda k: F.array_join(F.slice("ahead", 1, k), "\n"))).alias("n", "unit"))
    return each.select("id", "version", "par", "line", (F.col("n") + 1).alias("n"), words(F.col("unit")).alias("w"))


def _vector(w: list[str]) -> np.ndarray:
    index = {g: i for i, g in enumerate(VOCABULARY)}
    x = np.zeros(len(VOCABULARY))
    for n in (1, 2):
        for g in _grams(w, n):
            if g in index:
                x[index[g]] = 1.0
    return x


def negatives(docs: DataFrame, doc_id: str, text: str) -> list[list[str]]:
    """Words of the sampled units of ordinary text."""
    some = (docs.where(F.octet_length(text) <= MAX_SAMPLE_BYTES).select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
            .orderBy(F.xxhash64("id"), F.xxhash64("text")).limit(MAX_SAMPLE))
    known = {g for _, _, w in NOTICES for g in _grams(w, 3)}
    rows = units(paragraphs(some, "id", "text")).where(F.size("w") > 0).orderBy(F.xxhash64("id", "par", "line", "n", "version")).limit(MAX_NEGATIVE)
    return [r.w for r in rows.select("w").collect() if not known.intersection(_grams(r.w, 3))]


def fit(other: list[list[str]]) -> tuple[np.ndarray, np.ndarray, float]:
    """(weights by gram and class, intercepts, threshold); the last class is
    ordinary text."""
    x, y = [], []
    for family, _, w in NOTICES:
        half = len(w) // 2
        for part in [w] + [p for p in (w[:half], w[half:]) if len(p) >= 6]:
            x.append(_vector(part))
            y.append(FAMILIES.index(family))
    learn, check = other[0::2] or [[]], other[1::2]
    x += [_vector(w) for w in learn]
    y += [len(FAMILIES)] * len(learn)
    x, y = np.array(x), np.array(y)
    classes = len(FAMILIES) + 1
    share = np.bincount(y, minlength=classes)
    cost = (len(y) / (classes * np.maximum(share, 1)))[y]  # classes weigh alike
    target = np.eye(classes)[y]
    w, b = np.zeros((x.shape[1], classes)), np.zeros(classes)
    vw, vb, lr = np.zeros_like(w), np.zeros_like(b), 0.5
    for _ in range(300):
        p = _softmax(x @ w + b)
        g = (p - target) * cost[:, None] / len(y)
        vw = 0.9 * vw - lr * (x.T @ g + 1e-4 * w)
        vb = 0.9 * vb - lr * g.sum(axis=0)
        w, b = w + vw, b + vb
    top = _softmax(np.array([_vector(v) for v in check]) @ w + b)[:, :-1].max(axis=1) if check else np.zeros(1)
    return w, b, float(max(0.5, np.quantile(top, CALIBRATION)))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def scan(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, version, par, line, n, family, probability, similarity, confirmed)
    of every licence-like unit that no overlapping one beats."""
    spark = docs.sparkSession
    w, b, threshold = fit(negatives(docs, doc_id, text))
    anchors = F.array(*[F.lit(a) for a in ANCHORS])
    near = paragraphs(docs, doc_id, text).where(F.arrays_overlap(pairs(words(F.col("lines"))), anchors)).dropDuplicates(["id", "version", "par"])
    found = units(near).withColumn("pairs", pairs(F.col("w"))).where(F.arrays_overlap("pairs", anchors))
    found = found.select(*UNIT, F.array_distinct("w").alias("w"), F.array_distinct("pairs").alias("pairs"))
    z = [f"z{k}" for k in range(len(FAMILIES) + 1)]
    weights = spark.createDataFrame([(g, *map(float, w[i])) for i, g in enumerate(VOCABULARY)], ", ".join(["gram string", *[f"{c} double" for c in z]]))
    # sums of double weights in a fixed order of grams, so a rerun gives the same bits
    scored = (found.select(*UNIT, "pairs", F.explode(F.concat("w", "pairs")).alias("gram"))
              .join(F.broadcast(weights), "gram").groupBy(*UNIT)
              .agg(F.first("pairs").alias("pairs"), *[F.round(F.sum(c), 9).alias(c) for c in z]))
    z_all = [F.col(c) + F.lit(float(b[k])) for k, c in enumerate(z)]
    scored = scored.withColumn("z", F.array(*z_all)).withColumn("m", F.array_max("z"))
    scored = scored.withColumn("total", F.aggregate("z", F.lit(0.0), lambda a, v: a + F.exp(v - F.col("m"))))
    best = F.slice("z", 1, len(FAMILIES))
    scored = scored.withColumn("k", F.array_position(best, F.array_max(best)).cast("int")) \
        .withColumn("probability", F.exp(F.array_max(best) - F.col("m")) / F.col("total")) \
        .withColumn("other", F.exp(F.element_at("z", -1) - F.col("m")) / F.col("total"))
    named = scored.where("other < 0.5").withColumn(
        "family", F.when(F.col("probability") >= threshold, F.element_at(F.array(*[F.lit(f) for f in FAMILIES]), F.col("k"))).otherwise("unknown"))
    return _best(_compared(spark, named))


def _compared(spark: SparkSession, named: DataFrame) -> DataFrame:
    notices = spark.createDataFrame([(f, sorted(set(_grams(w, 2)))) for f, _, w in NOTICES], "family string, notice array<string>")
    both = named.join(F.broadcast(notices), "family", "left")
    common = F.size(F.array_intersect("pairs", "notice"))
    both = both.withColumn("dice", F.coalesce(2 * common / (F.size("pairs") + F.size("notice")), F.lit(0.0))) \
        .withColumn("inside", F.coalesce(common / F.size("notice"), F.lit(0.0)))
    return both.groupBy(*UNIT, "family", "probability").agg(F.max("dice").alias("similarity"), F.max("inside").alias("inside")) \
        .select(*UNIT, "family", "probability", "similarity",
                ((F.col("similarity") >= CONFIRM) | (F.col("inside") >= CONTAINED)).alias("confirmed"))


def _best(compared: DataFrame) -> DataFrame:
    """The units that are the best on each of their lines."""
    rank = F.struct("confirmed", F.round("similarity", 6).alias("s"), F.round("probability", 6).alias("p"), -F.col("n"), -F.col("line"))
    on = compared.withColumn("rank", rank).withColumn("on", F.explode(F.sequence(F.col("line"), F.col("line") + F.col("n") - 1)))
    on = on.withColumn("best", F.col("rank") == F.max("rank").over(Window.partitionBy("id", "version", "par", "on")))
    values = ["family", "probability", "similarity", "confirmed"]
    return on.groupBy(*UNIT).agg(F.min("best").alias("best"), *[F.first(c).alias(c) for c in values]).where("best").select(*UNIT, *values)


def report(docs: DataFrame) -> DataFrame:
    """Per document: paragraphs, licence notices, confirmed families and the
    largest probability."""
    hits = scan(docs).groupBy("id", "version").agg(
        F.count("*").alias("n_license"), F.count(F.when(F.col("family") == "unknown", 1)).alias("n_unknown"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("confirmed"), F.col("family")))), ",").alias("families"),
        F.max("probability").alias("score"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("v"), F.size(split_paragraphs(F.col("text"))).cast("long").alias("n_paragraphs"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return rows.join(hits, rows["doc_id"].eqNullSafe(hits["id"]) & (rows["v"] == hits["version"]), "left").select(
        "doc_id", "n_paragraphs", zero("n_license"), zero("n_unknown"), F.coalesce("families", F.lit("")).alias("families"),
        F.round(F.coalesce("score", F.lit(0.0)), 6).alias("score"))
