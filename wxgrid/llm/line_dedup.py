"""Line dedup over levelled sorted runs of line hashes (DataFrame only).

``LineRuns`` is the index: a set of runs, each a table bucketed and sorted by
the line hash.  A batch of documents is hashed once into postings (line,
document, line positions); its keys merge-anti-join the live runs: a line that
no run knows is entered with the batch's largest document, a known line only
adds its document count.  The batch then becomes a run of level 0.  When a
level holds ``fanout`` runs they are merged into one run of the next level, so
a line is rewritten once per level and a batch meets few runs.  Batches come
in descending document order, so the run that first knows a line knows the
largest document that holds it.

Runs and postings are written below ``spark.checkpoint.dir``; runs share one
bucketing, so neither a batch's joins nor compaction shuffles a run again.

Defined cases: a null or empty text is one empty line; rows with a null
doc_id neither count nor lose lines; repeated rows of one doc_id count as one
document and each loses its own lines; other columns are only carried along.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import partitions, scratch, written

STRIP = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_CHARS = 40
MIN_DOCS = 5
BATCHES = 4
FANOUT = 3
KEY = ["h1", "h2"]


def lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def postings(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """(h1, h2, doc_id, version, pos[]): where each long line stands.  The
    version is the hash of the text, which tells apart rows with one id."""
    key = F.translate(F.btrim(F.col("line"), F.lit(STRIP)), UPPER, UPPER.lower())
    return (docs.where(F.col(doc_id).isNotNull() & (F.length(F.col(text)) >= min_chars))
            .select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("version"),
                    F.posexplode(lines(text)).alias("at", "line"))
            .where(F.length("line") >= min_chars)
            .select("doc_id", "version", "at", key.alias("key"))
            .where(F.length("key") >= min_chars)
            .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc_id", "version", "at")
            .groupBy(*KEY, "doc_id", "version").agg(F.collect_set("at").alias("pos")))


class LineRuns:
    """The levelled index.  ``add`` enters one batch of postings whose
    documents all precede those of earlier batches."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.buckets = partitions(spark)
        self.levels: list[list[DataFrame]] = []

    def _run(self, rows: DataFrame) -> DataFrame:
        """Write a run bucketed and sorted by key: an unmanaged table whose
        files lie below the checkpoint folder and go with it."""
        name = f"line_run_{uuid.uuid4().hex}"
        (rows.write.bucketBy(self.buckets, *KEY).sortBy(*KEY)
         .option("path", scratch(self.spark, name)).saveAsTable(name))
        return self.spark.table(name)

    def runs(self) -> list[DataFrame]:
        return [r for level in self.levels for r in level]

    def add(self, batch: DataFrame) -> None:
        own = (batch.groupBy(*KEY, "doc_id").agg(F.lit(1).alias("one"))
               .groupBy(*KEY).agg(F.count("doc_id").alias("n_docs"), F.max("doc_id").alias("top")))
        own = own.repartition(self.buckets, *KEY)
        known = F.lit(False)
        for k, run in enumerate(self.runs()):
            own = own.join(run.where(F.col("top").isNotNull()).select(*KEY, F.lit(True).alias(f"known{k}")).hint("merge"), KEY, "left")
            known = known | F.coalesce(F.col(f"known{k}"), F.lit(False))
        own = own.select(*KEY, "n_docs", F.when(~known, F.col("top")).alias("top"))
        self._place(0, self._run(own))

    def _place(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged = self._run(self._merged(self.levels[level]).repartition(self.buckets, *KEY))
            self.levels[level] = []
            self._place(level + 1, merged)

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        rows = runs[0]
        for r in runs[1:]:
            rows = rows.unionByName(r)
        return rows.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.max("top").alias("top"))

    def repeated(self, min_docs: int) -> DataFrame:
        """Lines known from at least ``min_docs`` documents, with the largest."""
        return self._merged(self.runs()).where(F.col("n_docs") >= min_docs).select(*KEY, "top")


def id_ranges(docs: DataFrame, doc_id: str, batches: int) -> list[Column]:
    """Predicates of disjoint id ranges in descending order, which a Parquet
    scan prunes by.  Ids that are not numbers make one batch."""
    if docs.schema[doc_id].dataType.typeName() not in ("byte", "short", "integer", "long"):
        return [F.col(doc_id).isNotNull()]
    lo, hi = docs.agg(F.min(doc_id), F.max(doc_id)).first()
    if lo is None:
        return [F.col(doc_id).isNotNull()]
    cuts = sorted({lo + (hi - lo) * k // batches for k in range(1, batches)} - {lo})
    edges = [None, *cuts, None]
    out = []
    for a, b in zip(edges, edges[1:]):
        p = F.col(doc_id).isNotNull()
        p = p & (F.col(doc_id) >= a) if a is not None else p
        out.append(p & (F.col(doc_id) < b) if b is not None else p)
    return out[::-1]


def dropped_lines(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                  min_docs: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """(doc_id, version, cut): sorted positions of the lines each row loses."""
    index, parts = LineRuns(docs.sparkSession, fanout), None
    for batch in id_ranges(docs, doc_id, batches):
        part = written(postings(docs.where(batch), doc_id, text, min_chars), "line-postings")
        index.add(part)
        parts = part if parts is None else parts.unionByName(part)
    return (parts.join(index.repeated(min_docs), KEY).where(F.col("doc_id") < F.col("top"))
            .groupBy("doc_id", "version").agg(F.array_sort(F.flatten(F.collect_list("pos"))).alias("cut")))


def _kept(all_lines: Column, cut: Column) -> Column:
    """The lines between the cut positions, joined by newlines."""
    edges = F.concat(F.array(F.lit(-1)), cut, F.array(F.size(all_lines)))
    runs = F.transform(F.sequence(F.lit(1), F.size(cut) + 1),
                       lambda i: F.slice(all_lines, F.element_at(edges, i) + 2,
                                         F.element_at(edges, i + 1) - F.element_at(edges, i) - 1))
    return F.array_join(F.flatten(runs), "\n")


def dedup_lines(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``docs`` with the kept text in its text column (null stays null), and
    ``n_lines`` and ``n_dropped`` in the columns ``__n_lines``/``__n_dropped``."""
    cuts = dropped_lines(docs, doc_id=doc_id, text=text, **settings) \
        .select(F.col("doc_id").alias("__id"), F.col("version").alias("__version"), F.col("cut").alias("__cut"))
    rows = docs.withColumn("__v", F.xxhash64(F.col(text)))
    rows = rows.join(cuts.hint("shuffle_hash"), (F.col(doc_id) == F.col("__id")) & (F.col("__v") == F.col("__version")), "left")
    rows = rows.withColumn("__lines", lines(text))
    new = F.when(F.col("__cut").isNull(), F.col(text)).otherwise(_kept(F.col("__lines"), F.col("__cut")))
    return rows.select(*[new.alias(c) if c == text else F.col(c) for c in docs.columns],
                       F.size("__lines").cast("long").alias("__n_lines"),
                       F.when(F.col("__cut").isNull(), F.lit(0)).otherwise(F.size("__cut")).cast("long").alias("__n_dropped"))


def report(docs: DataFrame) -> DataFrame:
    out = dedup_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
                      F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("kept_sha256"))
