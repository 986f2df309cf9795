"""Merkle manifest of a table by nested-interval labels.

Every row is a leaf, every source a tree of fan-out ``FANOUT`` over its leaves
in order of their id, and the trees' roots are the leaves of one more tree.  A
node carries the interval [lo, hi) of leaf ranks that it covers, so a node of
level k starts at a multiple of ``FANOUT ** k``:

1. ranks come from one range sort of narrow rows: a row's place in its
   partition plus the rows of its tree in earlier partitions, so no task holds
   a tree, however large its source is;
2. a level is one grouping of the level below by the interval that contains
   its nodes;
3. from the top down, children meet their parent in a containment join
   bucketed by level (a bucket is one parent's interval, of at most ``FANOUT``
   children, so no key is hot); a child's siblings are the parent's children in
   the parent's interval less its own, and its path is its siblings followed by
   its parent's path;
4. a proof is the path of a leaf: its siblings' digests, and the root that the
   leaf folds to along it.

Defined cases: null fields are ``-`` and null sources a tree of their own,
before the others; null ids come before all ids of their source; equal ids are
ordered by their leaves, and repeated rows are leaves each; an empty table has
no root and no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, written

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 of the fields, each as its UTF-8 size, a colon and its value."""
    parts = []
    for f in fields:
        s = f.cast("string")
        parts.append(F.when(s.isNull(), "-").otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s)))
    return F.sha2(F.concat(*parts), 256)


def _tree_key(source: str) -> Column:
    """Never null; sorts by bytes with the null source first."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("-"))


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with lo, hi (rank in tree ``t`` by ``order``, and one more) and
    n (leaves of the tree)."""
    keys = ["t", *order]
    placed = written(rows.repartitionByRange(partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys)
                     .withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "merkle-leaves")
    runs = placed.groupBy("t", "part").agg(F.min("at").alias("first"), F.count("*").alias("size"))
    tree = Window.partitionBy("t")
    before = F.coalesce(F.sum("size").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("t", "part", (before - F.col("first")).alias("shift"), F.sum("size").over(tree).alias("n"))
    lo = F.col("at") + F.col("shift")
    return placed.join(runs, ["t", "part"]).withColumns({"lo": lo, "hi": lo + 1}).drop("part", "at", "shift")


def levels(leaves: DataFrame) -> list[DataFrame]:
    """Nodes (t, n, lo, hi, h, kids) of every level above the leaves."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    out, below, step = [], leaves, 1
    while step < most:
        wide = step * FANOUT
        kids = F.sort_array(F.collect_list(F.struct("lo", "hi", "h")))
        nodes = below.where(F.col("n") > step).groupBy("t", "n", F.expr(f"lo div {wide}").alias("b")).agg(kids.alias("kids"))
        nodes = nodes.select("t", "n", F.col("kids")[0]["lo"].alias("lo"), F.element_at("kids", -1)["hi"].alias("hi"),
                             F.sha2(F.array_join(F.transform("kids", lambda k: k["h"]), ""), 256).alias("h"), "kids")
        below, step = written(nodes, "merkle-level"), wide
        out.append(below)
    return out


def _digests(kids: Column) -> Column:
    return F.array_join(F.transform(kids, lambda k: k["h"]), "")


def attach(children: DataFrame, parents: DataFrame, width: int) -> DataFrame:
    """Containment join of one level: children with their parent's ``top`` and
    ``path``, their own siblings before it."""
    up = parents.select(F.col("t").alias("up_t"), F.col("lo").alias("up_lo"), F.col("hi").alias("up_hi"), F.col("kids").alias("up_kids"),
                        "top", F.col("path").alias("up_path"))
    inside = (F.col("lo") >= F.col("up_lo")) & (F.col("hi") <= F.col("up_hi"))
    both = children.join(up, (F.col("t") == F.col("up_t")) & (F.expr(f"lo div {width}") == F.expr(f"up_lo div {width}")) & inside)
    # the parent's interval less the child's: what lies before and after it
    left = _digests(F.filter("up_kids", lambda k: k["hi"] <= F.col("lo")))
    right = _digests(F.filter("up_kids", lambda k: k["lo"] >= F.col("hi")))
    here = F.array(F.struct(left.alias("l"), right.alias("r")))
    return both.withColumn("path", F.concat(here, "up_path")).drop("up_t", "up_lo", "up_hi", "up_kids", "up_path")


def with_paths(leaves: DataFrame, above: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Leaves with ``top`` (their tree's root) and ``path``; ``tops`` (t, top,
    path) holds the paths of the trees' roots."""
    whole = F.col("hi") - F.col("lo") == F.col("n")
    parents = None
    for k in reversed(range(len(above))):
        nodes = above[k]
        held = nodes.where(whole).join(tops, "t")
        if parents is not None:
            held = held.unionByName(attach(nodes.where(~whole), parents, FANOUT ** (k + 2)))
        parents = written(held.select("t", "lo", "hi", "kids", "top", "path"), "merkle-paths")
    single = leaves.where(whole).join(tops, "t")
    return single if parents is None else single.unionByName(attach(leaves.where(~whole), parents, FANOUT))


def _roots(leaves: DataFrame, above: list[DataFrame]) -> DataFrame:
    """(t, h) of every tree's root."""
    out = leaves.where(F.col("n") == 1).select("t", "h")
    for nodes in above:
        out = out.unionByName(nodes.where(F.col("hi") - F.col("lo") == F.col("n")).select("t", "h"))
    return out


def _forest(rows: DataFrame) -> tuple[DataFrame, list[DataFrame], DataFrame, list[DataFrame]]:
    """Leaves and nodes of the sources' trees, and those of the tree of roots."""
    leaves = written(ranked(written(rows, "merkle-rows"), ["id", "h"]), "merkle-ranked")
    above = levels(leaves)
    roots = _roots(leaves, above).select(F.lit("").alias("t"), F.col("t").alias("id"), "h")
    top = written(ranked(roots, ["id"]), "merkle-roots")
    return leaves, above, top, levels(top)


def _rows(docs: DataFrame, doc_id: str, source: str, fields) -> DataFrame:
    return docs.select(_tree_key(source).alias("t"), F.col(doc_id).alias("id"), leaf_digest([F.col(c) for c in fields]).alias("h"))


def manifest(docs: DataFrame, *, doc_id: str = "doc_id", source: str = "source", fields=FIELDS) -> DataFrame:
    """All nodes (tree, level, lo, hi, digest); tree: the source, with level 0
    its leaves, or ``None`` with ``of_sources`` for the tree of roots."""
    leaves, above, top, over = _forest(_rows(docs, doc_id, source, fields))
    out = None
    for of_sources, nodes in ((False, [leaves, *above]), (True, [top, *over])):
        for k, level in enumerate(nodes):
            name = F.when(F.col("t").startswith("="), F.expr("substring(t, 2)"))
            part = level.select(F.lit(of_sources).alias("of_sources"), name.alias("tree"), F.lit(k).alias("level"), "lo", "hi", F.col("h").alias("digest"))
            out = part if out is None else out.unionByName(part)
    return out


def prove(docs: DataFrame, changed: dict[str, Column] | None = None, *, doc_id: str = "doc_id", source: str = "source", fields=FIELDS) -> DataFrame:
    """(id, leaf, subroot, root, proof, folded_root, verified) of every row.

    ``changed`` replaces fields of the rows that are checked against the
    manifest; a row it gives the same values is untouched.  ``proof`` is the
    digests of all siblings, level by level, left to right, as one text's
    SHA-256; ``folded_root`` is the root that the checked row's leaf leads to."""
    now = leaf_digest([(changed or {}).get(c, F.col(c)) for c in fields])
    rows = _rows(docs, doc_id, source, fields).withColumn("now", F.lit(None).cast("string")) if not changed else \
        docs.select(_tree_key(source).alias("t"), F.col(doc_id).alias("id"), leaf_digest([F.col(c) for c in fields]).alias("h"), now.alias("now"))
    leaves, above, top, over = _forest(rows)
    nothing = F.array().cast("array<struct<l:string,r:string>>")
    last = _roots(top, over).first()
    root = F.lit(last["h"] if last else None).cast("string")
    # the tree of roots is its own top: its root has an empty path
    crown = _roots(top, over).select("t", F.col("h").alias("top"), nothing.alias("path"))
    tops = written(with_paths(top, over, crown).select(F.col("id").alias("t"), F.col("h").alias("top"), "path"), "merkle-tops")
    held = with_paths(leaves, above, tops)
    proof = F.sha2(F.array_join(F.transform("path", lambda s: F.concat(s["l"], s["r"])), ""), 256)
    folded = F.aggregate("path", F.coalesce("now", "h"), lambda h, s: F.sha2(F.concat(s["l"], h, s["r"]), 256))
    return held.select("id", F.col("h").alias("leaf"), F.col("top").alias("subroot"), root.alias("root"), proof.alias("proof"), folded.alias("folded_root")) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))


def report(docs: DataFrame) -> DataFrame:
    """Rows whose id's crc32 five divides are checked with A-Z in lower case."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    text = F.when(hit, F.translate("text", upper, upper.lower())).otherwise(F.col("text"))
    out = prove(docs, {"text": text})
    return out.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"), "folded_root", "verified")
