"""The corpus pipeline against brute force, with columns of clashing names; and
vectors whose squares overflow."""

import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_operators import WORDS
from wxgrid.llm import collision_ann, toxicity
from wxgrid.llm.queries import tokenizer_path

CLASH = ["toxic_score", "toxic_spans", "n_tokens", "ids_sha256", "decoded_sha256", "n_lines", "spans", "h", "r", "component_id", "__k0", "version", "cut"]


def rows():
    rng = random.Random(8)
    line = lambda k: " ".join(rng.choice(WORDS) for _ in range(k))
    shared = "This very line stands in many documents, " + line(8)
    bench = [(k, line(12)) for k in range(4)]
    docs = [(i, "\n".join([line(rng.randint(5, 40)), shared if i % 4 == 0 else line(5), line(9)])) for i in range(50)]
    docs += [(50 + i, docs[i][1].replace(line(1), "omega", 1)) for i in range(5)] + [(60, "before it " + bench[0][1] + " and after"), (61, bench[1][1]),
             (62, None), (63, ""), (64, "badword badword damnedword awful"), (65, "lead " * 3000), (3, docs[3][1])]
    docs += [(100 + i, ("vile hateful scum " if i % 2 else "kind gentle words ") + line(6)) for i in range(60)]
    return docs, bench, [(100 + i, 1, i % 2) for i in range(60)]


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def words(text, pattern):
    return re.findall(pattern, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, bench):
    """Line dedup, near duplicates and decontamination of (id, text) rows."""
    held = {}
    for i, t in docs:
        for x in {key(x) for x in (t or "").split("\n")}:
            if len(x) >= 40:
                held.setdefault(x, set()).add(i)
    last = {x: max(ids) for x, ids in held.items() if len(ids) >= 5}
    docs = [(i, t if t is None else "\n".join(x for x in t.split("\n") if last.get(key(x), i) == i)) for i, t in docs]
    docs = sorted(set(docs), key=str)   # rows that repeat stay once
    sets = {}
    for i, t in docs:
        w = words(t, r"[^\x20\x09-\x0D]+")
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    gone = set()
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                gone.add(b)   # groups of two in this corpus
    docs = [(i, t) for i, t in docs if i not in gone]
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    grams = {}
    for _, t in bench:
        w = words(t, pattern)
        n = min(10, len(w))
        grams.setdefault(n, set()).update(tuple(w[k:k + n]) for k in range(len(w) - n + 1))
    out = []
    for i, t in docs:
        w = list(re.finditer(pattern, "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")))
        hit = set()
        for n, known in grams.items():
            for k in range(len(w) - n + 1):
                if tuple(m.group() for m in w[k:k + n]) in known:
                    hit.update(range(k, k + n))
        if hit:
            parts, at = [], 0
            runs = [k for k in sorted(hit) if k - 1 not in hit]
            for a in runs:
                b = a
                while b + 1 in hit:
                    b += 1
                parts.append(t[at:w[a].start()])
                at = w[b].end()
            t = " ".join(x for x in (p.strip(" ") for p in [*parts, t[at:]]) if x)
        out.append((i, t))
    return out


def test_run_against_brute_force(spark, tmp_path):
    docs, bench, labels = rows()
    sf = str(tmp_path)
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text")})
    df = df.withColumns({c: F.lit("x") for c in CLASH})
    df.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    lab.write.parquet(f"{sf}/labels.parquet")
    kept = {r["doc_id"] for r in toxicity.tag(df, toxicity.train(df, lab), keep=["doc_id"]).where("toxic_score < 0.5").collect()}
    assert 0 < len(kept) < len({i for i, _ in docs})
    want = brute([(i, t) for i, t in docs if i in kept], bench)
    lib = Tokenizer.from_file(tokenizer_path())
    out = corpus_pipeline.run(spark, sf)
    assert set(CLASH) <= set(out.columns)
    got = sorted((r["doc_id"], list(r["token_ids"])) for r in out.collect())
    assert got == sorted((i, lib.encode(t or "", add_special_tokens=False).ids) for i, t in want)


def test_stages_on_an_empty_table(spark, tmp_path):
    for name, schema in (("documents", "doc_id long, text string, n_tokens string"), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(os.path.join(str(tmp_path), f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("huge", [1e200, 1e307, 1e-200])
def test_nearest_of_vectors_that_overflow(spark, huge):
    rng = np.random.default_rng(1)
    vectors = [(i, [float(x) for x in rng.normal(size=6) * (huge if i % 5 == 0 else 1.0)]) for i in range(60)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = {}
    for r in collision_ann.nearest(df, F.col("vec_id") % 20 == 0, 5).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {0, 20, 40}
    assert all(sorted(x[0] for x in v) == [1, 2, 3, 4, 5] and not any(np.isnan(x[2]) for x in v) for v in got.values())
