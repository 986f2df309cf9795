"""Each operator against a brute-force version or an exact round trip on small
inputs with nulls, empty and long texts, ties, repeated rows, empty tables and
clashing column names."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wxgrid.llm import (arrowtext, bpe, collision_ann, components, decontaminate, induced, jaccard_join, language_id,
                        license_scan, line_dedup, suffix_dedup, toxicity)
from wxgrid.llm.queries import tokenizer_path

WORDS = "alpha beta gamma delta eps zeta eta theta iota kappa la mu nu xi omi pi rho sig tau ups".split()


def corpus(seed=3, n=40):
    rng = random.Random(seed)
    line = lambda k: " ".join(rng.choice(WORDS) for _ in range(k))
    shared = "This very line stands in many documents, " + line(8)
    rows = [(i, "\n".join([line(rng.randint(3, 30)), shared if i % 3 == 0 else line(4), line(9)])) for i in range(n)]
    rows += [(n, rows[1][1]), (n + 1, rows[1][1].replace("alpha", "omega", 1)), (n + 2, None), (n + 3, ""), (n + 4, "one two"),
             (n + 5, "x" * 3000 + " " + line(2000)), (None, rows[2][1]), (7, rows[7][1]), (n + 6, "é ß 漢字 " + shared.upper())]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    # extra columns whose names clash with the operators' own
    return spark.createDataFrame(corpus(), "doc_id long, text string").withColumns({c: F.lit("x") for c in ("n_words", "h", "r", "pos", "__text", "label", "spans")})


def test_suffix_array():
    rng = random.Random(1)
    for _ in range(100):
        k = rng.choice([1, 2, 3, 26])
        x = [rng.randint(1, k) for _ in range(rng.randint(1, 120))] * rng.choice([1, 3]) + [0]
        assert induced.suffix_array(np.array(x), k + 1).tolist() == sorted(range(len(x)), key=lambda i: x[i:])


def test_suffix_dedup(docs):
    rows = {(i, t) for i, t in corpus()}
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - 49) if i is not None else ():
            first[b[k:k + 50]] = min(i, first.get(b[k:k + 50], i))
    expect = set()
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 49) if i is not None else ():
            if first[b[k:k + 50]] < i:
                gone[k:k + 50] = b"\1" * 50
        kept = bytes(x for x, y in zip(b, gone) if not y)
        expect.add((i, len(b), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    got = suffix_dedup.report(docs).collect()
    assert {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == expect
    assert len(got) == len(corpus())


def test_jaccard_join(docs):
    def grams(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    sets = {i: grams(t) for i, t in corpus() if i is not None}
    best = {i: i for i in sets}
    for _ in sets:
        for i, a in sets.items():
            for j, b in sets.items():
                if a and b and 100 * len(a & b) >= 80 * len(a | b):
                    best[i] = best[j] = min(best[i], best[j])
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.report(docs).collect() if r.doc_id is not None}
    assert got == {(i, len(s), best[i]) for i, s in sets.items()}
    kept = [r.doc_id for r in jaccard_join.keep_one(docs).select("doc_id").collect()]
    assert len(kept) == len(set(kept)) and set(kept) - {None} == {i for i in sets if best[i] == i}


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (3, 1), (5, 5), (8, 7), (20, 3)], "u long, v long")
    assert {(r.node, r.label) for r in components.components(edges).collect()} == {(1, 1), (2, 1), (3, 1), (20, 1), (7, 7), (8, 7), (9, 7)}


def test_line_dedup(docs):
    rows = corpus()
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    holders = {}
    for i, t in rows:
        for x in (t or "").split("\n") if i is not None else ():
            holders.setdefault(key(x), set()).add(i)
    expect = []
    for i, t in rows:
        own = (t or "").split("\n")
        kept = [x for x in own if i is None or len(key(x)) < 40 or len(holders[key(x)]) < 5 or i == max(holders[key(x)])]
        expect.append((i, len(own), len(own) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    got = [(r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in line_dedup.report(docs).collect()]
    assert sorted(got, key=str) == sorted(expect, key=str) and any(x[2] for x in got)


def test_decontaminate(spark, docs):
    rows = corpus()
    items = [(1, rows[0][1][:200]), (2, "one TWO"), (3, None), (4, "..."), (None, rows[3][1]), (5, "one two three four")]
    table = spark.createDataFrame(items, "item_id long, text string")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[k:k + n]), set()).add("" if i is None else str(i))
    expect = []
    for i, t in rows:
        w, hit, names = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit |= set(range(k, k + n))
                    names |= windows[tuple(w[k:k + n])]
        expect.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    got = [tuple(r) for r in decontaminate.report(docs, table).collect()]
    assert sorted(got, key=str) == sorted(expect, key=str) and any(x[5] for x in got)
    clean = decontaminate.remove_spans(docs, table)
    assert clean.columns == docs.columns and clean.where("text is null").count() == 1


def test_bpe_exact(spark, docs):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(tokenizer_path())
    texts = [t or "" for _, t in corpus()] + ["it's o'sullivan's 12,3!!", "<|endoftext|> x<|startoftext|>y", "á ́b nbsp x", "ª ² ½ × ÷"]
    encoder = bpe.Encoder(open(tokenizer_path(), encoding="utf-8").read())
    buf, off = arrowtext.byte_buffer(pa.array(texts, pa.large_string()))
    got = [np.frombuffer(x, np.uint32).tolist() for x in bpe.encode_documents(encoder, buf, off)]
    assert got == [lib.encode(t, add_special_tokens=False).ids for t in texts]
    assert [encoder.digests(np.array(x, np.uint32).tobytes())[2] for x in got] == \
        [hashlib.sha256(lib.decode(x, skip_special_tokens=False).encode()).hexdigest() for x in got]
    rows = bpe.report(docs, tokenizer_path()).collect()
    assert len(rows) == len(corpus()) and {r.n_tokens for r in rows if r.doc_id == 42} == {0}


def test_nearest(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((600, 16))
    x[50:60] = x[40]  # ties
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [1.0]), (None, x[0].tolist())]
    got = collision_ann.report(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = 0
    for q in range(0, 600, 20):
        s = x @ x[q]
        want = [i for i in np.lexsort((np.arange(600), -s)) if i != q][:20]
        mine = [v for _, v, _ in sorted(found[q])]
        hits += len(set(want) & set(mine))
        assert len(mine) == 20 and all(abs(z - s[v]) < 1e-9 for _, v, z in found[q])
    assert hits / (30 * 20) >= 0.9


def test_toxicity_learns():
    rng = random.Random(5)
    text = lambda bad: " ".join(rng.choice(["vileword" + rng.choice(WORDS)] if bad and k % 15 == 3 else WORDS) for k in range(60))
    y = np.array([int(k % 4 == 0) for k in range(400)])
    model = toxicity.fit([text(b) for b in y], y)
    tests = [text(k % 2) for k in range(100)] + [""]
    buf, off = arrowtext.byte_buffer(pa.array(tests, pa.large_string()))
    tokens = toxicity.Tokens(buf, off)
    p, features = model.evidence(tokens)
    score = model.score(features)
    assert ((score[:100] >= 0.5) == (np.arange(100) % 2 == 1)).mean() > 0.97 and score[100] < 0.5
    spans = toxicity.toxic_spans(tokens, p, off)
    assert all(tests[1].encode()[s["byte_from"]:s["byte_to"]].startswith(b"vileword") for s in spans[1]) and spans[1]
    assert toxicity.fit(["a b c"], np.array([0])) is None


def test_language_id(spark):
    rng = random.Random(2)
    rows = [(i, " ".join("".join(rng.choice("abcdefg" if i % 2 else "opqrstu") for _ in range(5)) for _ in range(30)), "aa" if i % 2 else "bb", "s") for i in range(200)]
    rows += [(500, None, "aa", "s"), (501, "123 !", None, "s"), (502, "", "bb", "s")]
    got = language_id.report(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert all(r.lang_pred == ("aa" if r.doc_id % 2 else "bb") for r in got if r.doc_id < 200)
    assert {r.lang_pred for r in got if r.doc_id >= 500} == {"und"}


def test_license_scan(spark):
    rows = [(1, "Released under the MIT License.\nsome other words"), (2, "nothing here"), (3, None), (4, ""),
            (5, "This work is licensed under the GNU General Public License, version 3."), (None, "Licensed under the Apache License, Version 2.0.")]
    rows += [(k, f"ordinary words number {k} and of the day") for k in range(10, 60)]
    got = {r.doc_id: r.families for r in license_scan.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1], got[2], got[3], got[4], got[5], got[None]) == ("MIT", "", "", "", "GPL-3.0", "Apache-2.0")


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    items = spark.createDataFrame([], "item_id long, text string")
    for out in (suffix_dedup.report(none), jaccard_join.report(none), line_dedup.report(none), decontaminate.report(none, items),
                bpe.report(none, tokenizer_path()), language_id.report(none), license_scan.report(none),
                toxicity.report(none, spark.createDataFrame([], "doc_id long, toxic int")),
                collision_ann.report(spark.createDataFrame([], "vec_id long, embedding array<float>"))):
        assert out.count() == 0
