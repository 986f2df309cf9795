"""WARC archives, hard negatives and the Merkle manifest against brute force."""

import base64
import glob
import gzip
import hashlib
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wxgrid.llm import merkle, multi_index, warc
from wxgrid.llm.common import scratch


@pytest.fixture
def split_bytes(spark):
    """Run with byte ranges of the given size."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}

    def use(n):
        spark.conf.set(keys[0], str(n))
        spark.conf.set(keys[1], "1")

    yield use
    for k, v in before.items():
        spark.conf.set(k, v)


# WARC

def pages():
    rng = random.Random(5)
    rows = [(i, f"http://h/{i}", "<p>" + " ".join(rng.choice("a b c dd eee".split()) for _ in range(rng.randint(1, 300)))) for i in range(60)]
    rows += [(100 + i, "http://copy", "the same page") for i in range(40)] + [(7000, "http://ü x\r\ny", "ß 漢字"), (7001, None, "no url"), (7002, "", ""),
             (7003, "u", None), (None, "n", "no id"), (None, "n", "the same page"), (7004, "l", "long " * 400_000), (139, "http://copy", "the same page")]
    return rows


def expected_pages(rows):
    digest = lambda t: (len((t or "").encode()), base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode())
    top = {}
    for i, _, t in rows:
        if i is not None:
            top[digest(t)] = max(i, top.get(digest(t), i))
    out = []
    for i, _, t in rows:
        d = digest(t)
        old = d in top and (i is None or i < top[d])
        out.append((i, *d, "revisit" if old else "response", top[d] if old else None))
    return sorted(out, key=str)


def test_warc_round_trip(spark, split_bytes):
    df = spark.createDataFrame(pages(), "page_id long, url string, html string").withColumns({c: F.lit("x") for c in ("sha1", "n", "top", "salt", "member")})
    assert sorted(map(tuple, warc.report(df).collect()), key=str) == expected_pages(pages())
    path = scratch(spark, "warc-test")
    warc.write(df.repartition(3), path, records_per_file=25)
    # plain gzip of plain records
    raw = b"".join(gzip.open(f).read() for f in glob.glob(f"{path}/part-*"))
    assert raw.count(b"WARC/1.1\r\n") == len(pages()) and raw.count(b"\r\n\r\nthe same page\r\n\r\n") == 2
    # whatever the byte ranges, also those that cut the magic
    want = {t or "" for _, _, t in pages()}
    for size in (707, 917, 977, 1 << 20):
        split_bytes(size)
        got = warc.read(spark, path)
        rows = got.select("status", "type", "target_uri", "digest_ok", F.col("payload").cast("string").alias("p"), "refers_to", "record_id").collect()
        assert len(rows) == len(pages()) and {r.status for r in rows} == {"ok"}
        assert {r.p for r in rows if r.type == "response"} == want and all(r.digest_ok for r in rows if r.type == "response")
        assert {r.refers_to for r in rows if r.type == "revisit"} <= {r.record_id for r in rows if r.type == "response"}
    assert {"http://%C3%BC%20x%0D%0Ay", None} <= {r.target_uri for r in rows}


def test_warc_magic_inside_members(spark, split_bytes):
    """A stored member holds whole records verbatim; one archive breaks off."""
    inner = b"".join(warc.member(warc._record("response", [("X-Page-Id", 900 + k)], warc._http(5) + b"inner")) for k in range(30))
    plain = lambda data: (lambda c: c.compress(data) + c.flush())(zlib.compressobj(0, zlib.DEFLATED, 31))
    path = scratch(spark, "warc-magic").removeprefix("file:")
    os.makedirs(path)
    record = lambda k, body: warc._record("response", [("X-Page-Id", k)], warc._http(len(body)) + body)
    bodies = {k: inner + os.urandom(k) + warc.MAGIC * (k % 5) for k in range(12)}
    for f in range(3):
        with open(f"{path}/a{f}", "wb") as out:
            for k in range(4 * f, 4 * f + 4):
                out.write(plain(record(k, bodies[k])) + b"\0" * (k % 3))
            if f == 1:
                out.write(plain(record(99, b"lost" * 500))[:-700])
    for size in (1000, 4096, 1 << 20):
        split_bytes(size)
        rows = warc.read(spark, path).select("status", "page_id", "payload").collect()
        assert {r.page_id: bytes(r.payload) for r in rows if r.status == "ok"} == bodies
        assert sorted(r.status for r in rows) == ["broken"] + ["ok"] * 12


def test_warc_empty(spark):
    assert warc.report(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


# Merkle

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(hashes):
    """(root, siblings of every leaf as (left, right) by level)."""
    at, nodes, paths = list(range(len(hashes))), list(hashes), [[] for _ in hashes]
    while len(nodes) > 1:
        runs = [nodes[k:k + 16] for k in range(0, len(nodes), 16)]
        for leaf, p in enumerate(at):
            run = runs[p // 16]
            paths[leaf].append(("".join(run[:p % 16]), "".join(run[p % 16 + 1:])))
        at, nodes = [p // 16 for p in at], [H(*r) for r in runs]
    return nodes[0], paths


def leaf(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def merkle_rows():
    rng = random.Random(2)
    rows = [(i, "hot", "en", 5, f"Text {i} ÄB") for i in range(700)] + [(i, f"s{i % 20}", None, i, "abc" if i % 2 else "ABC é") for i in range(700, 760)]
    rows += [(1000, None, "de", None, None), (1001, None, "de", 3, ""), (None, "hot", "en", 1, "no id"), (5, "hot", "en", 5, "Text again"), (700, "s0", None, 700, "ABC é"),
             (2000, "", "fr", 1, "x" * 50_000), (2001, "ü", "fr", 1, "One leaf"), (2002, "=", "fr", 1, "Two")]
    rng.shuffle(rows)
    return rows


def merkle_expected(rows):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    held = {}
    for s in order:
        group = sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        held[s] = (group, *tree([leaf(r) for r in group]))
    root, tops = tree([held[s][1] for s in order])
    out = []
    for s, top in zip(order, tops):
        group, sub, paths = held[s]
        for r, path in zip(group, paths):
            path = path + top
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None
            now = r[:4] + ("".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]),) if bad else r
            f = leaf(now)
            for a, b in path:
                f = H(a, f, b)
            out.append((r[0], leaf(r), sub, root, H(*(a + b for a, b in path)), f, f == root))
    return sorted(out, key=str)


def test_merkle(spark):
    rows = merkle_rows()
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string") \
        .withColumns({c: F.lit("x") for c in ("t", "id", "h", "n", "lo", "hi", "part", "at", "path", "top")}).repartition(5)
    got = sorted(map(tuple, merkle.report(df).collect()), key=str)
    assert got == merkle_expected(rows)
    assert 0 < sum(not r[-1] for r in got) < len(rows) / 3
    nodes = merkle.manifest(df).collect()
    assert sum(n.level == 0 and not n.of_sources for n in nodes) == len(rows)
    # a level's intervals cover its tree without overlap
    level = sorted((n.lo, n.hi) for n in nodes if n.tree == "hot" and n.level == 1)
    assert [a for a, _ in level] == [0, *(b for _, b in level[:-1])] and level[-1][1] == 702


@pytest.mark.parametrize("n", [0, 1, 16, 17])
def test_merkle_sizes(spark, n):
    rows = [(i, "s", "en", 1, "T") for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert sorted(map(tuple, merkle.report(df).collect()), key=str) == (merkle_expected(rows) if n else [])


# hard negatives

def negatives(rows, every=50, label_of=lambda i, c: (c + 1) % 10 if i % 7 == 0 else c):
    use = []
    for i, v, c in rows:
        if i is None or v is None or c is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        use.append((i, label_of(i, c), tuple(max(-2 ** 62, min(2 ** 62, int(np.floor(256 * float(x))))) for x in v)))
    use = sorted(set(use))
    hold = lambda s: max(-9 * 10 ** 18, min(9 * 10 ** 18, s))
    out = []
    for i, c, v in use:
        if i % every:
            continue
        scored = sorted(((-hold(sum(a * b for a, b in zip(v, w))), j, d) for j, d, w in use if j != i))
        for s, j, _ in [x for x in scored if x[2] == c][:5]:
            p = -s
            window = [(-t, k) for t, k, d in scored if d != c and 50 * p <= -100 * t <= 95 * p][:3]
            out += [(i, j, r, k, p, t) for r, (t, k) in enumerate(window, 1)]
    return sorted(out)


def vectors(n=900, dim=9, seed=1):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(10, dim))
    rows = [(int(i), [float(x) for x in np.float32(centre[i % 10] + rng.normal(size=dim) * 0.7)], int(i % 10 if i % 3 else rng.integers(10))) for i in range(n)]
    rows += [(n + 50 + k, rows[50][1], 3) for k in range(300)]  # one vector many times: ties
    rows += [(2001, None, 1), (2002, [1.0, None] + [0.0] * 7, 1), (2003, [float("nan")] * 9, 1), (2004, [float("inf")] * 9, 1), (2005, [0.5] * 9, None),
             (None, [0.5] * 9, 1), (2050, [1.0, 2.0], 4), (2100, [], 5), rows[100], (100, [0.25] * 9, 2), (2150, [0.0] * 9, 6)]
    return rows


SCHEMA = "vec_id long, embedding array<float>, label int"


def test_hard_negatives(spark, monkeypatch):
    for name, value in (("CENTRES", 6), ("SHARD_ROWS", 200), ("FIRST_ROWS", 40), ("WIDER", 8)):
        monkeypatch.setattr(multi_index, name, value)
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("id", "x", "v", "k", "cell", "hits", "lo", "hi")}).repartition(4)
    out = multi_index.report(df)
    got = sorted(map(tuple, out.collect()))
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert got == negatives(rows) and len(got) > 100


def test_hard_negatives_wide_numbers(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=4) * 10.0 ** rng.integers(0, 14)], int(i % 2)) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert sorted(map(tuple, multi_index.report(df).collect())) == negatives(rows)


@pytest.mark.parametrize("rows", [[], [(0, [1.0], 1)], [(0, [1.0], 1), (1, [1.0], 1)]])
def test_hard_negatives_few_rows(spark, rows):
    assert multi_index.report(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_walk_is_in_descending_order():
    rng = np.random.default_rng(0)
    books = rng.normal(size=(5, 3)), rng.normal(size=(4, 3))
    d = multi_index.Directory(books, [(c, 1, 0.5, 0.25) for c in range(20)])
    upper, lower, half = d.bounds(np.array([3, -1, 2, 5, 0, 1]))
    walked = list(d.walk(half))
    assert sorted(c for _, c in walked) == list(range(20))
    assert [b for b, _ in walked] == sorted((b for b, _ in walked), reverse=True)
    assert all(b >= upper[c] - 1e-9 and upper[c] >= lower[c] for b, c in walked)
