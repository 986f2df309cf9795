"""Randomised check of the response parser against a plain-Python
statement of the rules (Python float syntax, comment lines, header pair
search in the first 20 numbers, strict count)."""

import math
import random

import pytest
from pyspark.sql import functions as F

from wxgrid.functions import text as T

POOL = ["0", "1", "2", "3", "6", "12", "-3", "-2", "1.5", "-999", "2049", "2000", "-900.0", ".5", "7.",
        "1e2", "-1E-1", "nan", "NaN", "inf", "-Infinity", "1_000", "1__0", "_1", "1d", "2f", "0x1p3",
        "x", "abc", "--1", "+4", "1e", "ERROR", "#"]


def py_numbers(text):
    """Numbers of the non-comment lines, Python float syntax, others skipped."""
    def number(tok):
        try:
            return float(tok)
        except ValueError:
            return None
    data = (ln for ln in text.strip().split("\n") if ln.strip() and ln.strip()[0] != "#")
    found = (number(tok) for ln in data for tok in ln.replace(",", " ").split())
    return [x for x in found if x is not None]


def _whole(x):
    return math.isfinite(x) and x.is_integer()


def py_parse(text, n):
    """Rules: exact count accepted; fewer rejected; more: look at
    adjacent pairs among the first 20 numbers -- a non-finite first number,
    or a whole first number followed by a non-finite one, rejects; the first
    pair of whole numbers with product n is cut with everything before it;
    afterwards the count must be exact."""
    nums = py_numbers(text)
    if not nums or len(nums) < n:
        return None
    if len(nums) > n:
        pairs = list(zip(nums[:20], nums[1:21]))
        for pos, (a, b) in enumerate(pairs):
            if not math.isfinite(a) or (_whole(a) and not math.isfinite(b)):
                return None
            if _whole(a) and _whole(b) and round(a) * round(b) == n:
                nums = nums[pos + 2:]
                break
    return nums if len(nums) == n else None


def gen(rng):
    lines = []
    for _ in range(rng.randint(0, 4)):
        if rng.random() < 0.2:
            lines.append(rng.choice(["# c", "  # x 1 2", ""]))
            continue
        toks = [rng.choice(POOL) for _ in range(rng.randint(0, 6))]
        sep = rng.choice([" ", ", ", "\t", " ,"])
        lines.append(rng.choice(["", "  "]) + sep.join(toks))
    return "\n".join(lines)


def same(a, b):
    if a is None or b is None:
        return a is None and b is None
    return len(a) == len(b) and all((math.isnan(x) and math.isnan(y)) or x == y for x, y in zip(a, b))


@pytest.mark.parametrize("seed", [7, 11])
def test_parser_matches_rules(spark, seed):
    rng = random.Random(seed)
    cases = []
    for _ in range(400):
        t = gen(rng)
        k = len(py_numbers(t))
        n = rng.choice([max(k, 1), max(k - 2, 1), max(k - 1, 1), 6])
        cases.append((t, n))
    df = spark.createDataFrame(cases, "text string, n int")
    got = df.select("text", "n", T.parse_response(F.col("text"), F.col("n")).alias("p"),
                    T.tokenize_numbers(F.col("text")).alias("toks")).collect()
    for r in got:
        assert same(list(r["toks"]), py_numbers(r["text"])), r["text"]
        if not T_is_error(r["text"]):
            assert same(r["p"]["vals"], py_parse(r["text"], r["n"])), (r["text"], r["n"])


def T_is_error(text):
    """Blank, or the first 400 characters (lower case) hold an HTML / auth
    marker, or the word error without any '#'."""
    head = text.strip()[:400].lower()
    markers = ("<html", "<!doctype html", "forbidden", "unauthorized")
    return head == "" or any(m in head for m in markers) or ("error" in head and "#" not in head)
