"""Raw grid response parsing: golden cases with N = 6 (FIXTURES 1.1)."""


import pytest
from pyspark.sql import functions as F

from wxgrid.functions import text as T
from wxgrid.functions.values import clean_sentinel

CASES = [
    ("six", "1 2 3 4 5 6", [1, 2, 3, 4, 5, 6], None),
    ("header", "# comment\n3 2\n1.5, -999, 2049\n-900 2000 7", [1.5, -999, 2049, -900, 2000, 7], None),
    ("header_at_1", "9 3 2 1 2 3 4 5 6", [1, 2, 3, 4, 5, 6], None),
    ("too_few", "1 2 3 4 5", None, "too_few_values"),
    ("no_pair", "1.5 2.5 3.5 4.5 5.5 6.5 7.5", None, "count_mismatch"),
    ("header_still_wrong", "3 2 1 2 3 4 5 6 7", None, "count_mismatch"),
    ("word_skipped", "1 2 x 3 4 5 6", [1, 2, 3, 4, 5, 6], None),
    ("blank", "   \n ", None, "error_response"),
    ("html", "<html><body>x</body></html>", None, "error_response"),
    ("forbidden", "Forbidden", None, "error_response"),
    ("error_word", "error: x", None, "error_response"),
    ("hash_error_is_data", "# error\n1 2 3 4 5 6", [1, 2, 3, 4, 5, 6], None),
    ("only_comments", "# a\n# b", None, "empty"),
    ("nan_in_header_scan", "nan 3 2 1 2 3 4 5 6", None, "non_finite_header"),
    ("underscore_digits", "1_000 2 3 4 5 6", [1000, 2, 3, 4, 5, 6], None),
    ("java_only_forms_skipped", "1d 1 2 3 4 5 6", [1, 2, 3, 4, 5, 6], None),
]


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame([(n, t) for n, t, _, _ in CASES], "name string, text string")
    rows = df.select("name", T.parse_response(F.col("text"), F.lit(6)).alias("p")).collect()
    return {r["name"]: r["p"] for r in rows}


@pytest.mark.parametrize("name,text,values,reason", CASES, ids=[c[0] for c in CASES])
def test_golden(parsed, name, text, values, reason):
    got = parsed[name]
    assert got["reason"] == reason
    if values is None:
        assert got["vals"] is None
    else:
        assert [float(v) for v in got["vals"]] == [float(v) for v in values]


def test_sentinels(spark):
    df = spark.createDataFrame([(v,) for v in [-901.0, -900.0, 0.0, 2000.0, 2000.5, float("nan"),
                                               float("inf"), float("-inf")]], "v double")
    got = [r[0] for r in df.select(clean_sentinel(F.col("v"))).collect()]
    assert got == [None, -900.0, 0.0, 2000.0, None, None, None, None]


def test_no_expected_count_accepts_any(spark):
    df = spark.createDataFrame([("1 2 3",), ("# only",)], "text string")
    got = [r[0] for r in df.select(T.grid_values(F.col("text"), None)).collect()]
    assert got[0] == [1.0, 2.0, 3.0] and got[1] is None


def test_preview_and_snippets(spark):
    text = "\n".join(f"line{i}" for i in range(40)) + "\n"
    df = spark.createDataFrame([(text,), ("a\r\nb",), ("",)], "t string")
    lines = T.split_lines(F.col("t"))
    rows = df.select(F.size(lines).alias("n"), T.snippet_head(lines).alias("h"),
                     T.snippet_tail(lines).alias("tl"), T.preview(F.col("t")).alias("p")).collect()
    assert rows[0]["n"] == 40
    assert rows[0]["h"].split("\n") == [f"line{i}" for i in range(30)]
    assert rows[0]["tl"].split("\n") == [f"line{i}" for i in range(10, 40)]
    assert "\n" not in rows[0]["p"] and len(rows[0]["p"]) <= 500
    assert rows[1]["n"] == 2 and rows[1]["tl"] == ""
    assert rows[2]["n"] == 0


def test_error_head_only_first_400_chars(spark):
    late = "1 2 3 " * 100 + "error"
    df = spark.createDataFrame([(late,), ("  \t FORBIDDEN",), (None,)], "t string")
    got = [r[0] for r in df.select(T.is_error_response(F.col("t"))).collect()]
    assert got == [False, True, True]
