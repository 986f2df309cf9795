"""Column edges from batches of lines, against a plain version."""

import random

from wxgrid.operators import stations


def _plain(lines):
    """(start, len) runs of positions that some line occupies."""
    taken = {i for line in lines for i, c in enumerate(line) if not c.isspace()}
    spans = []
    for i in sorted(taken):
        if spans and spans[-1][0] + spans[-1][1] == i + 1:
            spans[-1][1] += 1
        else:
            spans.append([i + 1, 1])
    return [tuple(s) for s in spans]


def test_edges_of_many_files_match_the_plain_version(spark):
    rng, files = random.Random(5), {}
    for f in range(6):
        files[f"f{f}"] = ["".join(rng.choice("ab7 \t   　 é가🌧") for _ in range(rng.choice([0, 1, 59, 60, 61, 150]))) for _ in range(rng.randint(1, 4))]
    files["plain"] = ["12   34", " 2  3 4"]
    rows = [(p, line) for p, ls in files.items() for line in ls]
    got = stations.column_edges(spark.createDataFrame(rows, "path string, line string").repartition(5)).collect()
    assert {r["path"]: [tuple(s) for s in r["spans"]] for r in got if r["spans"]} == {p: _plain(ls) for p, ls in files.items() if _plain(ls)}


def test_edges_need_no_regular_expression_per_character(spark):
    df = stations.column_edges(spark.createDataFrame([("p", "1 2")], "path string, line string"))
    assert "regexp_replace" not in df._jdf.queryExecution().analyzed().toString()
