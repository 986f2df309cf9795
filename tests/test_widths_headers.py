"""Fixed-width station lines, per-file CSV headers, files that cannot be used."""

from wxgrid.operators import stations
from wxgrid.sources import readers as R


def _lines(spark, files):
    return spark.createDataFrame([(p, i, t) for p, texts in files.items() for i, t in enumerate(texts)], "path string, line_no long, line string")


def test_blank_fields_stay_in_their_column(spark):
    wide = " " * 130
    lines = _lines(spark, {"a": ["# help with words   across", "20240101  108   1.5   7.0", "20240102  108         8.0", "20240103   90  -2.5", "#7777END,,,"],
                           "b": ["20250101 1 " + wide + "3.25", "20250102 2"], "c": ["# only help", ""]})
    got = {(r.path, r.TM): (r.STN, r.x, r.y) for r in stations.parse_daily_widths(lines, ["TM", "STN", "x", "y"]).collect()}
    assert got == {("a", 20240101): (108, 1.5, 7.0), ("a", 20240102): (108, None, 8.0), ("a", 20240103): (90, -2.5, None),
                   ("b", 20250101): (1, 3.25, None), ("b", 20250102): (2, None, None)}
    plain = {r.TM: r.x for r in stations.parse_daily(lines, ["TM", "STN", "x", "y"]).where("path = 'a'").collect()}
    assert plain[20240102] == 8.0   # the blank-separated mode shifts it


def test_edges_and_explicit_spans(spark):
    lines = _lines(spark, {"a": ["ab  c" + " " * 55 + "d", " bc  " + "\t" * 55 + "dd"], "e": [""]})
    got = {r.path: [tuple(s) for s in r.spans] for r in stations.column_edges(lines).collect()}
    assert got == {"a": [(1, 3), (5, 1), (61, 2)]}
    rows = stations.parse_daily_widths(_lines(spark, {"a": ["2024010110812", "20240102   13"]}), ["TM", "STN", "x"], spans=[(1, 8), (9, 3), (12, 2)]).orderBy("TM").collect()
    assert [(r.TM, r.STN, r.x) for r in rows] == [(20240101, 108, 12.0), (20240102, None, 13.0)]


def _write(tmp_path, files):
    for name, text in files.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    return str(tmp_path)


FILES = {"aws_2020.csv": "\ufeffTM,STN,RN_DAY\n20200101,1,0.5\n20200102,1,\n", "aws_2021.csv": "STN,RN_DAY,TM,note\n2,1.5,20210101,\"a, b\"\n",
         "aws_2022.csv": "TM,STN\r\n20220101,3\r\n", "aws_2023.csv": "", "aws_2024.csv": "TM,RN_DAY\n20240101,9\n", "plain.csv": "TM,STN\n20250101,5\n"}


def test_each_file_by_its_own_header(spark, tmp_path):
    path = _write(tmp_path, FILES)
    df = R.read_station_tables(spark, path)
    got = sorted((r.year, r.TM, r.STN, r.RN_DAY, r.note) for r in df.where("STN is not null").collect())
    assert got == [(2020, "20200101", "1", "0.5", None), (2020, "20200102", "1", None, None), (2021, "20210101", "2", "1.5", "a, b"), (2022, "20220101", "3", None, None)]


def test_unusable_files_are_listed(spark, tmp_path):
    path = _write(tmp_path, FILES)
    got = sorted((r.path.rsplit("/", 1)[1], r.year, r.error) for r in R.failed_tables(spark, path).collect())
    assert got == [("aws_2023.csv", 2023, "empty file"), ("aws_2024.csv", 2024, "no column STN"), ("plain.csv", None, "no year in the file name")]


def test_stations_without_a_row(spark):
    lines = _lines(spark, {"good": ["20240101 1"], "help": ["# x"], "junk": ["no date here"]})
    files = spark.createDataFrame([("good",), ("help",), ("junk",), ("empty",)], "path string")
    got = {r.path: r.error for r in R.failed_stations(files, stations.parse_daily(lines)).collect()}
    assert got == {"help": "no data line", "empty": "no data line", "junk": "no line with a date and a station"}


def test_edges_send_partial_rows(spark):
    """The bit-or of a file's lines is partial before its shuffle."""
    lines = _lines(spark, {"a": ["1 2"]}).repartition(4)
    plan = stations.column_edges(lines)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_bit_or") == 1
