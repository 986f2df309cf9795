"""Station daily text -> typed table, and station -> district code lookup.

Raw station files are line oriented.  The operators work on a lines table
``(path, line_no, line)`` -- what ``sources.readers.read_lines`` yields from
``spark.read.text(..., wholetext=True)`` + ``posexplode`` -- so every file is
split into rows by Spark and parsed with native string functions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import WS, WS_CHARS, blanks_to_space, split_blanks
from ..functions.values import safe_int

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's: the 56 column names of the
# daily station table, in file order, and the end-of-data marker.
# ---------------------------------------------------------------------------
DAILY_COLUMNS = [
    "TM", "STN", "WS_AVG", "WR_DAY", "WD_MAX", "WS_MAX", "WS_MAX_TM", "WD_INS", "WS_INS", "WS_INS_TM",
    "TA_AVG", "TA_MAX", "TA_MAX_TM", "TA_MIN", "TA_MIN_TM", "TD_AVG", "TS_AVG", "TG_MIN", "HM_AVG", "HM_MIN",
    "HM_MIN_TM", "PV_AVG", "EV_S", "EV_L", "FG_DUR", "PA_AVG", "PS_AVG", "PS_MAX", "PS_MAX_TM", "PS_MIN",
    "PS_MIN_TM", "CA_TOT", "SS_DAY", "SS_DUR", "SS_CMB", "SI_DAY", "SI_60M_MAX", "SI_60M_MAX_TM", "RN_DAY",
    "RN_D99", "RN_DUR", "RN_60M_MAX", "RN_60M_MAX_TM", "RN_10M_MAX", "RN_10M_MAX_TM", "RN_POW_MAX",
    "RN_POW_MAX_TM", "SD_NEW", "SD_NEW_TM", "SD_MAX", "SD_MAX_TM", "TE_05", "TE_10", "TE_15", "TE_30", "TE_50",
]
END_MARKER = "#7777END"


def _is_comment_or_blank(line):
    return line.rlike(f"^{WS}*(?:#|\\z)")


def _is_end_marker(line):
    return line.rlike(f"^{WS}*{END_MARKER}")


def data_lines(lines: DataFrame, leading_only: bool = False) -> DataFrame:
    """Drop help text and the end marker.

    Default: every ``#`` line and blank line is dropped.  ``leading_only=True``
    reproduces the reference exactly: only the leading run of ``#``/blank
    lines is skipped (later ``#`` lines stay and parse as junk rows), and
    every line starting with the end marker is dropped wherever it is.
    """
    line = F.col("line")
    if not leading_only:
        return lines.where(~_is_comment_or_blank(line))
    # First data line per file: a per-file min over line numbers (no collect).
    first = (lines.where(~_is_comment_or_blank(line))
                  .groupBy("path").agg(F.min("line_no").alias("_first")))
    kept = lines.join(first, "path").where(F.col("line_no") >= F.col("_first")).drop("_first")
    kept = kept.where(~_is_end_marker(line))
    # Blank lines after the first data line carry no fields; drop them too.
    return kept.where(~line.rlike(f"^{WS}*\\z"))


def _typed(lines: DataFrame, fields: Column, columns) -> DataFrame:
    """``fields`` (text without blanks around) of every line as named columns.

    Generators keep Catalyst from computing the fields, and their numbers, once
    per column.  Numbers are cast as one array: a cast per column makes a method
    that is too long for the JVM to compile.
    """
    d = lines.select("path", "line_no", F.inline(F.array(F.struct(fields.alias("_f")))))
    d = d.select("path", "line_no", "_f", F.inline(F.array(F.struct(F.col("_f").try_cast("array<double>").alias("_n")))))
    return d.select("path", "line_no", *[
        (safe_int(F.get("_f", F.lit(i))) if name in ("TM", "STN") else F.get("_n", F.lit(i))).alias(name)
        for i, name in enumerate(columns)])


def parse_daily(lines: DataFrame, columns=DAILY_COLUMNS, leading_only: bool = False) -> DataFrame:
    """Whitespace-split each data line into the named columns.

    ``TM`` and ``STN`` become int (NULL when not a whole number), the rest
    double (NULL when not numeric).  A short line is NULL-padded; extra
    fields are ignored.
    """
    d = data_lines(lines, leading_only)
    fields = split_blanks(F.col("line"))
    return _typed(d, fields, columns)


#: Positions per bitmap word of a column-edge search: below 63, so that a word
#: is a non-negative long.
EDGE_WORD = 60
#: Lines whose positions are looked at together.
EDGE_LINES = 4096


_BLANK = np.zeros(0x3002, bool)
_BLANK[[ord(c) for c in WS_CHARS]] = True


def _code_points(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points, offsets) of lines, one after the other."""
    lines = lines.cast(pa.large_binary())
    off = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset:lines.offset + len(lines) + 1]
    data = lines.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    if not len(buf) or buf.max() < 0x80:
        return buf.astype("<u4"), off - off[0]
    points = [np.frombuffer(line.decode("utf-8", "replace").encode("utf-32-le"), "<u4") for line in lines.to_pylist()]
    return np.concatenate(points), np.r_[0, np.cumsum([len(p) for p in points])]


def _edge_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, k, word): per batch and file, word ``k`` of the positions that some
    line occupies, the first position in the highest of ``EDGE_WORD`` bits."""
    weight = np.int64(1) << np.arange(EDGE_WORD - 1, -1, -1, dtype=np.int64)
    for batch in batches:
        for at in range(0, batch.num_rows, EDGE_LINES):
            part = batch.slice(at, EDGE_LINES)
            part = part.filter(part.column("path").is_valid())
            if not part.num_rows:
                continue
            points, off = _code_points(part.column("line"))
            size = np.diff(off)
            paths = part.column("path").dictionary_encode()
            file, n = paths.indices.to_numpy(), int(-(-size.max() // EDGE_WORD))
            place = np.arange(len(points)) - np.repeat(off[:-1], size) + np.repeat(file.astype(np.int64) * (n * EDGE_WORD), size)
            seen = np.zeros(len(paths.dictionary) * n * EDGE_WORD, bool)
            seen[place[~_BLANK[np.minimum(points, 0x3001)]]] = True
            words = seen.reshape(-1, EDGE_WORD) @ weight
            yield pa.RecordBatch.from_arrays([paths.dictionary.take(pa.array(np.repeat(np.arange(len(paths.dictionary)), n))),
                                              pa.array(np.tile(np.arange(n, dtype=np.int32), len(paths.dictionary))), pa.array(words)], names=["path", "k", "word"])


def column_edges(lines: DataFrame) -> DataFrame:
    """(path, spans): the columns of every file of fixed-width lines, as an
    array of (start, len), start from 1.

    A position that is blank in all lines of the file parts two columns.  A
    batch of lines becomes words of ``EDGE_WORD`` occupied / blank bits per file,
    the words of a file are combined by bit-or -- partially before the shuffle,
    so a file sends one row per task and word whatever its length -- and the
    runs of ones in the file's bits are its columns.
    """
    words = lines.select("path", F.col("line").alias("line")).mapInArrow(_edge_words, "path string, k int, word long")
    whole = words.groupBy("path", "k").agg(F.bit_or("word").alias("word")).groupBy("path").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", F.lpad(F.bin("word"), EDGE_WORD, "0").alias("b")))),
                                 lambda x: x["b"]), "").alias("_bits"))
    # The runs of ones in turn; the end of one is where the search for the next begins.
    runs = F.regexp_extract_all("_bits", F.lit("0*1+"), F.lit(0))
    start = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<start:int,len:int>>").alias("spans"))

    def add(a, run):
        size, gap = F.length(run), F.length(run) - F.length(F.ltrim(run, F.lit("0")))
        span = F.struct((a["end"] + gap + 1).alias("start"), (size - gap).alias("len"))
        return F.struct((a["end"] + size).alias("end"), F.concat(a["spans"], F.array(span)).alias("spans"))

    return whole.select("path", F.aggregate(runs, start, add, lambda a: a["spans"]).alias("spans"))


def parse_daily_widths(lines: DataFrame, columns=DAILY_COLUMNS, leading_only: bool = False, spans=None) -> DataFrame:
    """Like ``parse_daily`` for lines of fixed-width columns: a blank field is
    NULL and the fields behind it stay where they are.

    ``spans``: explicit (start, len) pairs, start from 1; by default each file's
    own are inferred from all of its data lines (``column_edges``).  A field
    beyond the columns of its file is NULL, columns beyond the names are
    ignored; a column blank in a whole file cannot be told from a gap.
    """
    d = data_lines(lines, leading_only).where(~_is_end_marker(F.col("line")))
    if spans is None:
        d = d.join(column_edges(d), "path")
    else:
        d = d.withColumn("spans", F.array(*[F.struct(F.lit(a).alias("start"), F.lit(n).alias("len")) for a, n in spans]))
    # generators keep the text and the fields from being computed once per field
    d = d.select("path", "line_no", "spans", F.inline(F.array(F.struct(blanks_to_space(F.col("line")).alias("_text")))))
    fields = F.transform("spans", lambda s: F.trim(F.substring("_text", s["start"], s["len"])))
    return _typed(d, fields, columns)


def law_id_lookup(daily: DataFrame, station_info: DataFrame, order_col: str = "ord") -> DataFrame:
    """Add ``LAW_ID`` by station: unknown station -> NULL; when a station id
    appears twice in the dimension, the later row (by ``order_col``) wins;
    rows with a NULL ``STN_ID`` are ignored row by row (no shifting)."""
    info = (station_info.where(F.col("STN_ID").isNotNull())
            .groupBy("STN_ID").agg(F.max_by("LAW_ID", order_col).alias("LAW_ID")))
    stn = safe_int(F.col("STN"))
    d = daily.withColumn("_stn", stn)
    return (d.join(info, d["_stn"] == info["STN_ID"], "left")
             .drop("_stn", "STN_ID"))


def line_numbers(df: DataFrame, path_col: str = "path", order_col: str = "ord") -> DataFrame:
    """Dense 0-based line numbers within each file, by ``order_col``."""
    w = Window.partitionBy(path_col).orderBy(order_col)
    return df.withColumn("line_no", F.row_number().over(w) - 1)
