"""Text functions for raw grid responses, as native Column expressions.

Python's ``str.strip``/``split``/``splitlines`` treat more characters as
whitespace than Spark's ``trim`` (spaces only), so the helpers below use an
explicit whitespace class.  All of it runs inside the JVM: regex, split,
and higher-order array functions -- no Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python treats as whitespace in str.strip() / str.split().
WS = (r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
# The same set as plain characters (derived from Python's own definition),
# for ``translate``: mapping them all to a space lets a split use the cheap
# pattern " +" instead of a wide character class.
WS_CHARS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def blanks_to_space(c: Column) -> Column:
    return F.translate(c, WS_CHARS, " " * len(WS_CHARS))


def split_blanks(c: Column) -> Column:
    """Python ``str.split()``: fields separated by any whitespace run."""
    return F.filter(F.split(blanks_to_space(c), " +"), lambda t: F.length(t) > 0)


# Line breaks of Python's str.splitlines().
LINE_BREAK = r"\r\n|[\n\r\x{0B}\f\x{1C}-\x{1E}\x{85}\x{2028}\x{2029}]"

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
#   error-response markers looked for in the first 400 characters
#   (lower-cased, after strip): "<html", "<!doctype html", "forbidden",
#   "unauthorized"; "error" counts only when the head has no "#".
#   preview length 500 characters; snippet head/tail 30 lines each;
#   the grid header pair is searched in the first 20 numbers.
# ---------------------------------------------------------------------------
ERROR_HEAD_CHARS = 400
ERROR_MARKERS = ("<html", "<!doctype html", "forbidden", "unauthorized")
ERROR_WORD = "error"
PREVIEW_CHARS = 500
SNIPPET_LINES = 30
HEADER_SCAN = 20

# Python float() syntax: digits may be grouped with single underscores.
_DIGITS = r"[0-9](?:_?[0-9])*"
NUMBER_RE = rf"^[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?$"
SPECIAL_RE = r"(?i)^[+-]?(?:inf|infinity|nan)$"


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    Catalyst inlines a projected column into every expression that reads
    it, so a costly intermediate (the token array of a 29 MB response) used
    several times would be recomputed each time.  Binding it through a
    one-element ``transform`` evaluates it once per row.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def parse_response(text: Column, n_expected: Column | None) -> Column:
    """struct<vals: array<double>, reason: string> for one response: the
    validated values (NULL when rejected) and the rejection reason (NULL
    when accepted).  The text is tokenised exactly once."""
    empty = F.array().cast("array<double>")

    def with_err(err):
        def with_toks(toks):
            def with_cut(cut):
                def with_acc(acc):
                    return F.struct(acc.alias("vals"),
                                    reject_reason_of(err, toks, cut, acc, n_expected).alias("reason"))
                return let(F.when(~err, accepted_values(toks, cut, n_expected)), with_acc)
            cut = header_cut(toks, n_expected) if n_expected is not None else F.lit(0)
            return let(cut, with_cut)
        return let(F.when(~err, tokenize_numbers(text)).otherwise(empty), with_toks)
    return let(is_error_response(text), with_err)


def is_error_response(text: Column) -> Column:
    """True for a blank / missing response or an HTML / error page.

    Only the first 400 characters after leading whitespace are examined.
    The leading run is measured with one anchored match, so a long text is
    never scanned in full; dropping trailing whitespace cannot change a
    marker test (no marker starts or ends with whitespace).
    """
    def with_lead(lead):
        def with_head(head):
            # the markers are ASCII, and no other letter's lower case is one of theirs
            marked = head.rlike("(?i)" + "|".join(ERROR_MARKERS))
            return marked | (head.rlike(f"(?i){ERROR_WORD}") & ~head.contains("#"))
        return F.when(F.length(text) == lead, F.lit(True)) \
                .otherwise(let(F.substring(text, lead + 1, ERROR_HEAD_CHARS), with_head))
    return F.when(text.isNull(), F.lit(True)) \
            .otherwise(let(F.length(F.regexp_extract(text, f"^{WS}*", 0)), with_lead))


def parse_number(tok: Column) -> Column:
    """One token -> double with Python ``float`` syntax, NULL if not a number.

    Fast path: Spark's cast, accepted when the token has none of the letters
    Java allows but Python does not (``1d``, ``1f``, hex floats) and is not a
    word (inf/nan, handled below).  Underscore-grouped digits go through the
    full pattern.  NULL means "skip this token"; NaN and +-inf are numbers
    here (the sentinel rule nulls them later).
    """
    c = tok.try_cast("double")
    plain = F.length(F.translate(tok, "dDfFxXpPiInN_", "")) == F.length(tok)
    special = F.when(F.lower(tok).rlike(r"^[+-]?nan$"), F.lit(float("nan"))).otherwise(c)
    return (F.when(plain, c)
             .when(tok.contains("_") & tok.rlike(NUMBER_RE), F.regexp_replace(tok, "_", "").try_cast("double"))
             .when(tok.rlike(SPECIAL_RE), special))


# Letters that Java's number syntax accepts and Python's does not (or the
# reverse: underscores, and the words inf / nan).  A response without any of
# them can be cast token by token with Spark's own cast.
_NON_PLAIN = "dDfFxXpPiInN_"


def tokenize_numbers(text: Column) -> Column:
    """All numeric tokens of the data lines, in order (commas count as blanks).

    Comment lines are removed with one multiline pattern, commas and every
    whitespace character become spaces, and the text is split once.  When
    the remaining text has none of the letters that tell Java's and Python's
    number syntax apart, the token array is cast as a whole (vectorised,
    no lambda); otherwise each token goes through ``parse_number``.
    """
    body = F.regexp_replace(text, f"(?md)^{WS}*#[^\n]*", "")
    flat = F.trim(F.translate(body, "," + WS_CHARS, " " * (len(WS_CHARS) + 1)))
    toks = F.split(flat, " +")
    plain = F.length(F.translate(flat, _NON_PLAIN, "")) == F.length(flat)
    return F.when(plain, F.array_compact(toks.try_cast("array<double>"))) \
            .otherwise(F.array_compact(F.transform(toks, parse_number)))


def _finite(x: Column) -> Column:
    return ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))


def header_cut(values: Column, n_expected: Column) -> Column:
    """Number of leading tokens to drop as an ``nx ny`` header, or -1 to reject.

    Only when there are more numbers than expected: look at adjacent pairs
    among the first 20 numbers for two whole numbers whose product is the
    expected count and cut through the pair.  A NaN/inf met while scanning
    (the first of a pair, or the second after a whole first) rejects the
    response; no pair found means no cut.
    """
    n = F.size(values)
    idx = F.when(n >= 2, F.sequence(F.lit(0), F.least(F.lit(HEADER_SCAN - 1), n - 2))) \
           .otherwise(F.array().cast("array<int>"))

    def event(i):
        a = F.try_element_at(values, i + 1)
        b = F.try_element_at(values, i + 2)
        a_whole = _finite(a) & (a == F.floor(a))
        bad = ~_finite(a) | (a_whole & ~_finite(b))
        found = a_whole & _finite(b) & (b == F.floor(b)) & ((a * b) == n_expected.cast("double"))
        return F.when(bad, F.lit(-1)).when(found, i + 2)

    events = F.filter(F.transform(idx, event), lambda e: e.isNotNull())
    return F.when(n <= n_expected, F.lit(0)).otherwise(F.coalesce(F.try_element_at(events, F.lit(1)), F.lit(0)))


def accepted_values(vals: Column, cut: Column, n_expected: Column | None) -> Column:
    """Validated value array from the token array and its header cut, or
    NULL when rejected: no numbers; fewer numbers than expected; a NaN/inf
    in the header scan; a count that still differs after removing a header.
    With no expected count, every non-empty token list is accepted."""
    if n_expected is None:
        return F.when(F.size(vals) > 0, vals)
    kept = F.when(cut > 0, F.slice(vals, cut + 1, F.greatest(F.size(vals) - cut, F.lit(0)))).otherwise(vals)
    ok = (F.size(vals) > 0) & (cut >= 0) & (F.size(kept) == n_expected)
    return F.when(ok, kept)


def grid_values(text: Column, n_expected: Column | None) -> Column:
    """One-expression form of tokenize + header cut + count check, for a
    single result.  ``parse_response`` gives values and the rejection
    reason together with the text tokenised once."""
    vals = tokenize_numbers(text)
    cut = header_cut(vals, n_expected) if n_expected is not None else F.lit(0)
    return accepted_values(vals, cut, n_expected)


def reject_reason_of(is_error: Column, vals: Column, cut: Column, accepted: Column,
                     n_expected: Column | None) -> Column:
    """Why a response is quarantined (NULL when accepted), from the
    step-wise columns."""
    base = F.when(is_error, F.lit("error_response")).when(F.size(vals) == 0, F.lit("empty"))
    if n_expected is None:
        return base
    return (base.when(F.size(vals) < n_expected, F.lit("too_few_values"))
                .when(cut < 0, F.lit("non_finite_header"))
                .when(accepted.isNull(), F.lit("count_mismatch")))


def split_lines(text: Column) -> Column:
    """Python ``str.splitlines()``: no trailing empty line after a final break."""
    parts = F.split(text, LINE_BREAK)
    n = F.size(parts)
    trailing = text.rlike(f"(?:{LINE_BREAK})$")
    return F.when(F.length(text) == 0, F.array().cast("array<string>")) \
            .when(trailing, F.slice(parts, 1, F.greatest(n - 1, F.lit(1)))).otherwise(parts)


def preview(text: Column) -> Column:
    """First 500 characters with newlines as spaces."""
    return F.substring(F.regexp_replace(text, "\n", " "), 1, PREVIEW_CHARS)


def snippet_head(lines: Column) -> Column:
    return F.array_join(F.slice(lines, 1, SNIPPET_LINES), "\n")


def snippet_tail(lines: Column) -> Column:
    """Last 30 lines, only when there are more than 30 (may overlap the head)."""
    return F.when(F.size(lines) > SNIPPET_LINES,
                  F.array_join(F.slice(lines, -SNIPPET_LINES, SNIPPET_LINES), "\n")).otherwise(F.lit(""))
