"""Licence notices wrapped at 70 columns, in comments, are told apart."""

import textwrap

from wxgrid.llm import license_scan

FREE = ("This program is free software{}; you can redistribute it and/or modify it under the terms of the GNU {}General Public License as "
        "published by the Free Software Foundation; either version {} of the License, or (at your option) any later version.")
HEADERS = {
    "GPL-2.0": FREE.format("", "", "2"),
    "GPL-3.0": FREE.format("", "", "3"),
    "AGPL-3.0": FREE.format("", "Affero ", "3"),
    "LGPL": FREE.format("", "Lesser ", "2.1").replace("program", "library"),
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
}


def test_wrapped_headers(spark):
    rows, expect = [], {}
    for family, text in HEADERS.items():
        for width, mark in ((70, ""), (76, " * "), (72, "# "), (60, "// ")):
            lines = textwrap.wrap(text, width - len(mark))
            assert len(lines) > 1
            body = "\n".join(mark + x for x in ["some file of the project", "", *lines, "", "and what it does"])
            expect[len(rows)] = family
            rows.append((len(rows), body if mark != "# " else body.replace("\n# \n", "\n")))
    rows += [(k, f"ordinary words number {k}\nand of the day\n\nwith more lines\nof words") for k in range(100, 150)]
    got = {r.doc_id: r for r in license_scan.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k: got[k].families for k in expect} == expect
    assert all(got[k].families == "" and got[k].n_paragraphs == 2 for k in range(100, 150))


def test_any_width(spark):
    """A notice is found whole however narrow it is wrapped, also when it starts
    behind other words of its first line."""
    rows, expect = [], {}
    for family in ("GPL-2.0", "GPL-3.0", "AGPL-3.0", "LGPL"):
        for width in (8, 20, 24, 32, 40, 55, 80, 100, 120):
            lines = textwrap.wrap(HEADERS[family], width, break_long_words=False)
            expect[len(rows)] = family
            rows.append((len(rows), "\n".join(["before", "", *lines, "", "behind"])))
    rows += [(k, f"ordinary words number {k}\nand of the day\n\nwith more lines\nof words") for k in range(100, 150)]
    got = {r.doc_id: r for r in license_scan.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k: got[k].families for k in expect} == expect
