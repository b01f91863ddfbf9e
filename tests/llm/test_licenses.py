import random
import re

from barframe.llm import licenses


def shingles(text):
    w = [x for x in re.split(r"[\W_]+", text.lower()) if x]
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)}


def brute(rows):
    out = {}
    for i, text in rows:
        mine = shingles(text or "")
        for name, notice in licenses.TEMPLATES:
            share = len(mine & shingles(notice)) / len(shingles(notice))
            if share >= licenses.CONTAINMENT:
                out[(i, name)] = max(share, out.get((i, name), 0))
    return out


def found(df):
    return {(r["doc_id"], r["license"]): r["containment"] for r in licenses.scan_licenses(df).collect()}


def test_notices_at_every_offset(make_docs, words):
    rows = []
    for name, notice in licenses.TEMPLATES:
        for offset in range(9):
            rows.append((len(rows), " ".join([*words(len(rows), offset), notice.upper() if offset % 2 else notice, *words(len(rows) + 1, 7)])))
    want = brute(rows)
    assert len(want) >= len(rows)
    assert found(make_docs(rows)) == want


def test_changed_notices_and_lone_words(make_docs, words):
    draw, rows = random.Random(1), []
    for name, notice in licenses.TEMPLATES:
        listed = notice.split()
        for _ in range(6):
            copy = list(listed)
            copy[draw.randrange(len(copy))] = "other"
            rows.append((len(rows), " ".join([*words(len(rows), 20), *copy, *words(len(rows) + 7, 20)])))
    rows += [(900 + i, " ".join(words(i, 40)) + " license under the terms") for i in range(20)]
    assert found(make_docs(rows)) == brute(rows)


def test_odd_rows(make_docs, words):
    notice = licenses.TEMPLATES[0][1]
    rows = [(1, None), (2, ""), (3, "the MIT License"), (None, notice), (4, notice), (4, notice), (5, " ".join(words(1, 20_000)) + " " + notice), (6, "--- ... ---")]
    clash = make_docs(rows).selectExpr("*", "1 as words", "2 as hashes", "3 as band", "4 as template", "5 as license")
    assert found(clash) == brute(rows)
    assert licenses.scan_licenses(make_docs(rows).limit(0)).count() == 0


def test_query_finds_every_notice_line(spark):
    from barframe.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {(r["doc_id"], r["license"]): r["containment"] for r in QUERIES["op9_license_scan"](spark, sf).collect()}
    assert got == brute(rows) and got


def test_whole_notices_and_wordings(make_docs, words):
    rows, want = [], []
    for name, notice in licenses.NOTICES:
        for offset in range(4):
            want.append((len(rows), name))
            rows.append((len(rows), " ".join([*words(len(rows), offset), re.sub(r"[\[\]]", "", notice), *words(len(rows) + 1, 7)])))
    got = found(make_docs(rows))
    assert {k: got.get(k) for k in want} == dict.fromkeys(want, 1.0)
    near = {("CC-BY-ND-4.0", "CC-BY-4.0"), ("CC-BY-NC-SA-4.0", "CC-BY-NC-4.0")}
    assert {(dict(want)[i], name) for i, name in got if dict(want)[i] != name} <= near


LESSER = """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public
# License as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version.
# This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY. See the GNU Lesser General Public License"""
GENERAL = LESSER.replace("Lesser ", "")


def test_lesser_and_affero_notices_are_not_general_ones(make_docs):
    rows = [(1, LESSER.format("3")), (2, LESSER.format("2.1")), (3, LESSER.replace("Lesser", "Affero").format("3")), (4, GENERAL.format("3")), (5, GENERAL.format("2")), (6, LESSER.format("3") + " " + GENERAL.format("3"))]
    want = {(1, "LGPL-3.0-or-later"), (2, "LGPL-2.1-or-later"), (3, "AGPL-3.0-or-later"), (4, "GPL-3.0-or-later"), (5, "GPL-2.0-or-later"), (6, "LGPL-3.0-or-later"), (6, "GPL-3.0-or-later")}
    assert set(found(make_docs(rows))) == want


def test_spdx_lines_and_terms(make_docs):
    rows = [
        (1, "x\n// SPDX-License-Identifier: MIT\nint main"),
        (2, "# spdx-license-identifier: (apache-2.0 OR EPL-2.0)"),
        (3, "/* SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 */"),
        (4, "SPDX-License-Identifier:"),
        (6, "SPDX-License-Identifier: MIT and other words"),
        (5, "It is licensed under the terms of the MIT license."),
    ]
    assert set(found(make_docs(rows))) == {(1, "MIT"), (2, "Apache-2.0"), (2, "EPL-2.0"), (3, "GPL-2.0-only"), (5, "MIT"), (6, "MIT")}
