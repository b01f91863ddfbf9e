import hashlib
import random
import re

import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barframe.llm import fillmiddle as fm

UNITS = regex.compile(f"({fm.LINES})*")


def brute(doc_id, text, rate=100, spm=50, seed=7):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(lines), "plain", None, None, text
    a, b = sorted(x % (len(lines) + 1) for x in h[:2])
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h[3] % 100 < spm:
        return len(lines), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(lines), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab\n\r<P>SM é🙂\x85 ", max_size=40), st.integers(0, 10**6))
def test_any_text(text, doc_id):
    assert fm.rearrange(text, fm.draws(doc_id, 7), UNITS, 100, 50) == brute(doc_id, text)


ODD = [
    (1, None), (2, ""), (3, "\n"), (4, "\n\n\n"), (5, "one line"), (6, "a\nb"), (7, "a\nb\n"), (8, "x <P> y\nz"), (9, "<M>"), (10, "< P>\n<S\n>"), (11, "<S<S\n<P"),
    (12, "é🙂\n中文\r\nz"), (None, "no\nid\nhere"), (13, "a\nb\nc"), (13, "a\nb\nc"), (14, "w " * 400_000), (15, "line\n" * 100_000), (16, "\n" * 3 + "x"),
]


@pytest.mark.parametrize("rate, spm", [(100, 50), (40, 10), (0, 50)])
def test_against_brute_force(make_docs, rate, spm):
    draw = random.Random(6)
    rows = ODD + [(100 + i, "".join(draw.choice("ab\n <") for _ in range(draw.randint(0, 60)))) for i in range(300)]
    got = fm.fill_in_middle(make_docs(rows), rate=rate, spm=spm).withColumn("back", fm.restored())
    want = [(i, *brute(i, t, rate, spm), t or "") for i, t in rows]
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "back"]
    assert sorted(map(str, (tuple(r[c] for c in names) for r in got.collect()))) == sorted(map(str, want))


def test_other_units(make_docs):
    got = fm.fill_in_middle(make_docs([(i, "one two  three") for i in range(50)]), unit=r"\s*+\S++|\s++").withColumn("back", fm.restored()).collect()
    assert {r["n"] for r in got} == {3} and {r["back"] for r in got} == {"one two  three"} and len({r["output"] for r in got}) > 5


def test_clashing_columns_and_empty_table(make_docs):
    docs = make_docs(ODD).selectExpr("*", "1 as n", "2 as form", "3 as output", "4 as OUTPUT_sha256", "5 as kept")
    got = fm.fill_in_middle(docs)
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "OUTPUT_sha256", "kept", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert got.where(fm.restored().isNull()).count() == 0
    assert fm.fill_in_middle(docs.limit(0)).collect() == []
    named = make_docs(ODD).select(F.col("doc_id"), F.col("text").alias("output"))
    assert fm.fill_in_middle(named, text="output").count() == len(ODD)
