"""Landed documents: activity snapshots, constituents and pages."""

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from barframe.fixed_values import INDICES, SNAPSHOT_PATHS, SPLIT_DOCUMENT
from barframe.operators import memberships as mb
from barframe.operators import screens
from barframe.operators import sentiment as st
from barframe.plans.activity import read_activity
from barframe.plans.constituents import index_catalog, membership_table, read_index_documents, read_memberships
from barframe.sources.records import (
    all_records,
    discover_fields,
    expand_fields,
    extract_records,
    read_snapshots,
    split_document,
)
from barframe.sources.sinks import write_activity

RECORDS = {
    "Most Active by Value": [{"symbol": "A", "lastPrice": 10.5, "meta": {"x": 1}}, {"symbol": "A", "lastPrice": 10.5, "meta": {"x": 1}}],
    "Volume Gainers": [],
    "Most Active by Volume": [{"symbol": "B", "quantity": 7, "note": "[odd"}],
    "Top Gainers": [{"symbol": "A", "perChange": 3}],
    "Top Losers": [{"symbol": "C", "perChange": -3.5, "tags": [1, 2]}],
}


@pytest.fixture
def catalog(tmp_path):
    out = {}
    for category, records in RECORDS.items():
        doc = {"data": records} if SNAPSHOT_PATHS[category] == "$.data" else {"allSec": {"data": records, "n": 1}}
        out[category] = tmp_path / f"{len(out)}.json"
        out[category].write_text(json.dumps({"as_on": "x", **doc}, indent=1))
    deals = {"as_on_date": "d", "BULK_DEALS_DATA": [{"symbol": "D", "qty": "100"}], "BLOCK_DEALS_DATA": [],
             "SHORT_DEALS_DATA": [{"symbol": "A", "qty": None}, {"qty": "5", "symbol": "E"}]}
    out[SPLIT_DOCUMENT] = tmp_path / "deals.json"
    out[SPLIT_DOCUMENT].write_text(json.dumps(deals))
    return {c: str(p) for c, p in out.items()}


def test_activity(spark, catalog, tmp_path):
    df = read_activity(spark, catalog)
    assert df.columns == ["symbol", "lastPrice", "meta", "quantity", "note", "perChange", "tags", "qty", "Reason", "relavant_columns"]
    got = [tuple(r) for r in df.collect()]
    assert len(got) == 8
    by_reason = {}
    for r in df.collect():
        by_reason.setdefault(r["Reason"], []).append(r)
    first = by_reason["Most Active by Value"]
    assert [(r["symbol"], r["lastPrice"], r["meta"]) for r in first] == [("A", 10.5, None)] * 2  # copies stay, nested is NULL
    assert first[0]["relavant_columns"] == "symbol, lastPrice, meta"
    assert by_reason["Most Active by Volume"][0]["note"] == "[odd"
    assert by_reason["Top Losers"][0]["tags"] is None and by_reason["Top Losers"][0]["perChange"] == -3.5
    assert [r["relavant_columns"] for r in by_reason["Short Deals Data"]] == ["symbol, qty", "qty, symbol"]
    assert "Block Deals Data" not in by_reason and "Volume Gainers" not in by_reason
    reasons = {r["symbol"]: (r["reasons"], r["reason_count"]) for r in screens.reasons_by_stock(df).collect()}
    assert reasons["A"] == (["Most Active by Value", "Short Deals Data", "Top Gainers"], 3)
    write_activity(df, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 8


def test_missing_category_is_an_error(spark, catalog):
    del catalog["Top Losers"]
    with pytest.raises(ValueError, match="Top Losers"):
        read_activity(spark, catalog)


def test_missing_file_is_an_error(spark, catalog):
    with pytest.raises(AnalysisException):
        read_snapshots(spark, {**catalog, "Top Losers": "/nowhere/x.json"}).count()


@pytest.mark.parametrize("text", ['{"data": [{"symbol": "A"}', '{"allSec": {}}', "{}", "", '{"data": null, "allSec": {"data": null}}'])
@pytest.mark.parametrize("category", ["Volume Gainers", "Top Gainers", SPLIT_DOCUMENT])
def test_unreadable_documents_are_an_error(spark, catalog, category, text):
    with open(catalog[category], "w") as file:
        file.write(text)
    docs = read_snapshots(spark, catalog)
    with pytest.raises(Exception, match="in the document of category"):
        all_records(docs).collect()
    one = split_document if category == SPLIT_DOCUMENT else extract_records
    with pytest.raises(Exception, match="in the document of category"):
        one(docs).collect()
    assert all_records(docs, strict=False).count() < 9


def test_keys_with_quotes_and_backticks(spark):
    record = {"it's": 1, 'say "x"': 2.5, "a`b": "t", "both'\"": 3, "plain": {"n": 1}}
    df = spark.createDataFrame([(0, json.dumps(record))], "pos int, raw string")
    fields = discover_fields(df)
    assert fields == [("it's", "bigint"), ('say "x"', "double"), ("a`b", "string"), ("both'\"", "string"), ("plain", "string")]
    row = expand_fields(df, fields).first()
    assert [row[n] for n, _ in fields] == [1, 2.5, "t", "3", None]
    docs = spark.createDataFrame([("NIFTY 50", json.dumps({"data": [{**record, "symbol": "S"}]}))], "index_name string, doc string")
    assert membership_table(docs).first()["a`b"] == "t"


def test_fields_and_types(spark, catalog):
    records = extract_records(read_snapshots(spark, catalog))
    fields = dict(discover_fields(records, ("category", "pos")))
    assert fields["lastPrice"] == "double" and fields["quantity"] == "bigint" and fields["meta"] == "string"
    text = expand_fields(records, [("meta", "string")], nested="text").where("meta is not null").first()
    assert json.loads(text["meta"]) == {"x": 1}


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2.0)], "b string, c double")
    got = screens.union_categories(a, b, a)
    assert got.columns == ["a", "b", "c"] and got.count() == 3


def test_ranked_screen(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 3.0), ("d", None)], "symbol string, m double")
    assert [r["symbol"] for r in screens.ranked_screen(df, "m", 3).collect()] == ["c", "a", "b"]
    assert [r["symbol"] for r in screens.ranked_screen(df, "m", 2, ascending=True).collect()] == ["a", "b"]


def test_close_change(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 3.0), ("b", 1, 1.0), ("c", 1, 0.0), ("c", 2, 1.0)],
                               "symbol string, ts int, close double")
    assert [tuple(r) for r in screens.close_change(df).collect()] == [("a", 3.0, 0.5)]


CONSTITUENTS = {
    "NIFTY 50": [{"symbol": "nifty 50", "x": 1}, {"symbol": "M", "Index": "mine", "Stock": "s"}, {"symbol": None}],
    "NIFTY MIDCAP 50": [{"symbol": "M", "x": 2}, {"symbol": "NIFTY MIDCAP 50"}],
    "NIFTY SMALLCAP 50": [{"symbol": "M"}, {"symbol": "S"}, {"x": 3}],
    "NIFTY IT": [],
    "OTHER": [{"symbol": "Z"}],
}


@pytest.fixture
def landed(tmp_path):
    for name, records in CONSTITUENTS.items():
        folder = tmp_path / "landed" / f"index_name={name}"
        folder.mkdir(parents=True)
        (folder / "doc.json").write_text(json.dumps({"name": name, "data": records}))
    return str(tmp_path / "landed")


def test_memberships(spark, landed):
    df = membership_table(read_index_documents(spark, landed))
    assert df.columns == ["Stock", "Index Type", "Index", "symbol", "x", "Market Cap Classification"]
    got = {(r["Index"], r["Stock"]): r["Market Cap Classification"] for r in df.collect()}
    assert got == {
        ("NIFTY 50", "M"): "Mid Cap", ("NIFTY 50", None): "Small Cap", ("NIFTY MIDCAP 50", "M"): "Mid Cap",
        ("NIFTY MIDCAP 50", "NIFTY MIDCAP 50"): "Mid Cap", ("NIFTY SMALLCAP 50", "M"): "Mid Cap",
        ("NIFTY SMALLCAP 50", "S"): "Small Cap", ("NIFTY SMALLCAP 50", None): "Small Cap",
    }
    summary = mb.cap_summary(df).first()
    assert tuple(summary) == (3, 0, 4, 3)
    coverage = mb.index_coverage(df, index_catalog(spark)).first()
    assert tuple(coverage) == (3, len(INDICES))


def test_read_memberships(spark, landed):
    got = read_memberships(spark, landed, ["NIFTY 50", "NIFTY IT"])
    assert sorted((r["index_name"], r["pos"]) for r in got.collect()) == [("NIFTY 50", i) for i in range(3)]


def test_membership_fields_given(spark, landed):
    df = membership_table(read_index_documents(spark, landed, ["NIFTY MIDCAP 50"]), [("x", "bigint")])
    assert {r["x"] for r in df.collect()} == {2, None}


def page(*anchors):
    return "<html><body>" + "".join(anchors) + "</body></html>"


PAGES = [
    (0, page()),
    (1, page(*[f'<a class="DY5T1d" href="{i}">h{i}</a>' for i in range(11)])),
    (2, page('<a class="x DY5T1d y">Stocks <b>rally</b> &amp; crash</a>', '<a class="DY5T1dx">other</a>', "<a>none</a>",
             "<abbr class='DY5T1d'>no</abbr>", "<A CLASS='DY5T1d'>Update on fall</A>")),
    (3, page('<a class="DY5T1d">sell-off\nwidens</a>')),
]


@pytest.mark.parametrize("nodes", [st.html_nodes, st.pattern_html_nodes])
def test_headlines(spark, nodes):
    df = spark.createDataFrame(PAGES, "page_id int, html string")
    got = {(r["page_id"], r["pos"]): r["text"] for r in nodes(df).collect()}
    assert sum(p == 1 for p, _ in got) == 10 and got[1, 9] == "h9"
    assert {k: v for k, v in got.items() if k[0] != 1} == {
        (2, 0): "Stocks rally & crash", (2, 1): "Update on fall", (3, 0): "sell-off\nwidens",
    }


def test_parser_skips_comments_and_nests(spark):
    html = '<!-- <a class="DY5T1d">no</a> --><a class="DY5T1d">o<span class="DY5T1d">i</span></a>'
    df = spark.createDataFrame([(1, html), (2, None)], "page_id int, html string")
    assert [r["text"] for r in st.html_nodes(df).collect()] == ["oi"]


@pytest.mark.parametrize("nodes", [st.html_nodes, st.pattern_html_nodes])
def test_character_references(spark, nodes):
    html = '<a class="DY5T1d">Nifty&#8217;s &ndash; up &#x20B9;5 &eacute;&amp;lt; &nosuch;</a><a class="DY5T1d">&copy</a>'
    got = [r["text"] for r in nodes(spark.createDataFrame([(1, html)], "page_id int, html string")).orderBy("pos").collect()]
    assert got == ["Nifty’s – up ₹5 é&lt; &nosuch;", "©"]


def test_anchors_inside_anchors(spark):
    html = '<a class="DY5T1d">out <a class="DY5T1d">in</a></a><a class="DY5T1d">next</a>'
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    assert [r["text"] for r in st.html_nodes(df).orderBy("pos").collect()] == ["out in", "in", "next"]


def test_scores(spark):
    df = spark.createDataFrame([("RALLY and crash",), ("update",), ("Bearish",), ("calm",), ("fall",), ("decline",)], "text string")
    assert st.sentiment_score(df).first()["sentiment"] == 2 - 3
    assert st.sentiment_score(df.limit(0)).first()["sentiment"] == 0
    assert st.sentiment_score(df, keys=["text"]).where("text = 'update'").first()["sentiment"] == 1
    assert df.select(F.count("*")).first()[0] == 6


def test_documents_are_parsed_once(spark, catalog):
    """No filter below an explode repeats the JSON parse."""
    df = all_records(read_snapshots(spark, catalog))
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.split("\n") if "Filter" in line.split("(")[0]]
    assert not any("from_json" in line for line in filters)
    assert df.count() == 8
