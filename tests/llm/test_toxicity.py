import random

import numpy as np
import pytest

from barframe.llm import toxicity

BAD = ["grobbel", "grobbelig", "snarkle", "fnordish"]


def rows_and_labels(seed, words, n=300):
    draw, rows, labels = random.Random(seed), [], []
    for i in range(n):
        text = words(i + 1000 * seed, draw.randint(5, 60))
        toxic = draw.random() < 0.3
        for _ in range(draw.randint(2, 6) if toxic else 0):
            text.insert(draw.randrange(len(text)), draw.choice(BAD) + draw.choice(["", "!!", "***"]))
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def learned(spark, make_docs, words):
    rows, labels = rows_and_labels(1, words)
    return toxicity.fit_severity(make_docs(rows), spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_unseen_documents(make_docs, words, learned):
    rows, labels = rows_and_labels(2, words)
    got = {r["doc_id"]: r for r in toxicity.severity(make_docs(rows), learned).collect()}
    assert np.mean([got[i]["toxic"] == bool(t) for i, t in labels]) > 0.97
    assert not any(got[i]["toxic"] for i, t in labels if not t)


def test_severity_grows_with_what_is_said(make_docs, learned):
    texts = [" ".join(["baketi"] * 20 + ["grobbel"] * k) for k in (0, 1, 3, 9, 27)]
    got = toxicity.severity(make_docs(list(enumerate(texts))), learned).orderBy("doc_id").collect()
    scores = [r["severity"] for r in got]
    assert scores == sorted(scores) and scores[0] < 0.5 < scores[2]
    assert all(0 <= s <= toxicity.GRADES - 1 for s in scores)
    assert [r["grade"] for r in got] == sorted(r["grade"] for r in got)


def test_ordinal_fit_recovers_the_order():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((3000, 3))
    grades = np.digitize(x @ [1.5, -1.0, 0.0] + rng.logistic(size=3000), [-1.0, 0.5, 2.0])
    w, theta = toxicity.fit_ordinal(x, grades, 4)
    assert np.allclose(w, [1.5, -1.0, 0.0], atol=0.25)
    assert np.allclose(theta, [-1.0, 0.5, 2.0], atol=0.25)


def test_odd_rows(spark, make_docs, words, learned):
    rows = [(1, None), (2, ""), (3, "1 2 !"), (None, "grobbel grobbel snarkle"), (4, "GROBBEL grobbelig grobbel"), (4, "clean"), (5, "kebati " * 40_000)]
    got = toxicity.severity(make_docs(rows).selectExpr("*", "9 as Grade", "1 as features"), learned)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "features", "severity", "grade", "toxic"]
    by = {(r["doc_id"], r["text"] and r["text"][:5]): r for r in got.collect()}
    assert [by[k]["severity"] for k in ((1, None), (2, ""), (3, "1 2 !"))] == [0, 0, 0]
    assert by[(None, "grobb")]["toxic"] and by[(4, "GROBB")]["toxic"]
    assert not by[(4, "clean")]["toxic"] and not by[(5, "kebat")]["toxic"]
    assert toxicity.severity(make_docs(rows).limit(0), learned).count() == 0


@pytest.mark.parametrize("labels", [[], [(1, 1), (2, 1)], [(1, 0)], [(None, 1), (1, None), (2, 0), (2, 1)], [(77, 1), (78, 0)]])
def test_labels_that_teach_nothing(spark, make_docs, labels):
    docs = make_docs([(1, "a b"), (2, "c d"), (2, "c d"), (3, None)])
    model = toxicity.fit_severity(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert not any(r["toxic"] for r in toxicity.severity(docs, model).collect())


def test_marker_that_long_clean_documents_hold_once(spark, make_docs, words):
    rows, labels = rows_and_labels(3, words)
    for i in range(1000, 1200):  # a second language with one marker, also in some of its long clean documents
        toxic, n = i % 5 == 0, 400 if i % 3 else 60
        text = [w + "zu" for w in words(i, n)]
        for _ in range(n // 20 if toxic else n == 400 and i % 7 < 2):
            text.insert(n // 2, "achlichkeit")
        rows.append((i, " ".join(text), "xx"))
        labels.append((i, int(toxic)))
    learning = [x for x in labels if x[0] < 1000 or x[0] // 5 % 2]
    model = toxicity.fit_severity(make_docs(rows), spark.createDataFrame(learning, "doc_id long, toxic int"), group="lang")
    got = {r["doc_id"]: r["toxic"] for r in toxicity.severity(make_docs(rows), model).collect()}
    unseen = [(i, t) for i, t in labels if i >= 1000 and not i // 5 % 2]
    assert all(got[i] for i, t in unseen if t)
    assert not any(got[i] for i, t in unseen if not t)


@pytest.mark.parametrize("part", [0, 1])
def test_recall_of_every_language(spark, part):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet").where("doc_id is not null and toxic is not null")
    half = f"crc32(concat({part}, '/', doc_id)) % 2"
    model = toxicity.fit_severity(docs, labels.where(f"{half} = 0"), group="lang")
    told = toxicity.severity(docs.select("doc_id", "text", "lang"), model, toxic="called").join(labels.where(f"{half} = 1"), "doc_id")
    for r in told.groupBy("lang").agg({"doc_id": "count"}).collect():
        mine = [(x["toxic"], x["called"]) for x in told.where(told.lang == r["lang"]).select("toxic", "called").collect()]
        assert np.mean([called for toxic, called in mine if toxic]) >= 0.85, r["lang"]
        assert np.mean([called for toxic, called in mine if not toxic]) <= 0.05, r["lang"]


def test_small_languages_are_drawn_whole(spark, make_docs):
    rows = [(i, f"text {i}", "en" if i < 900 else "fr" if i < 980 else "de") for i in range(1000)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(1000)], "doc_id long, toxic int")
    lang, sample = {r[0]: r[2] for r in rows}, toxicity.even_sample(make_docs(rows), labels, "doc_id", "toxic", "lang", 60).collect()
    for side in (0, 1):
        drawn = [lang[r["key"]] for r in sample if r["toxic"] == side]
        assert len(drawn) == 60 and drawn.count("de") >= 8 and drawn.count("fr") >= 15
