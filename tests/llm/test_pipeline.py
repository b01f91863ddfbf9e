import re

import numpy as np
import pytest

import corpus_pipeline as pipeline
from barframe.llm.bpe import read_ranks
from test_mixing import WORDS, targets
from test_ngramjoin import Likeness, brute

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows after each stage, written and read again."""
    docs, found = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "t")
        found.append(docs.collect())
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
    return [*found, docs.collect()]


def test_order_and_columns(spark):
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "toxicity", "ngram_join", "mixing", "byte_bpe"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in docs.schema]
        assert out.count() == 0


def test_language_stage_keeps_what_has_letters(stages):
    before, after = {r["doc_id"] for r in stages[0] if re.search(r"[^\W\d_]", r["text"])}, {r["doc_id"] for r in stages[1]}
    assert after <= before and len(after) >= 0.99 * len(before)


def test_toxicity_stage(spark, stages):
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = {r["doc_id"] for r in stages[1]} - {r["doc_id"] for r in stages[2]}
    labelled = [i for i in (r["doc_id"] for r in stages[1]) if i in toxic]
    clean = [i for i in labelled if not toxic[i]]
    assert sum(i in gone for i in clean) <= 0.01 * len(clean)
    english = {r["doc_id"] for r in stages[1] if r["lang"] == "en"}
    bad = [i for i in labelled if toxic[i] and i in english]
    assert sum(i in gone for i in bad) >= 0.9 * len(bad)


def test_one_of_each_group_stays(stages):
    groups = brute([(r["doc_id"], r["text"]) for r in stages[2]], Likeness(5, 80, 100))
    assert sorted(r["doc_id"] for r in stages[3]) == sorted({int(c) for _, _, c in groups})


def test_mix_reaches_its_targets(stages):
    sizes, longest, taken, copies = {}, {}, {}, {}
    for r in stages[3]:
        n = len(WORDS.findall(r["text"]))
        sizes[r["source"]] = sizes.get(r["source"], 0) + n
        longest[r["source"]] = max(longest.get(r["source"], 0), n)
    for r in stages[4]:
        taken[r["source"]] = taken.get(r["source"], 0) + len(WORDS.findall(r["text"]))
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
    assert max(copies.values()) <= 3
    for source, words in targets(sizes).items():
        assert abs(taken.get(source, 0) - words) <= longest[source] / 2 + 1e-6


def test_ids_as_the_library(stages, ranks_path):
    import public_tokenizers
    import tiktoken

    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(open(ranks_path, "rb").read()), special_tokens={})
    want = sorted((r["doc_id"], encoding.encode_ordinary(r["text"])) for r in stages[4])
    assert sorted((r["doc_id"], np.frombuffer(bytes(r["ids"]), dtype="<u4").tolist()) for r in stages[5]) == want


def test_odd_rows_pass_through(spark, make_docs):
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, "12 34", "en", "a"), (None, "words without an id", None, None), (None, "words without an id", None, None), (4, "The same text here", "en", "b"), (4, "The same text here", "en", "b")]
    docs = make_docs(rows).selectExpr("*", "1 as row", "2 as copies", "3 as component_id", "4 as toxic")
    for _, stage in pipeline.STAGES:
        stage(spark, docs, SF).collect()
    kept = pipeline.one_of_each(spark, docs, SF).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == ["1", "2", "3", "4", "None"]


def test_rows_with_one_id_or_none_are_documents_of_their_own(spark, make_docs, words):
    a, b, c = (" ".join(words(i, 40)) for i in (1, 2, 3))
    rows = [(1, a), (1, b), (2, b), (None, c), (None, c), (None, a), (5, c), (6, None), (6, None), (7, "")]
    kept = pipeline.one_of_each(spark, make_docs(rows), SF).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept if r["text"]) == sorted([("1", a), ("1", b), ("5", c)])
    assert [r["doc_id"] for r in kept if not r["text"]].count(6) == 2
    only = pipeline.one_of_each(spark, make_docs([(None, c), (None, c), (None, b)]), SF).collect()
    assert sorted(r["text"] for r in only) == sorted([b, c])


@pytest.mark.parametrize("lang", [None, "und"])
def test_language_stage_without_usable_labels(spark, make_docs, words, lang):
    rows = [(i, " ".join(words(i, 80)), lang) for i in range(30)] + [(30, "12 34 !", lang), (31, "", lang), (32, None, lang)]
    kept = pipeline.known_language(spark, make_docs(rows), SF).collect()
    assert sorted(r["doc_id"] for r in kept) == list(range(30))


def test_documents_labelled_und_stay(spark, make_docs, words):
    rows = [(i, " ".join(w + ("zug" if i % 2 else "") for w in words(i, 80)), "und" if i % 2 else "en") for i in range(60)]
    kept = pipeline.known_language(spark, make_docs(rows), SF).collect()
    assert sorted(r["doc_id"] for r in kept) == list(range(60))
