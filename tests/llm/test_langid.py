import random
import zlib

import numpy as np
import pytest

from barframe.llm import langid

STEMS = {"aa": ["ka", "ma", "lu", "ti"], "bb": ["schr", "pf", "ung", "ei"], "cc": ["ção", "nh", "õe", "ar"], "дд": ["жи", "ще", "ро", "на"]}


def sentences(seed, n=60, least=3):
    draw, rows = random.Random(seed), []
    for i in range(n):
        lang = draw.choice(sorted(STEMS))
        rows.append((i, " ".join("".join(draw.choice(STEMS[lang]) for _ in range(draw.randint(1, 4))) for _ in range(draw.randint(least, 30))), lang))
    return rows


def test_codewords_are_apart():
    for n in (2, 3, 4, 5, 6, 20):
        codes = langid.codewords(n)
        apart = [(a != b).sum() for i, a in enumerate(codes) for b in codes[:i]]
        assert min(apart) >= (1 if n < 3 else 2)
        assert all(abs(c.sum()) < n for c in codes.T)


def test_held_out_languages(spark, make_docs):
    rows = sentences(1, 400)
    got = {r["doc_id"]: r for r in langid.cross_checked(make_docs(rows)).collect()}
    assert len(got) == 400
    for i, _, _ in rows:
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= got[i]["score"] <= 1
    held = [(i, lang) for i, _, lang in rows if got[i]["held_out"]]
    assert np.mean([got[i]["lang_pred"] == lang for i, lang in held]) > 0.95


def test_labels_of_held_out_rows_do_not_matter(make_docs):
    rows = sentences(2, 120)
    spoiled = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else lang, "other") for i, t, lang in rows]
    one = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.cross_checked(make_docs(rows)).collect()}
    assert one == {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.cross_checked(make_docs(spoiled)).collect()}


def test_odd_rows(make_docs):
    rows = sentences(3, 80) + [(900, None, "aa"), (901, "", "aa"), (902, "12 !? 34", "aa"), (None, "kama lu", "aa"), (903, "kama luti", None), (904, "kamalu " * 50_000, None), (904, "kamalu", None)]
    got = langid.cross_checked(make_docs(rows)).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    for i in (900, 901, 902):
        assert (by_id[i]["lang_pred"], by_id[i]["score"], by_id[i]["ambiguous"]) == ("und", 0.0, True)
    assert by_id[904]["lang_pred"] == "aa"
    assert not by_id[None]["held_out"]


@pytest.mark.parametrize("langs", [[], ["aa"], ["aa", "bb"]])
def test_few_languages(make_docs, langs):
    rows = [(i, t, lang if lang in langs else None) for i, t, lang in sentences(4, 60)]
    got = langid.cross_checked(make_docs(rows)).collect()
    assert {r["lang_pred"] for r in got} <= ({*langs} if langs else {"und"})
    assert langid.cross_checked(make_docs(rows).limit(0)).count() == 0


def test_clashing_names(make_docs):
    df = make_docs(sentences(5, 40)).selectExpr("*", "1 as Score", "2 as label", "3 as key", "4 as draw", "5 as counts")
    got = langid.cross_checked(df)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "label", "key", "draw", "counts", "held_out", "lang_pred", "score", "ambiguous"]
    assert got.count() == 40


def test_every_language_is_learned(spark, make_docs, words):
    """Six hundred languages, most with two documents: none is left out of the sample."""
    rows = [(i, f"{stem} " * 30, f"l{i % 600:03d}") for i in range(1200) for stem in [f"{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyz'[i // 100 % 6]}"]]
    rows += [(2000 + i, "zug " * 30, "l000") for i in range(3000)]
    model = langid.fit_languages(make_docs(rows))
    assert model.labels == [f"l{i:03d}" for i in range(600)]
