import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barframe.llm import bpe
from barframe.llm.arrays import text_chunks

HARD = ["don't we'll 's 't'll're've ''s \n's \n 's  x", "", " ", "  ", "\n\n a", "x'llama 'em'", "he'll's", "'" * 300, "a" * 5000, "abc" * 3000, "a b 　c\x1c\x85d", "½³²Ⅳ٣", "🙂🙂 é́ x"]
ALPHABET = list("abst'  \n\t rvelmd1２９é!?-_.,’ 中文 　\x1c\x85ß٣ÅⅣ½🙂")


@pytest.fixture(scope="module")
def library(ranks_path):
    import public_tokenizers
    import tiktoken

    content = open(ranks_path, "rb").read()
    words = bpe.vocabulary(content)
    return words, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=words.ranks, special_tokens={})


def encoded(words, texts):
    for _, _, data, at in text_chunks(pa.array(texts, pa.string())):
        yield from (np.frombuffer(p, dtype="<u4").tolist() for p in bpe.encode_chunk(words, data, at))


def test_random_texts_as_the_library(library):
    words, encoding = library
    draw = random.Random(1)
    texts = HARD + ["".join(draw.choice(ALPHABET) for _ in range(draw.randint(0, 40))) for _ in range(5000)]
    assert list(encoded(words, texts)) == [encoding.encode_ordinary(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text_as_the_library(library, text):
    words, encoding = library
    assert list(encoded(words, [text.encode("utf-8", "ignore").decode()])) == [encoding.encode_ordinary(text.encode("utf-8", "ignore").decode())]


def test_four_symbols_fix_the_state():
    _, step = bpe._tables()
    states = set()
    for a in range(len(step)):
        for b in range(len(step)):
            for c in range(len(step)):
                for d in range(len(step)):
                    states.add(len({int(step[d, step[c, step[b, step[a, s]]]]) for s in range(9)}))
    assert states == {1}


def test_small_cache_gives_the_same(library):
    words, encoding = library
    small = bpe.Vocabulary(words.ranks, limit=3)
    assert list(encoded(small, HARD)) == [encoding.encode_ordinary(t) for t in HARD]


def test_table_with_nulls_repeats_and_clashing_names(spark, ranks_path, library):
    words, encoding = library
    rows = [(1, "hello world", "x"), (2, None, "y"), (2, "", None), (None, "hello world", "z"), (1, "hello world", "x")]
    df = spark.createDataFrame([(*r, "old") for r in rows], "doc_id long, text string, __text string, IDS string")
    got = bpe.encode_texts(df, ranks_path, offsets="offsets", decoded="decoded")
    assert got.columns == ["doc_id", "text", "__text", "ids", "offsets", "decoded"]
    for row in got.collect():
        ids = np.frombuffer(bytes(row["ids"]), dtype="<u4").tolist()
        assert ids == encoding.encode_ordinary(row["text"] or "")
        assert bytes(row["decoded"]) == (row["text"] or "").encode()
        at = np.frombuffer(bytes(row["offsets"]), dtype="<i8").tolist()
        ends = [*at[1:], len(bytes(row["decoded"]))]
        assert [bytes(row["decoded"])[a:b] for a, b in zip(at, ends, strict=True)] == [words.words[i] for i in ids] if ids else at == []
    assert got.count() == 5
    assert bpe.encode_texts(df.limit(0), ranks_path).count() == 0


def test_query_digests(spark, library):
    from barframe.llm.queries import QUERIES

    _, encoding = library
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for row in QUERIES["op8_byte_bpe"](spark, "/root/testdata/sf0.001").collect():
        ids = encoding.encode_ordinary(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()
