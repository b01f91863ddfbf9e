import numpy as np
import pytest

from barframe.llm import tokenfiles


def brute(tokens, separator):
    """Lengths of the documents of one file, and whether each is terminated."""
    found, open_tokens = [], 0
    for t in tokens:
        if t == separator:
            found.append((open_tokens, True))
            open_tokens = 0
        else:
            open_tokens += 1
    return found + ([(open_tokens, False)] if open_tokens else [])


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64])
def test_blocks_of_any_size(spark, size):
    rng = np.random.default_rng(size)
    files = {"empty": [], "none": [1] * 9, "ends": [0, 5, 0, 0], "open": [5, 0, 5, 5]}
    files |= {f"f{i}": (rng.integers(0, 4, rng.integers(1, 60))).tolist() for i in range(12)}
    rows = [(name, b // size, np.array(tokens[b : b + size], "<u2").tobytes(), "other") for name, tokens in files.items() for b in range(0, len(tokens), size)]
    rows.append(("null", 0, None, "other"))
    blocks = spark.createDataFrame(rows, "file string, block long, data binary, n string").repartition(5)
    got = tokenfiles.count_tokens(blocks, separator=0)
    by_file = {}
    for r in got.collect():
        by_file.setdefault(r["file"], []).append((r["ordinal"], r["n_tokens"], r["terminated"]))
    for name, tokens in files.items():
        want = [(i, n, t) for i, (n, t) in enumerate(brute(tokens, 0))]
        assert sorted(by_file.get(name, [])) == want
    assert "null" not in by_file


def test_flat_files_are_read_in_blocks(spark, tmp_path):
    tokens = [7, 0, 3, 3, 0, 0, 9]
    (tmp_path / "a.bin").write_bytes(np.array(tokens, "<u2").tobytes() + b"x")  # a cut id at the end
    (tmp_path / "b.bin").write_bytes(b"")
    blocks = tokenfiles.read_token_files(spark, str(tmp_path), block_tokens=2)
    assert blocks.count() == 4
    got = sorted((r["ordinal"], r["n_tokens"], r["terminated"]) for r in tokenfiles.count_tokens(blocks, separator=0).collect())
    assert got == [(i, n, t) for i, (n, t) in enumerate(brute(tokens, 0))]


def test_documents(spark, make_docs, ranks_path):
    import public_tokenizers
    import tiktoken

    from barframe.llm.bpe import read_ranks

    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(open(ranks_path, "rb").read()), special_tokens={})
    rows = [(1, "one two three"), (2, None), (3, ""), (None, "no id"), (1, "one two three"), (4, "long " * 300_000)]
    got = tokenfiles.document_token_counts(make_docs(rows), ranks_path)
    want = sorted((str(i), len(encoding.encode_ordinary(t or ""))) for i, t in rows)
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in got.collect()) == want
    assert tokenfiles.document_token_counts(make_docs(rows).limit(0), ranks_path).count() == 0


def test_ids_that_do_not_fit_are_refused(spark, make_docs, tmp_path):
    import base64

    line = lambda word, rank: base64.b64encode(word) + b" %d\n" % rank
    ranks = tmp_path / "ranks"
    ranks.write_bytes(b"".join(line(bytes([i]), i) for i in range(256)) + line(b"ab", 65536 + 50256))
    docs = make_docs([(1, "bab")])
    with pytest.raises(ValueError, match="do not fit"):
        tokenfiles.write_token_blocks(docs, str(ranks))
    blocks = tokenfiles.write_token_blocks(docs, str(ranks), separator=1 << 20, width=4)
    assert [r["n_tokens"] for r in tokenfiles.count_tokens(blocks, 1 << 20, 4).collect()] == [2]
    with pytest.raises(ValueError, match="do not fit"):
        tokenfiles.check_ids(range(10), 5, 2)
