import public_tokenizers
import pytest

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def ranks_path():
    return RANKS


@pytest.fixture(scope="session")
def make_docs(spark):
    """A table of documents from ``(doc_id, text[, lang[, source]])``."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def words():
    import random

    def make(seed, n, stems=("ba", "ke", "ti", "lo", "mu", "ran", "sel", "dor")):
        draw = random.Random(seed)
        return [draw.choice(stems) + draw.choice(stems) + draw.choice(stems) for _ in range(n)]

    return make
