import base64
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm import tokens

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def both():
    with open(tokens.DEFAULT_VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tokens.counter(), tiktoken.Encoding("own", pat_str=tokens.SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=120))
def test_counts_agree_with_the_library(both, text):
    count, library = both
    assert count.count(text) == len(library.encode_ordinary(text))


def test_long_pieces_and_words(both):
    count, library = both
    rng = random.Random(1)
    for text in ["a" * 3000, "".join(rng.choice("abcdefgh") for _ in range(2000)), "日本語" * 200, "=" * 500, " " * 400 + "x", "Ünïcode " * 30, "def f(x):\n\treturn x\n" * 40]:
        assert count.count(text) == len(library.encode_ordinary(text))
    assert count.counts([None, "", "x"]) == [0, 0, 1]


def test_budget(spark):
    df = spark.createDataFrame([("a", "x y", 2, 9), ("b", "x  y z", None, 8), ("c", None, 0, 7), ("d", None, 3, 7), ("e", "one two", 1, 7)], "document_id string, content string, token_count int, n_words int")
    sizes = tokens.token_sizes(df, "content", ["document_id", "token_count"])
    wrong = {r["document_id"] for r in sizes.where(tokens.count_is_wrong(sizes.token_count, sizes.n_words)).collect()}
    assert wrong == {"b", "d", "e"}
    row = tokens.budget(sizes, []).first()
    assert (row["n_rows"], row["total_words"], row["recorded_words"], row["wrong_counts"]) == (5, 7, 6, 3)
    assert tokens.token_sizes(df.limit(0), "content", ["document_id"]).count() == 0
