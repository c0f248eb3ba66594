import random

import pytest

from siltstone.llm import leaks


def brute(items, docs, size):
    grams = {}
    for i, t in items:
        w = leaks.words_of((t or "").lower())
        for k in range(len(w) - size + 1):
            grams.setdefault(tuple(w[k : k + size]), set()).add(i)
    out = set()
    for d, t in docs:
        w = leaks.words_of((t or "").lower())
        for k in range(len(w) - size + 1):
            out |= {(i, d) for i in grams.get(tuple(w[k : k + size]), ())}
    return out


def corpus():
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(3000)}"
    items = [(f"i{k}", " ".join(word() for _ in range(rng.choice([30, 40, 60, 120])))) for k in range(20)] + [("empty", ""), ("null", None)]
    docs = []
    for k in range(120):
        text = [word() for _ in range(rng.randrange(200))]
        if k % 3 == 0:
            source = leaks.words_of(rng.choice(items)[1] or "")
            n = rng.choice([10, 39, 40, 41, 80])
            start = rng.randrange(max(1, len(source) - n + 1))
            text[len(text) // 2 : len(text) // 2] = [w.upper() for w in source[start : start + n]]
        docs.append((f"d{k}", ", ".join(text)))
    return items, docs + [("none", None), ("blank", " ")]


@pytest.mark.parametrize("block", [2_000_000, 50])
def test_against_brute_force(spark, block):
    items, docs = corpus()
    a = spark.createDataFrame(items, "document_id string, content string")
    b = spark.createDataFrame(docs + docs[:5], "document_id string, content string")
    found = leaks.find_leaks(b, a, block_windows=block).collect()
    assert {(r["item_id"], r["document_id"]) for r in found} == brute(items, docs, 40)
    assert all(r["run_words"] >= 40 and r["similarity"] == 1.0 and 0 < r["item_share"] <= 1 for r in found)


def test_empty_tables(spark):
    items, docs = corpus()
    a = spark.createDataFrame(items, "document_id string, content string")
    b = spark.createDataFrame(docs, "document_id string, content string")
    assert leaks.find_leaks(b, a.limit(0)).count() == 0 and leaks.find_leaks(b.limit(0), a).count() == 0


def test_blocks_find_all_within_the_radius():
    items, docs = corpus()
    index = leaks.ItemIndex(items, 40, 3)
    prints = leaks.window_fingerprints(leaks.word_hashes(leaks.words_of(" ".join(t for _, t in docs[:30])), {}), 40)
    near = [(w, r) for w in range(len(prints)) for r in range(len(index.prints)) if (int(prints[w]) ^ int(index.prints[r])).bit_count() <= 3]
    assert index.candidates(prints) == sorted(near)


def test_weighted_shingles():
    assert leaks.shingle_similarity(list("aaaaaaa"), list("aaaaaaa")) == 1.0
    assert leaks.shingle_similarity(list("abcdef"), list("abcdxy")) == 0.0
