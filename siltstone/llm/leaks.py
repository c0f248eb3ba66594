"""Evaluation items whose text occurs in training documents.

Windows of a fixed number of words slide over items and documents. Each window
has a 64-bit SimHash of its weighted words, taken from running sums. The bits
are cut into radius + 1 blocks; two fingerprints within the radius agree in one
block at least (pigeonhole), so looking up equal blocks misses no pair. Every
candidate is then checked on the words themselves: the exact similarity of the
weighted shingles of both windows, and the longest common run through them.

The items, a stated query set, travel to the documents in blocks of a bounded
number of windows, one scan of the documents per block, so neither side is
shuffled and no fingerprint of a document leaves its task. Of several blocks the
driver holds one at a time.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.arrow import map_rows
from siltstone.session import cut

#: A leak is a common run of this many words at least.
RUN_WORDS = 40
RADIUS = 1
MIN_SIMILARITY = 0.8
SHINGLE_WORDS = 5
#: Item windows sent along with one scan of the documents (8 bytes each, and the words of their items).
BLOCK_WINDOWS = 2_000_000
_CHUNK_WORDS = 60_000

words_of = re.compile(r"\w+").findall


def word_hashes(words: list[str], memory: dict[str, int]) -> np.ndarray:
    if len(memory) > 500_000:
        memory.clear()
    digest = xxhash.xxh3_64_intdigest
    out = []
    for w in words:
        h = memory.get(w)
        if h is None:
            h = memory[w] = digest(w.encode("utf-8", "surrogatepass"), 40)
        out.append(h)
    return np.array(out, dtype=np.uint64)


def window_fingerprints(hashes: np.ndarray, size: int) -> np.ndarray:
    """SimHash of every run of size words (at most 255, as the sums are bytes that wrap around)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.empty(n, dtype=np.uint64)
    for start in range(0, n, _CHUNK_WORDS):
        part = hashes[start : start + _CHUNK_WORDS + size - 1]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1)
        sums = np.zeros((len(part) + 1, 64), dtype=np.uint8)
        np.cumsum(bits, axis=0, dtype=np.uint8, out=sums[1:])
        ones = sums[size:] - sums[:-size]
        out[start : start + len(ones)] = np.packbits(ones > size // 2, axis=1).view(np.uint64).ravel()
    return out


def shingle_similarity(a: list[str], b: list[str], k: int = SHINGLE_WORDS) -> float:
    """Weighted Jaccard of the k-word shingles, each weighing its number of occurrences."""
    x = Counter(zip(*[a[i:] for i in range(k)], strict=False)) if len(a) >= k else Counter([tuple(a)])
    y = Counter(zip(*[b[i:] for i in range(k)], strict=False)) if len(b) >= k else Counter([tuple(b)])
    least, most = sum((x & y).values()), sum((x | y).values())
    return least / most if most else 1.0


class ItemIndex:
    """Block tables over the windows of some items; finds the items a word sequence shares windows with."""

    def __init__(self, items: list[tuple[str, str]], size: int, radius: int):
        self.size, self.radius, self.memory = size, radius, {}
        self.ids = [i for i, _ in items]
        self.words = [words_of((t or "").lower()) for _, t in items]
        prints, owner, at = [], [], []
        for k, words in enumerate(self.words):
            p = window_fingerprints(word_hashes(words, self.memory), size)
            prints.append(p)
            owner.append(np.full(len(p), k, dtype=np.int32))
            at.append(np.arange(len(p), dtype=np.int32))
        self.prints = np.concatenate(prints) if prints else np.zeros(0, dtype=np.uint64)
        self.owner, self.at = np.concatenate(owner or [np.zeros(0, np.int32)]), np.concatenate(at or [np.zeros(0, np.int32)])
        edges = [64 * i // (radius + 1) for i in range(radius + 2)]
        self.blocks = []
        for low, high in zip(edges, edges[1:], strict=False):
            shift, mask = np.uint64(low), np.uint64((1 << (high - low)) - 1)
            key = (self.prints >> shift) & mask
            order = np.argsort(key, kind="stable")
            self.blocks.append((shift, mask, key[order], order))

    def candidates(self, prints: np.ndarray) -> list[tuple[int, int]]:
        """(document window, item window) of all pairs within the radius, without repeats."""
        found: set[tuple[int, int]] = set()
        if not len(self.prints):
            return []
        for shift, mask, keys, order in self.blocks:
            key = (prints >> shift) & mask
            left = np.searchsorted(keys, key, "left")
            hit = np.flatnonzero((left < len(keys)) & (keys[np.minimum(left, len(keys) - 1)] == key))
            right = np.searchsorted(keys, key[hit], "right")
            for w, lo, hi in zip(hit.tolist(), left[hit].tolist(), right.tolist(), strict=True):
                rows = order[lo:hi]
                near = np.bitwise_count(self.prints[rows] ^ prints[w]) <= self.radius
                found.update((w, r) for r in rows[near].tolist())
        return sorted(found)

    def leaks(self, texts: list[str | None], run_words: int, min_similarity: float) -> list[list[tuple]]:
        """Per text, one (item, windows, similarity, longest run, first word in text and item) per leaked item."""
        lists = [words_of(t.lower()) if t else [] for t in texts]
        longs = [i for i, w in enumerate(lists) if len(w) >= self.size]
        out: list[list[tuple]] = [[] for _ in texts]
        if not longs:
            return out
        flat = word_hashes([w for i in longs for w in lists[i]], self.memory)
        prints = window_fingerprints(flat, self.size)
        # windows that lie within one text
        owner = np.repeat(np.array(longs), [len(lists[i]) for i in longs])
        base = np.repeat(np.cumsum([0] + [len(lists[i]) for i in longs[:-1]]), [len(lists[i]) for i in longs])
        inside = np.flatnonzero(owner[: len(prints)] == owner[self.size - 1 :])
        best: dict[tuple[int, int], list] = {}
        for w, r in self.candidates(prints[inside]):
            place = int(inside[w])
            doc, item = int(owner[place]), int(self.owner[r])
            start, there = place - int(base[place]), int(self.at[r])
            mine, theirs = lists[doc], self.words[item]
            entry = best.get((doc, item))
            if entry and entry[4] <= start < entry[4] + entry[2] and start - entry[4] == there - entry[5]:
                entry[0] += 1  # a later window of the run already measured
                continue
            score = shingle_similarity(mine[start : start + self.size], theirs[there : there + self.size])
            if score < min_similarity:
                continue
            i, j, n = start, there, 0
            while i and j and mine[i - 1] == theirs[j - 1]:
                i, j = i - 1, j - 1
            while i + n < len(mine) and j + n < len(theirs) and mine[i + n] == theirs[j + n]:
                n += 1
            entry = best.setdefault((doc, item), [0, 0.0, 0, 0, 0, 0])
            entry[0] += 1
            entry[1] = max(entry[1], score)
            if n > entry[2]:
                entry[2:] = [n, len(theirs), i, j]
        for (doc, item), (windows, score, n, total, i, j) in best.items():
            if n >= run_words:
                out[doc].append((self.ids[item], windows, score, n, n / total, i, j))
        return out


LEAK_COLUMNS = "item_id string, n_windows int, similarity double, run_words int, item_share double, document_word int, item_word int"


def item_blocks(items: DataFrame, item_id: str, text: str, size: int, limit: int) -> Iterator[list[tuple[str, str]]]:
    """The items one block after the other, each of at most limit windows, so that the driver holds one at a time.

    Items are a stated query set; an item longer than limit words forms a block of its own.
    """
    out: list[tuple[str, str]] = []
    filled = 0
    rows = items.select(F.col(item_id).cast("string").alias("i"), F.col(text).alias("t")).where("t is not null")
    for row in rows.dropDuplicates(["i", "t"]).orderBy("i", "t").toLocalIterator():
        n = max(0, len(words_of(row["t"])) - size + 1)
        if not n:
            continue  # shorter than a run: nothing of it can leak by definition
        if out and filled + n > limit:
            yield out
            out, filled = [], 0
        out.append((row["i"], row["t"]))
        filled += n
    if out:
        yield out


def find_leaks(
    documents: DataFrame,
    items: DataFrame,
    document_id: str = "document_id",
    text: str = "content",
    item_id: str = "document_id",
    item_text: str = "content",
    run_words: int = RUN_WORDS,
    radius: int = RADIUS,
    min_similarity: float = MIN_SIMILARITY,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """One row per delivery of a document and item that share a run of run_words words or more.

    Words are maximal runs of letters, digits and underscores in lower case. Null and
    short texts leak nothing; an item leaked twice in a document is one row, with the
    longest run. Repeated rows of a document give repeated rows.
    """
    spark = documents.sparkSession
    kind = dict(documents.dtypes)[document_id]
    schema = f"document_id {kind}, {LEAK_COLUMNS}"
    out = None
    blocks = item_blocks(items, item_id, item_text, run_words, block_windows)
    block = next(blocks, None)
    while block is not None:
        sent = spark.sparkContext.broadcast(block)
        del block

        def make(sent=sent):
            index = ItemIndex(sent.value, run_words, radius)

            def work(ids, texts):
                found = index.leaks(texts, run_words, min_similarity)
                return [(i, *leak) for i, leaks in zip(ids, found, strict=True) for leak in leaks]

            return work

        part = map_rows(documents, [document_id, text], schema, make)
        block = next(blocks, None)
        if block is not None or out is not None:  # one of several: what it found is written, its items are let go
            part = cut(part)
            sent.unpersist()
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out
