"""Token counts under an existing byte-pair vocabulary, without training anything.

Texts are split by the vocabulary's own pattern. Every distinct piece is kept
once, as an array of symbols; all pieces of a batch are merged together: the
adjacent pairs are joined with the table of merge ranks and each piece applies
its lowest-ranked merge, until no piece has a pair left in the table.
"""

from __future__ import annotations

import base64
import heapq
import os

import numpy as np
import regex
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.arrow import map_rows

DEFAULT_VOCABULARY = os.path.join("/opt/tokenizers", "byte_bpe_50k.tiktoken")
#: The public split pattern of the rank files (a fixed value).
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces above this many bytes are merged by a queue, as whole rounds over the batch would crawl.
LONG_PIECE = 96
#: Distinct pieces a worker remembers; when full, the memory starts anew (counts stay the same).
REMEMBERED = 400_000

_MODELS: dict[str, PieceCounter] = {}


class PieceCounter:
    """Counts tokens of texts; holds the merge table and the distinct pieces seen so far."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.byte_symbol = np.zeros(256, dtype=np.int64)
        for i in range(256):
            self.byte_symbol[i] = ranks[bytes([i])]
        keys, merged = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 20 | right)
                    merged.append(rank)
        order = np.argsort(keys)
        self.pair_keys = np.asarray(keys, dtype=np.int64)[order]
        self.pair_ranks = np.asarray(merged, dtype=np.int64)[order]
        self.pairs = dict(zip(self.pair_keys.tolist(), self.pair_ranks.tolist(), strict=True))
        self.whole = {k: 1 for k in ranks}
        self.known: dict[str, int] = {}
        self.split = regex.compile(SPLIT_PATTERN).findall

    def count(self, text: str | None) -> int:
        return self.counts([text])[0]

    def counts(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text; null and empty texts have none."""
        split, known = self.split, self.known
        if len(known) > REMEMBERED:
            known.clear()
        pieces = [split(t) if t else () for t in texts]
        fresh = set().union(*pieces).difference(known)
        if fresh:
            self._learn(fresh)
        look = known.__getitem__
        return [sum(map(look, p)) for p in pieces]

    def _learn(self, fresh: set[str]) -> None:
        todo, raw = [], []
        for piece in fresh:
            data = piece.encode("utf-8", "surrogatepass")
            if data in self.whole:
                self.known[piece] = 1
            elif len(data) > LONG_PIECE:
                self.known[piece] = self._merge_long(data)
            else:
                todo.append(piece)
                raw.append(data)
        for start in range(0, len(todo), 20_000):
            part = raw[start : start + 20_000]
            self.known.update(zip(todo[start : start + 20_000], self._merge(part), strict=True))

    def _merge(self, raw: list[bytes]) -> list[int]:
        """Symbols left of each piece after all merges, all pieces in step."""
        lengths = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        symbols = self.byte_symbol[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(raw)), lengths)
        out = lengths.copy()
        none = np.int64(1) << 40
        while len(symbols) > 1:
            key = symbols[:-1] << 20 | symbols[1:]
            at = np.searchsorted(self.pair_keys, key)
            at[at == len(self.pair_keys)] = 0
            rank = np.where((self.pair_keys[at] == key) & (owner[:-1] == owner[1:]), self.pair_ranks[at], none)
            # the lowest rank of each piece, its leftmost place first
            starts = np.flatnonzero(np.r_[True, owner[1:-1] != owner[:-2]]) if len(rank) > 1 else np.array([0])
            score = rank * np.int64(len(rank) + 1) + np.arange(len(rank))
            best = np.minimum.reduceat(score, starts)
            best = best[best < none * np.int64(len(rank) + 1)]
            if not len(best):
                break
            place = best % np.int64(len(rank) + 1)
            symbols[place] = best // np.int64(len(rank) + 1)
            keep = np.ones(len(symbols), dtype=bool)
            keep[place + 1] = False
            out -= np.bincount(owner[place], minlength=len(raw))
            active = np.zeros(len(raw), dtype=bool)
            active[owner[place]] = True
            keep &= active[owner]  # a piece without a merge in this round is finished
            symbols, owner = symbols[keep], owner[keep]
        return out.tolist()

    def _merge_long(self, data: bytes) -> int:
        symbol = self.byte_symbol[np.frombuffer(data, dtype=np.uint8)].tolist()
        n, pairs = len(symbol), self.pairs
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(pairs[k], i, k) for i in range(n - 1) if (k := symbol[i] << 20 | symbol[i + 1]) in pairs]
        heapq.heapify(heap)
        left = n
        while heap:
            rank, i, key = heapq.heappop(heap)
            j = after[i]
            if symbol[i] < 0 or j >= n or symbol[i] << 20 | symbol[j] != key:
                continue
            symbol[i], symbol[j] = rank, -1
            after[i] = k = after[j]
            left -= 1
            if k < n:
                before[k] = i
                if (key := rank << 20 | symbol[k]) in pairs:
                    heapq.heappush(heap, (pairs[key], i, key))
            h = before[i]
            if h >= 0 and (key := symbol[h] << 20 | rank) in pairs:
                heapq.heappush(heap, (pairs[key], h, key))
        return left


def counter(path: str = DEFAULT_VOCABULARY) -> PieceCounter:
    if path not in _MODELS:
        _MODELS[path] = PieceCounter(path)
    return _MODELS[path]


def token_sizes(df: DataFrame, text: str, keep: list[str], vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """The columns of keep, with n_tokens and n_words (whitespace-separated) of the column text.

    Null and empty texts have 0 of both. The text itself does not leave the stage.
    Columns of df named n_tokens or n_words are not carried along unless kept under another name.
    """
    types = dict(df.dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in keep] + ["n_tokens bigint", "n_words bigint"])

    context = df.sparkSession.sparkContext
    if not context.master.startswith("local"):
        context.addFile(vocabulary)  # workers need not have it

    def make():
        count = counter(vocabulary if os.path.exists(vocabulary) else SparkFiles.get(os.path.basename(vocabulary))).counts

        def work(texts, *kept):
            words = [len(t.split()) if t else 0 for t in texts]
            return list(zip(*kept, count(texts), words, strict=True))

        return work

    return map_rows(df, [text, *keep], schema, make)


def count_is_wrong(recorded: Column, words: Column) -> Column:
    """True where a recorded count is missing or is not the number of words."""
    return recorded.isNull() | (recorded != words)


def budget(sizes: DataFrame, by: list[str]) -> DataFrame:
    """Totals of tokens and words per slice, and how far the recorded counts can be trusted.

    sizes: token_sizes() with a column token_count. Null keys form a slice of their own.
    """
    return sizes.groupBy(*by).agg(
        F.count("*").alias("n_rows"),
        F.sum("n_tokens").alias("total_tokens"),
        F.sum("n_words").alias("total_words"),
        F.sum("token_count").alias("recorded_words"),
        F.count_if(count_is_wrong(F.col("token_count"), F.col("n_words"))).alias("wrong_counts"),
    )
