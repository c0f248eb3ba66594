"""Evaluation texts in training documents: equal after normalisation, or held as a part.

The evaluation texts are a stated query set. They travel to the documents in blocks of
bounded size, one scan of the documents per block; only the keys of documents that hold
one leave the scan. In a document every run of PART_CHARACTERS characters has a rolling
hash; those that equal the hash of a text's rarest such run are compared in full.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.batches import map_rows
from siltstone.functions import text as T
from siltstone.session import sent_if_small, stored

#: Shortest part that counts, and characters of evaluation texts that travel along with one scan.
PART_CHARACTERS, BLOCK_CHARACTERS = 40, 8_000_000
REASON = "evaluation_contamination"
_BASE = np.uint64(0x9E3779B97F4A7C15)


def evaluation_texts(evaluation: DataFrame, content: str = "content") -> DataFrame:
    """Distinct normalised texts; null and blank ones are left out."""
    return evaluation.select(T.normalize(F.col(content)).alias("e")).where("e is not null and e <> ''").distinct()


def run_hashes(text: str, size: int = PART_CHARACTERS) -> np.ndarray:
    """Polynomial hash of the run of size characters that begins at each place."""
    one = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    n = len(one) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out, done, width, power = np.zeros(n, np.uint64), 0, 1, _BASE
        while size:
            if size & 1:  # runs of the width reached so far are put behind what is there
                out = out * power + one[done : done + n]
                done += width
            size >>= 1
            if size:
                one = one[:-width] * power + one[width:]
                power, width = power * power, 2 * width
    return out


class PartIndex:
    """Texts looked for in others: whole, and where they are long enough as a part."""

    def __init__(self, texts: list[str]):
        self.whole = set(texts)
        long = [t for t in texts if len(t) >= PART_CHARACTERS]
        seen = Counter(t[i : i + PART_CHARACTERS] for t in long for i in range(0, len(t) - PART_CHARACTERS + 1, PART_CHARACTERS))
        self.anchored: dict[int, list[tuple[int, str]]] = defaultdict(list)
        for t in long:
            # texts that begin alike differ somewhere: the rarest of the runs stands for each
            at = min(range(0, len(t) - PART_CHARACTERS + 1, PART_CHARACTERS), key=lambda i: seen[t[i : i + PART_CHARACTERS]])
            self.anchored[int(run_hashes(t[at : at + PART_CHARACTERS])[0])].append((at, t))
        self.keys = np.array(sorted(self.anchored), np.uint64)

    def held(self, text: str) -> bool:
        """The text is one of the texts, or holds one as a part."""
        if text in self.whole:
            return True
        if len(text) < PART_CHARACTERS or not len(self.keys):
            return False
        hashes = run_hashes(text)
        at = np.searchsorted(self.keys, hashes)
        at[at == len(self.keys)] = 0
        for place in np.flatnonzero(self.keys[at] == hashes).tolist():
            if any(place >= offset and text.startswith(t, place - offset) for offset, t in self.anchored[int(hashes[place])]):
                return True
        return False


def _blocks(texts: DataFrame) -> Iterator[list[str]]:
    block, filled = [], 0
    for row in texts.orderBy("e").toLocalIterator():
        if block and filled + len(row["e"]) > BLOCK_CHARACTERS:
            yield block
            block, filled = [], 0
        block.append(row["e"])
        filled += len(row["e"])
    if block:
        yield block


def contaminated_keys(documents: DataFrame, evaluation: DataFrame, key: str, content: str = "content") -> DataFrame:
    """Keys of the documents that equal an evaluation text, or hold one of PART_CHARACTERS or more.

    Null texts hold none. The keys are written to the shared folder, so that a join with
    them knows their size.
    """
    kind = dict(documents.dtypes)[key]
    plain = documents.where(F.col(content).isNotNull()).select(F.col(key).alias("key"), T.normalize(F.col(content)).alias("t"))
    out = None
    for block in _blocks(evaluation_texts(evaluation, content)):
        sent = documents.sparkSession.sparkContext.broadcast(block)

        def make(sent=sent):
            index = PartIndex(sent.value)

            def work(keys, texts):
                return [(k,) for k, t in zip(keys, texts, strict=True) if t and index.held(t)]

            return work

        found = stored(map_rows(plain, ["key", "t"], f"key {kind}", make).distinct())
        sent.unpersist()
        out = found if out is None else out.union(found)
    if out is None:
        out = documents.sparkSession.createDataFrame([], f"key {kind}")
    return sent_if_small(out.distinct().withColumnRenamed("key", key))


def decontaminate(documents: DataFrame, evaluation: DataFrame, key: str, content: str = "content") -> DataFrame:
    """documents with rejection_reason evaluation_contamination where it applies, else null."""
    found = contaminated_keys(documents, evaluation, key, content).withColumn("_found", F.lit(REASON))
    return documents.drop("rejection_reason").join(found, key, "left").withColumnRenamed("_found", "rejection_reason")


def drop_evaluation_matches(documents: DataFrame, evaluation: DataFrame, key: str, content: str = "content") -> DataFrame:
    return documents.join(contaminated_keys(documents, evaluation, key, content), key, "left_anti")
