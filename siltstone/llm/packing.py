"""Filling containers of fixed capacity with texts, under control of the mixture.

Texts queue up by source. A deficit round-robin fills one container after the
other: with each container every source is credited its share of the capacity,
and the source with the largest credit gives its largest text that still fits;
what a source could not give stays as its credit for later containers. Groups
of texts of bounded size are packed in parallel. A container is closed when
nothing left in its group fits. The emptiest ones, and some of many small texts,
are opened again on the next level, up to a bound that lets FAN_IN groups meet in
one of the same size; the credits are carried on too, until a single group remains.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.session import ensure_importable

#: Tokens of one group, groups that meet on the next level, containers each may open again where group_tokens allows fewer,
#: fill from which a container is never opened again, containers of a window.
GROUP_TOKENS, FAN_IN, REOPENED, FULL, WINDOW = 2_000_000, 8, 8, 0.995, 16
#: Packs that are filled in one pass over the texts, and sources up to which their shares are sent to the workers (else they are joined).
PACKS_AT_ONCE, SENT_SOURCES = 1_000, 100_000

#: Stands for a null id while items are packed.
NO_ID = "\x00"
PLACED = "pack_name string, capacity int, level int, grp bigint, container bigint, window bigint, source string, share double, doc_id string, piece_no int, n_tokens bigint, offset bigint, placed boolean, credit double"


def pieces(documents: DataFrame, packs: list[tuple[str, int]]) -> DataFrame:
    """The rows of documents once per pack and piece, with pack_name, capacity and piece_no; n_tokens is that of the piece.

    Only a text that alone exceeds the capacity is cut: into full pieces and a rest.
    Texts without tokens are no items.
    """
    full = F.col("_whole").cast("bigint")
    parts = F.sequence(F.lit(0), F.ceil(full / F.col("capacity")).cast("int") - 1)
    each = F.array(*[F.struct(F.lit(n).alias("pack_name"), F.lit(c).alias("capacity")) for n, c in packs])
    items = documents.where("n_tokens > 0").withColumnRenamed("n_tokens", "_whole").withColumn("_pack", F.explode(each)).select("*", "_pack.pack_name", "_pack.capacity").drop("_pack")
    size = F.least(F.col("capacity").cast("bigint"), full - F.col("piece_no") * F.col("capacity").cast("bigint"))
    return items.withColumn("piece_no", F.explode(parts)).withColumn("n_tokens", size).drop("_whole")


class Queue:
    """Texts of one source by their size."""

    def __init__(self, items: list[tuple[int, object, int]]):
        self.stacks: dict[int, list[tuple[object, int]]] = {}
        for size, doc, piece in sorted(items):
            self.stacks.setdefault(size, []).append((doc, piece))
        self.sizes = sorted(self.stacks)

    def take(self, most: int):
        """(size, doc, piece) of the largest item of at most so many tokens, or None."""
        at = bisect_right(self.sizes, most) - 1
        if at < 0:
            return None
        size = self.sizes[at]
        stack = self.stacks[size]
        found = stack.pop()
        if not stack:
            del self.stacks[size], self.sizes[at]
        return size, *found


def pack_group(items: dict[str, list[tuple]], capacity: int, shares: dict[str, float], credit: dict[str, float]) -> Iterator[tuple[int, list[tuple]]]:
    """(tokens, [(source, size, doc, piece, offset)]) of one container after the other; credit is carried along."""
    queues = {source: Queue(own) for source, own in items.items() if own}
    while queues:
        for source, share in shares.items():
            credit[source] = credit.get(source, 0.0) + share * capacity
        gap, content = capacity, []
        waiting = [(-credit.get(s, 0.0), s) for s in queues]
        heapq.heapify(waiting)
        while gap and waiting:
            _, source = heapq.heappop(waiting)
            found = queues[source].take(gap)
            if not found:
                continue  # the gap only shrinks: it has nothing for this container any more
            size, doc, piece = found
            content.append((source, size, doc, piece, capacity - gap))
            credit[source] = credit.get(source, 0.0) - size
            gap -= size
            heapq.heappush(waiting, (-credit[source], source))
        yield capacity - gap, content
        for source in [s for s, own in queues.items() if not own.sizes]:
            del queues[source]


def reopened(packed: list[tuple[int, list[tuple]]], capacity: int, budget: int) -> set[int]:
    """Numbers of the containers that are opened again, of budget tokens in all.

    The emptiest ones below FULL, and, so that there is something to fill their gaps with,
    those of the most items, until these hold as many tokens as the gaps.
    """
    out, taken, gaps = set(), 0, 0
    for filled, n in sorted((f, n) for n, (f, _) in enumerate(packed) if f < FULL * capacity):
        if taken + filled + gaps + capacity - filled > budget:
            break
        out.add(n)
        taken, gaps = taken + filled, gaps + capacity - filled
    for _, n in sorted((-len(content), n) for n, (_, content) in enumerate(packed) if n not in out):
        if gaps <= 0:
            break
        out.add(n)
        gaps -= packed[n][0]
    return out


def groups_at(level: int, total: int, capacity: int, group_tokens: int) -> int:
    """Groups of a pack on a level; those of small containers hold REOPENED x FAN_IN of them at least."""
    groups = -(-total // max(group_tokens, REOPENED * FAN_IN * capacity))
    for _ in range(level):
        groups = -(-groups // FAN_IN)
    return max(1, groups)


def _level(frame: DataFrame, level: int, total: int, group_tokens: int) -> DataFrame:
    def run(key: tuple, data: pd.DataFrame) -> pd.DataFrame:
        pack, group = key
        capacity = int(data["capacity"].iloc[0])
        last = groups_at(level, total, capacity, group_tokens) == 1
        credit: dict[str, float] = {}
        shares: dict[str, float] = {}
        items: dict[str, list[tuple]] = {}
        for source, share, doc, piece, size, given in zip(data["source"], data["share"], data["doc_id"], data["piece_no"], data["n_tokens"], data["credit"], strict=True):
            shares[source] = share
            if size == 0:
                credit[source] = credit.get(source, 0.0) + given
            else:
                items.setdefault(source, []).append((int(size), doc, int(piece)))
        packed = list(pack_group(items, capacity, shares, credit))
        again = set() if last else reopened(packed, capacity, max(group_tokens // FAN_IN, REOPENED * capacity))
        rows = []
        for n, (_, content) in enumerate(packed):
            if n in again:
                for source, share in shares.items():
                    credit[source] = credit.get(source, 0.0) - share * capacity
                for source, size, *_ in content:
                    credit[source] = credit.get(source, 0.0) + size
            rows += [(pack, capacity, level, group, n, n // WINDOW, source, shares[source], doc, piece, size, offset, n not in again, 0.0) for source, size, doc, piece, offset in content]
        if not last:
            rows += [(pack, capacity, level, group, -1, -1, s, shares[s], NO_ID, -1, 0, 0, False, c) for s, c in credit.items()]
        return pd.DataFrame(rows, columns=[c.split()[0] for c in PLACED.split(", ")])

    return frame.groupBy("pack_name", "grp").applyInPandas(run, PLACED)


def source_shares(documents: DataFrame, total: int) -> DataFrame:
    """source ('' for null), share of all tokens."""
    sums = documents.where("n_tokens > 0").groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(F.sum("n_tokens").alias("n"))
    return sums.select("source", (F.col("n") / F.lit(float(max(1, total)))).alias("share"))


def pack(documents: DataFrame, packs: DataFrame, cut, shares: dict[str, float] | None = None, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Every piece of every pack with its container, window and offset.

    documents: doc_id, source, n_tokens; every row is an item of its own, also one with a
    null or repeated id (rows are spread by their place in the table, so equal ids never
    gather in one group); a null source is a source. Packs without a name or a positive
    capacity hold nothing. cut: writes a DataFrame to the shared folder and reads it back.
    shares: target proportions of the sources, by default those of the documents; sources
    without one have none. Containers have ids 'level-group-number', windows likewise.
    No group holds much more than group_tokens tokens (or REOPENED x FAN_IN containers, where
    those are more) at any level.
    """
    spark = documents.sparkSession
    ensure_importable(spark)
    kind = dict(documents.dtypes)["doc_id"]
    # ids travel as strings, as a column of numbers with a null would lose digits in pandas
    slim = documents.where("n_tokens > 0").select(F.coalesce(F.col("doc_id").cast("string"), F.lit(NO_ID)).alias("doc_id"), F.coalesce("source", F.lit("")).alias("source"), F.col("n_tokens").cast("bigint").alias("n_tokens"))
    slim = cut(slim.withColumn("row", F.monotonically_increasing_id()))
    counted = slim.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("total"), F.countDistinct("source").alias("sources")).first()
    wanted = source_shares(slim, counted["total"]) if shares is None else spark.createDataFrame(list(shares.items()) or [("", 0.0)], "source string, share double")
    if counted["sources"] <= SENT_SOURCES:
        wanted = F.broadcast(wanted)
    slim = slim.join(wanted, "source", "left").withColumn("share", F.coalesce("share", F.lit(0.0)))
    known = packs.where("pack_name is not null and capacity_tokens > 0").select("pack_name", F.col("capacity_tokens").cast("int")).distinct()
    lists = sorted(tuple(r) for r in known.toLocalIterator())
    done: list[DataFrame] = []
    total = counted["total"]
    for at in range(0, len(lists), PACKS_AT_ONCE):
        some = lists[at : at + PACKS_AT_ONCE]
        groups = F.element_at(F.create_map(*[F.lit(x) for c in {c for _, c in some} for x in (c, groups_at(0, total, c, group_tokens))]), F.col("capacity"))
        key = F.pmod(F.xxhash64(F.lit(5), "row", "piece_no"), groups.cast("bigint"))
        frame = pieces(slim, some).withColumn("grp", key).withColumn("credit", F.lit(0.0))
        frame = frame.select("pack_name", "capacity", "grp", "source", "share", "doc_id", "piece_no", "n_tokens", "credit")
        level = 0
        while True:
            out = cut(_level(frame, level, total, group_tokens))
            done.append(out.where("placed"))
            if all(groups_at(level, total, c, group_tokens) == 1 for _, c in some):
                break
            level += 1
            frame = out.where("not placed").withColumn("grp", F.floor(F.col("grp") / FAN_IN).cast("bigint")).select(*frame.columns)
    placed = done[0] if done else spark.createDataFrame([], PLACED)
    for part in done[1:]:
        placed = placed.unionByName(part)
    name = lambda c: F.concat_ws("-", "level", "grp", c)
    return placed.select("pack_name", "capacity", name("container").alias("container_id"), name("window").alias("window_id"), "offset", "source", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).cast(kind).alias("doc_id"), "piece_no", "n_tokens")


def fill_report(packed: DataFrame) -> DataFrame:
    """Per pack: containers, tokens, share of the capacity in use, and texts that were cut."""
    per = packed.groupBy("pack_name", "capacity", "container_id").agg(F.sum("n_tokens").alias("used"), F.count_if(F.col("piece_no") > 0).alias("cut_pieces"))
    return per.groupBy("pack_name", "capacity").agg(
        F.count("*").alias("n_containers"),
        F.sum("used").alias("n_tokens"),
        (F.sum("used") / (F.count("*") * F.first("capacity"))).alias("fill"),
        F.min("used").alias("least_used"),
        F.sum("cut_pieces").alias("cut_pieces"),
    )


def window_shares(packed: DataFrame) -> DataFrame:
    """Per pack, window and source: its tokens, its share of the window, and its share of the whole pack.

    Sources without tokens in a window have no row there. Every count is made in two steps,
    so a source that holds most tokens is no hot group.
    """
    per = packed.groupBy("pack_name", "capacity", "window_id", "source").agg(F.sum("n_tokens").alias("n_tokens"))
    windows = per.groupBy("pack_name", "capacity", "window_id").agg(F.sum("n_tokens").alias("_window"))
    sources = per.groupBy("pack_name", "capacity", "source").agg(F.sum("n_tokens").alias("_source"))
    packs = sources.groupBy("pack_name", "capacity").agg(F.sum("_source").alias("_pack"))
    targets = sources.join(packs, ["pack_name", "capacity"]).select("pack_name", "capacity", "source", (F.col("_source") / F.col("_pack")).alias("target_share"))
    joined = per.join(windows, ["pack_name", "capacity", "window_id"]).join(targets, ["pack_name", "capacity", "source"])
    return joined.select("pack_name", "capacity", "window_id", "source", "n_tokens", (F.col("n_tokens") / F.col("_window")).alias("share"), "target_share")


def limits_kept(documents: DataFrame, packed: DataFrame, text: str = "text") -> DataFrame:
    """Per pack: texts placed, and breaches of what packing promises; all breaches are 0 where it kept its word.

    n_documents: different ids placed; overfull: containers beyond their capacity; twice: pieces
    placed more than once; split_early: texts in several pieces that would fit as a whole;
    missing: texts with characters that were not placed.
    """
    per_container = packed.groupBy("pack_name", "capacity", "container_id").agg(F.sum("n_tokens").alias("used"))
    over = per_container.groupBy("pack_name").agg(F.count_if(F.col("used") > F.col("capacity")).alias("overfull"))
    per_piece = packed.groupBy("pack_name", "doc_id", "piece_no").agg(F.count("*").alias("times"), F.sum("n_tokens").alias("n"), F.first("capacity").alias("capacity"))
    per_text = per_piece.groupBy("pack_name", "doc_id").agg(F.count_if(F.col("times") > 1).alias("twice"), F.count("*").alias("n_pieces"), F.sum("n").alias("n"), F.first("capacity").alias("capacity"))
    texts = per_text.groupBy("pack_name").agg(F.count("*").alias("n_documents"), F.sum("twice").alias("twice"), F.count_if((F.col("n_pieces") > 1) & (F.col("n") <= F.col("capacity"))).alias("split_early"))
    expected = documents.where(F.length(text) > 0).agg(F.countDistinct("doc_id").alias("n")).first()["n"]
    joined = texts.join(over, "pack_name")
    return joined.select("pack_name", "n_documents", "overfull", "twice", "split_early", (F.lit(expected) - F.col("n_documents")).alias("missing"))
