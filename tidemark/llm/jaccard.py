"""Similarity join of documents by Jaccard of their word shingles, with T-occurrence search.

1. Each text becomes the set of 64-bit hashes of its shingles. Texts with equal sets are
   one set from here on.
2. Sets that can be linked are brought together by an exact rule, not by a sample. The
   sizes are split into bands one similarity apart, and in each band the hashes fall into
   parts. Two sets of at least the wanted similarity differ in at most k hashes, hence in
   at most k parts; with more than k parts of two hashes or more, they agree in one of
   these. A set's parts, digested, are its signatures. A set with too few such parts also
   gives the hashes of its prefix, which two such sets must share.
3. Sets that share signatures, directly or in a chain, are a block; a block of several
   chunks is cut again by a second exact rule, the prefix of each set's rarest hashes. In a
   block the sets are searched one after the other: an inverted index over those before is
   asked for sets that share T hashes. DivideSkip merges the short lists with a heap and
   probes the long ones by binary search. What copies were made from comes first; a set
   linked to such a hub is not looked up again among the sets that the hub's component holds.
4. Links of different sets are joined to components.

Large blocks are dealt out in chunks, and each pair of chunks is a task of its own, so a
task holds at most two chunks. No list of pairs is ever written: a task gives at most one
link for each set it holds.

Rules for odd rows
    * Null and empty texts have the empty set, size 0, and are linked with nothing.
    * A text with fewer words than a shingle has one shingle, the whole sequence.
    * Repeated rows and equal sets are one component; a null id is the smallest only where
      all ids are null, so a component's id is null only then.
    * Empty tables give empty results; extra columns take no part.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.components import components
from tidemark.llm.words import text_of
from tidemark.session import stored

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
MULTIPLIER = 0x9E3779B97F4A7C15
SETS_PER_CHUNK = 2_000
MU = 0.0085


def mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finisher."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The multiplier's powers and their inverses, kept for the longest text seen so far."""
    if len(_powers.get("up", ())) < n:
        size = 1 << max(16, (n - 1).bit_length())
        inverse = pow(MULTIPLIER, -1, 1 << 64)
        for name, base in (("up", MULTIPLIER), ("down", inverse)):
            row = np.full(size, base, dtype=np.uint64)
            row[0] = 1
            _powers[name] = np.cumprod(row)
    return _powers["up"], _powers["down"]


def shingle_set(text: str, size: int = 4) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``size`` words; A-Z in lower case."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), dtype=np.uint8)
    space = np.ones(len(raw) + 2, dtype=bool)
    space[1:-1] = IS_SPACE[raw]
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    up, down = powers(len(raw))
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
    words = mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    n = min(size, len(words))
    out = np.full(len(words) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        out = mixed(out * np.uint64(MULTIPLIER) + words[k : k + len(out)])
    return np.unique(out)


def set_id(hashes: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


@cache
def bands(percent: int) -> list[int]:
    """Lower bounds of the size bands: sets of two sizes that can link are at most one band apart."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(out[-1] * 100 // percent + 1)
    return out


def most_apart(a: int, b: int, percent: int) -> int:
    """Most hashes in which two sets of these sizes differ when they link."""
    return (100 - percent) * (a + b) // (100 + percent)


def signatures(hashes: np.ndarray, percent: int) -> np.ndarray:
    """The digests of the set's parts in its own band and the next."""
    n = len(hashes)
    bounds = bands(percent)
    own = int(np.searchsorted(bounds, n, side="right")) - 1
    out, short = [], False
    for band in (own, own + 1):
        top = bounds[band + 1] - 1
        apart = most_apart(top, top, percent)
        parts = 1 if apart == 0 else apart + 1 + -(-(apart + 1) // 10) + 1
        part = (mixed(hashes ^ np.uint64(band + 1)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        part = part[order]
        starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        counts = np.diff(np.append(starts, n))
        sums = np.add.reduceat(mixed(hashes * np.uint64(MULTIPLIER))[order], starts)
        full = counts >= (1 if parts == 1 else 2)
        key = part[starts].astype(np.uint64) * np.uint64(MULTIPLIER) + np.uint64(band)
        out.append(mixed(mixed(key) ^ sums)[full])
        short |= int(full.sum()) <= most_apart(n, min(top, n * 100 // percent), percent)
    if short:
        out.append(mixed(hashes[: n - -(-percent * n // 100) + 1]))
    return np.unique(np.concatenate(out))


def t_occurrence(lists: list[array], least: int) -> dict[int, int]:
    """Ids found on at least ``least`` of the ascending lists, with their numbers: DivideSkip."""
    if len(lists) < least:
        return {}
    lists = sorted(lists, key=len)
    skipped = min(least - 1, int(least / (MU * math.log2(len(lists[-1]) + 1) + 1)))
    short, long = lists[: len(lists) - skipped], lists[len(lists) - skipped :]
    merged = Counter(heapq.merge(*short))
    found = np.array([i for i, n in merged.items() if n >= least - skipped], dtype=np.int32)
    counts = np.array([merged[i] for i in found.tolist()], dtype=np.int64)
    for left, places in zip(range(len(long), 0, -1), long, strict=True):
        open_ = counts + left >= least
        if not open_.all():
            found, counts = found[open_], counts[open_]
        if not len(found):
            return {}
        row = np.frombuffer(places, dtype=np.int32)
        # Binary search of every candidate still open in the long list.
        at = np.minimum(np.searchsorted(row, found), len(row) - 1)
        counts += row[at] == found
    return {i: n for i, n in zip(found.tolist(), counts.tolist(), strict=True) if n >= least}


def central_first(sets: list[tuple[int, np.ndarray]]) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(sid, hashes, those of them that another set holds too) of each set.

    Sets whose hashes most others hold come first: what copies were made from, before the copies.
    """
    if not sets:
        return []
    _, where, counts = np.unique(np.concatenate([h for _, h in sets]), return_inverse=True, return_counts=True)
    held = counts.astype(np.int32)[where]
    starts = np.cumsum([0] + [len(h) for _, h in sets])
    mean = np.add.reduceat(held, starts[:-1], dtype=np.int64) / [len(h) for _, h in sets]
    order = sorted(range(len(sets)), key=lambda i: (-mean[i], sets[i][0]))
    return [(*sets[i], sets[i][1][held[starts[i] : starts[i + 1]] > 1]) for i in order]


def links(sets: list[tuple[int, np.ndarray]], percent: int) -> Iterator[tuple[int, int]]:
    """Links that join the components of the sets given: at most one less than there are sets.

    A set that a hub of the main component links to needs no other link into it: it is
    looked up only among the sets that were outside of it when they came. A hash that one
    set alone holds is not indexed: nothing asks for it.
    """
    sets = central_first(sets)
    root = list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def linked(both: int, a: int, b: int) -> bool:
        return 100 * both >= percent * (a + b - both)

    main: dict[int, array] = {}
    rest: dict[int, array] = {}
    hubs: list[int] = []
    for i, (sid, hashes, shared) in enumerate(sets):
        n = len(hashes)
        by_hub = False
        for c in hubs:
            other = sets[c][1]
            if linked(min(n, len(other)), n, len(other)) and linked(
                len(np.intersect1d(hashes, other, assume_unique=True)), n, len(other)
            ):
                root[i] = find(c)
                by_hub = True
                yield sid, sets[c][0]
                break
        tokens = shared.tolist()
        for index in (rest,) if by_hub else (main, rest):
            lists = [index[t] for t in tokens if t in index]
            for c, both in t_occurrence(lists, -(-percent * n // 100)).items():
                if linked(both, n, len(sets[c][1])) and find(i) != find(c):
                    root[find(i)] = find(c)
                    yield sid, sets[c][0]
        inside = not hubs or find(i) == find(hubs[0])
        if inside and not by_hub and len(hubs) < 4:
            hubs.append(i)
        index = main if inside else rest
        for t in tokens:
            if t in index:
                index[t].append(i)
            else:
                index[t] = array("i", (i,))


def sized(docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """(doc_id, key, n, sid) of each document; ``key`` is a hash of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, names = [], []
            for at in range(0, batch.num_rows, 256):
                for t in batch.column(2)[at : at + 256].to_pylist():
                    hashes = shingle_set(t, size)
                    sizes.append(len(hashes))
                    names.append(set_id(hashes))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(names, pa.int64())],
                names=["doc_id", "key", "n", "sid"],
            )

    body = text_of(docs[text])
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(body).alias("key"), body.alias("text"))
    return rows.mapInArrow(run, "doc_id long, key long, n long, sid long")


def signed(docs: DataFrame, text: str, size: int, percent: int) -> DataFrame:
    """(sig, sid): the signatures of each document's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                sids, sigs = [], []
                for t in batch.column(0)[at : at + 256].to_pylist():
                    hashes = shingle_set(t, size)
                    if len(hashes):
                        sigs.append(signatures(hashes, percent))
                        sids.append(np.full(len(sigs[-1]), set_id(hashes), dtype=np.int64))
                if sigs:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(sigs).view(np.int64)), pa.array(np.concatenate(sids))], names=["sig", "sid"]
                    )

    return docs.select(text_of(docs[text]).alias("text")).mapInArrow(run, "sig long, sid long")


def candidate_edges(entries: DataFrame) -> DataFrame:
    """(a, b): each set that shares a signature, with the smallest set that has it."""
    running = Window.partitionBy("sig").orderBy("sid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = entries.select("sid", F.min("sid").over(running).alias("first"))
    return first.where("sid <> first").select(F.col("sid").alias("a"), F.col("first").alias("b")).distinct()


def set_texts(docs: DataFrame, ids: DataFrame, wanted: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The columns of ``wanted``, one of which is ``sid``, with a text that may have that set."""
    # One document of each set, by id and text: rows that share an id do not meet each other's sets.
    one = ids.where("n > 0").groupBy("sid").agg(F.min(F.struct("doc_id", "key")).alias("one"))
    reps = wanted.join(one.select("sid", "one.doc_id", "one.key"), "sid")
    body = text_of(docs[text])
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.xxhash64(body).alias("text_key"), body.alias("text"))
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("text_key") == F.col("key"))
    return texts.join(reps, same).select(*wanted.columns, "text")


def rare_first(docs: DataFrame, ids: DataFrame, members: DataFrame, doc_id: str, text: str, size: int, percent: int) -> DataFrame:
    """(sig, sid): of the sets ``members`` the rarest hashes, so many that sets that link share one.

    Two sets that link share at least ``percent`` of either's hashes, hence one of those that
    come first in an order all sets have in common, as many as may be missing and one. The
    order is by the number of sets that hold a hash: what only one holds is met nowhere, and
    lines that many texts quote come last. A set that has more hashes of its own than may be
    missing has no entry.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = [(shingle_set(t, size), sid) for sid, t in zip(*map(pa.Array.to_pylist, part.columns), strict=True)]
                rows = [(hashes, sid) for hashes, sid in rows if set_id(hashes) == sid]
                if rows:
                    sids = np.repeat(np.array([sid for _, sid in rows], dtype=np.int64), [len(h) for h, _ in rows])
                    hashes = np.concatenate([h for h, _ in rows]).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(sids)], names=["hash", "sid"])

    rows = set_texts(docs, ids, members, doc_id, text).mapInArrow(run, "hash long, sid long")
    held = rows.withColumn("sets", F.count("*").over(Window.partitionBy("hash"))).where("sets > 1")
    # As a set: a row that comes twice gives its hashes twice.
    shared = held.groupBy("sid").agg(F.sort_array(F.collect_set(F.struct("sets", "hash"))).alias("shared"))
    sizes = ids.where("n > 0").groupBy("sid").agg(F.min("n").alias("n"))
    many = F.expr(f"cast(greatest(size(shared) - (n * {percent} + 99) div 100 + 1, 0) AS int)")
    first = shared.join(sizes, "sid").select("sid", F.explode(F.slice("shared", F.lit(1), many)).alias("x"))
    return first.select(F.col("x.hash").alias("sig"), "sid")


def refined(docs: DataFrame, ids: DataFrame, blocks: DataFrame, doc_id: str, text: str, size: int, percent: int) -> DataFrame:
    """Blocks (node, label) of which those of several chunks are cut again by their rarest hashes.

    Texts that quote the same lines now and then share a part, and with many of them such parts
    chain all into one block, which grows with the table.
    """
    large = stored(blocks.groupBy("label").count().where(F.col("count") > SETS_PER_CHUNK).select("label"), "large-blocks")
    if large.isEmpty():
        return blocks
    members = blocks.join(large, "label", "left_semi").select(F.col("node").alias("sid"))
    again = components(candidate_edges(rare_first(docs, ids, members, doc_id, text, size, percent)))
    return blocks.join(large, "label", "left_anti").select("node", "label").union(again)


def block_texts(docs: DataFrame, ids: DataFrame, blocks: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(label, i, j, sid, text): a text of each set in a block, for each task that the set takes part in."""
    counts = blocks.groupBy("label").agg(F.expr(f"(count(*) + {SETS_PER_CHUNK - 1}) div {SETS_PER_CHUNK}").alias("chunks"))
    dealt = (
        blocks.join(counts, "label")
        .withColumn("chunk", F.expr("pmod(xxhash64(node), chunks)"))
        .withColumn(
            "tasks",
            F.expr(
                "CASE WHEN chunks = 1 THEN array(struct(0L AS i, 0L AS j)) ELSE transform(filter(sequence(0L, chunks - 1),"
                " o -> o <> chunk), o -> struct(least(o, chunk) AS i, greatest(o, chunk) AS j)) END"
            ),
        )
        .select(F.col("node").alias("sid"), "label", "tasks")
    )
    return (
        set_texts(docs, ids, dealt, doc_id, text)
        .select("sid", "label", F.explode("tasks").alias("task"), "text")
        .select("label", "task.i", "task.j", "sid", "text")
    )


def block_links(docs: DataFrame, ids: DataFrame, blocks: DataFrame, doc_id: str, text: str, size: int, percent: int) -> DataFrame:
    """(a, b): links between the sets of each block."""
    rows = (
        block_texts(docs, ids, blocks, doc_id, text)
        .repartition("label", "i", "j")
        .sortWithinPartitions("label", "i", "j", "sid")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def sets() -> Iterable[tuple[tuple, int, np.ndarray]]:
            for batch in batches:
                for label, i, j, sid, body in batch.itertuples(index=False):
                    hashes = shingle_set(body, size)
                    # Another text with the same id and key is not the one looked for.
                    if set_id(hashes) == sid:
                        yield (label, i, j), sid, hashes

        for _, group in groupby(sets(), key=lambda x: x[0]):
            distinct = {sid: hashes for _, sid, hashes in group}
            if found := list(links(list(distinct.items()), percent)):
                yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return rows.mapInPandas(run, "a long, b long")


def _labelled(docs: DataFrame, doc_id: str, text: str, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key, n, label) of the documents with a set, and (doc_id, key, n) of the others."""
    ids = stored(sized(docs, doc_id, text, size), "shingle-sets")
    blocks = components(candidate_edges(signed(docs, text, size, percent)))
    blocks = refined(docs, ids, blocks, doc_id, text, size, percent)
    found = components(block_links(docs, ids, blocks, doc_id, text, size, percent))
    named = ids.where("n > 0").join(found.withColumnRenamed("node", "sid"), "sid", "left")
    named = named.select("doc_id", "key", "n", F.coalesce("label", "sid").alias("label"))
    return named, ids.where("n = 0").select("doc_id", "key", "n")


def joined(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 4, percent: int = 85
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each document."""
    named, empty = _labelled(docs, doc_id, text, size, percent)
    smallest = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    full = named.join(smallest, "label").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = empty.select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.unionByName(alone)


def representatives(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80
) -> DataFrame:
    """The document with the smallest id of each component, in the columns of ``docs``.

    Of rows with the same id and text one stays; null ids come after all others. Texts
    without a word are components of their own.
    """
    named, empty = _labelled(docs, doc_id, text, size, percent)
    last = F.coalesce("doc_id", F.lit(2**63 - 1)).alias("doc")
    first = named.groupBy("label").agg(F.min(F.struct(last, "key")).alias("first")).select("first.doc", "first.key")
    kept = first.union(empty.select(last, "key")).distinct()
    rows = docs.select(
        F.struct("*").alias("row"),
        F.coalesce(docs[doc_id].cast("long"), F.lit(2**63 - 1)).alias("doc"),
        F.xxhash64(text_of(docs[text])).alias("key"),
    )
    return rows.join(kept, ["doc", "key"]).dropDuplicates(["doc", "key"]).select("row.*")
