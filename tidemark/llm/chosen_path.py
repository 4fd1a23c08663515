"""Near-duplicates by a chosen-path set similarity join.

Each text becomes the set of 64-bit hashes of its word shingles; texts with equal sets are
one set from here on. A set is represented by ``COORDINATES`` minwise tokens.

1. In every tree a set starts at the root and goes on to one child for each of two minwise
   tokens, which the path to its node chooses: sets that agree in a chosen token meet. Two
   sets of similarity s part at a node with (1 - s)^2, so a pair at the threshold is missed
   by a tree with ``missed``; trees are repeated until the target recall is reached.
2. A node of few sets is compared exhaustively, by the share of equal tokens. What looks
   alike is confirmed on full sets: first a star for each group, then those groups, exhaustively,
   that the confirmed links leave in several components.
3. In a node of many sets the one most like the rest is compared with all of it. By the
   triangle inequality of the Jaccard distance, a set linked to this pivot can only be linked to
   sets within twice the linking distance of it. Those of them the pivot is not linked to are
   compared, on full sets and in pairs of blocks, with each other and with the linked sets
   that can reach them. After that the linked sets leave the node, and those between need
   not meet each other again: they are not *fresh*. Nodes with few fresh sets are compared
   at once, fresh ones with all, the others branch on.
4. Nodes that still have many fresh sets at the last level are compared in blocks, without a limit.

The work around a pivot grows with the sets between times the sets that reach them. Near
copies that all link to what they were made from have none between, and cost a comparison each.

Links are confirmed on full sets only; components are made of them. A set that looks alike
by chance costs a comparison, never a link.

Rules for odd rows
    * Null and empty texts, and those without a word, have the empty set: size 0, linked
      with nothing, kept.
    * A text with fewer words than a shingle has one shingle, the whole sequence.
    * Repeated rows and equal sets are one component, and each row comes back; a null id is
      the smallest only where all ids are null, and its row is kept only then.
    * Empty tables give empty results; extra columns take no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.jaccard import MULTIPLIER, mixed, set_id, shingle_set
from tidemark.llm.words import text_of
from tidemark.session import broadcast_if_small, stored

COORDINATES = 128
# Sets up to which a node is compared at once, and that a block of a larger one holds.
NODE, BLOCK = 128, 500
# Fresh sets up to which a node that was split is compared in blocks rather than split again.
FEW = 5_000
LEVELS = 8
# Coordinates that tell how alike the sets of a large node are.
MODE = 32
# Standard deviations by which an estimate may fall below the similarity and still count.
SLACK = 4.0


def trees_for(percent: int, recall: float) -> int:
    """Trees needed: two children for each set survive any depth with (2s - 1) / s^2."""
    s = percent / 100
    missed = 1 - (2 * s - 1) / s**2
    return max(1, math.ceil(math.log(1 - recall) / math.log(missed)))


def least_equal(percent: float) -> int:
    """Equal tokens from which two sets may have the similarity."""
    s = percent / 100
    return math.floor(COORDINATES * s - SLACK * math.sqrt(COORDINATES * s * (1 - s)))


def minwise(sets: list[np.ndarray]) -> np.ndarray:
    """A row of ``COORDINATES`` tokens for each set; none of them is empty."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *[len(s) for s in sets[:-1]]])
    salts = mixed(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(MULTIPLIER))
    out = np.empty((len(sets), COORDINATES), dtype=np.uint32)
    for i, salt in enumerate(salts):
        out[:, i] = np.minimum.reduceat((flat ^ salt) * (salt | np.uint64(1)), starts) >> np.uint64(32)
    return out


def sketched(docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """(doc_id, key, n, sid, tokens, marks) of each document; ``marks`` is a byte of each token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                sets = [shingle_set(t, size) for t in part.column(2).to_pylist()]
                full = [s for s in sets if len(s)]
                tokens = iter(minwise(full) if full else [])
                rows = [next(tokens) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([set_id(s) for s in sets], pa.int64()),
                        pa.array([None if r is None else r.tobytes() for r in rows], pa.binary()),
                        pa.array([None if r is None else r.astype(np.uint8).tobytes() for r in rows], pa.binary()),
                    ],
                    names=["doc_id", "key", "n", "sid", "tokens", "marks"],
                )

    body = text_of(docs[text])
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(body).alias("key"), body.alias("text"))
    return rows.mapInArrow(run, "doc_id long, key long, n long, sid long, tokens binary, marks binary")


def matrix(column: pa.Array, dtype: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype).reshape(-1, COORDINATES)


# -- branching -------------------------------------------------------------------------


def child(node: np.ndarray, coordinate: np.ndarray, token: np.ndarray) -> np.ndarray:
    step = mixed((coordinate.astype(np.uint64) << np.uint64(32)) | token.astype(np.uint64))
    return mixed(node * np.uint64(MULTIPLIER) + step)


def from_roots(sets: DataFrame, trees: int) -> DataFrame:
    """(node, sid): two children of each tree's root for each set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = matrix(batch.column(1), np.uint32)
            for i in range(2 * trees):
                root = np.full(len(tokens), i // 2 + 1, dtype=np.uint64)
                node = child(root, np.full(len(tokens), i % COORDINATES), tokens[:, i % COORDINATES])
                yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), batch.column(0)], names=["node", "sid"])

    return sets.select("sid", "tokens").mapInArrow(run, "node long, sid long")


def branched(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, sid, fresh): two children of its node for each set, by tokens that the node's path chooses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = batch.column(0).to_numpy().view(np.uint64)
            tokens = matrix(batch.column(2), np.uint32)
            pick = mixed(node + np.uint64(1))
            first = pick % np.uint64(COORDINATES)
            other = (first + np.uint64(1) + (pick >> np.uint64(32)) % np.uint64(COORDINATES - 1)) % np.uint64(COORDINATES)
            for at in (first, other):
                token = tokens[np.arange(len(tokens)), at.astype(np.int64)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(child(node, at, token).view(np.int64)), batch.column(1), batch.column(3)],
                    names=["node", "sid", "fresh"],
                )

    full = rows.join(sets.select("sid", "tokens"), "sid").select("node", "sid", "tokens", "fresh")
    return full.mapInArrow(run, "node long, sid long, fresh boolean")


# -- small nodes -----------------------------------------------------------------------


def alike(marks: np.ndarray, least: int) -> np.ndarray:
    """Which pairs of the sets have at least so many equal tokens."""
    out = np.empty((len(marks), len(marks)), dtype=bool)
    for i in range(len(marks)):
        out[i] = (marks == marks[i]).sum(axis=1) >= least
    np.fill_diagonal(out, False)
    return out


def stars(near: np.ndarray) -> list[tuple[int, int]]:
    """(centre, other): each set that is like another one is in one star; centres with the most pairs first."""
    out, free = [], near.any(axis=1)
    for centre in np.argsort(-near.sum(axis=1), kind="stable").tolist():
        if free[centre]:
            free[centre] = False
            others = np.flatnonzero(near[centre] & free)
            free[others] = False
            out += [(centre, x) for x in others.tolist()]
    return out


def groups(near: np.ndarray) -> list[np.ndarray]:
    """The sets that pairs connect, each group of at least three."""
    left, out = near.any(axis=1), []
    while left.any():
        inside = np.zeros(len(near), dtype=bool)
        edge = inside.copy()
        edge[np.argmax(left)] = True
        while edge.any():
            inside |= edge
            edge = near[edge].any(axis=0) & ~inside
        left &= ~inside
        if inside.sum() > 2:
            out.append(np.flatnonzero(inside))
    return out


def compared(leaves: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """(a, b) of the stars, and (sids) of groups that have more pairs; a node's sets are few."""
    rows = leaves.join(sets.select("sid", "marks"), "sid")
    nodes = rows.groupBy("node").agg(F.collect_list(F.struct("sid", "marks")).alias("sets")).where(F.size("sets") > 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                centres, others, more = [], [], []
                for members in batch.column(0).slice(start, 500).to_pylist():
                    members = sorted({m["sid"]: m["marks"] for m in members}.items())
                    near = alike(np.frombuffer(b"".join(m for _, m in members), dtype=np.uint8).reshape(-1, COORDINATES), least)
                    if not near.any():
                        continue
                    sids = np.array([sid for sid, _ in members], dtype=np.int64)
                    found = stars(near)
                    centres += [int(sids[i]) for i, _ in found]
                    others += [int(sids[j]) for _, j in found]
                    centre_of = np.array([i for i, _ in found])
                    for group in groups(near):
                        # More pairs than the stars have, which lie within one group each.
                        if near[group].sum() > 2 * np.isin(centre_of, group).sum():
                            more.append(sids[group].tolist())
                nothing = [None] * len(more)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(centres + nothing, pa.int64()),
                        pa.array(others + nothing, pa.int64()),
                        pa.array([None] * len(centres) + more, pa.list_(pa.int64())),
                    ],
                    names=["a", "b", "sids"],
                )

    return nodes.select("sets").mapInArrow(run, "a long, b long, sids array<long>")


def open_groups(rest: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, sid): the groups that hold different labels so far."""
    members = rest.select(F.xxhash64("sids").alias("node"), F.explode("sids").alias("sid"))
    known = members.join(labels.withColumnRenamed("node", "sid"), "sid", "left").withColumn("label", F.coalesce("label", "sid"))
    mixed_ = known.groupBy("node").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("node")
    return known.join(mixed_, "node", "left_semi").select("node", "sid")


# -- large nodes -----------------------------------------------------------------------


def pivots(rows: DataFrame) -> DataFrame:
    """(node, pivot, pivot_marks): the set of each node (node, sid, marks) that agrees most with its commonest tokens."""

    def common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, where = np.unique(batch.column(0).to_numpy(), return_inverse=True)
            marks = matrix(batch.column(2), np.uint8)[:, :MODE].astype(np.int64)
            place = np.arange(MODE) * 256 + marks
            keys, n = np.unique(where[:, None] * (MODE * 256) + place, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[keys // (MODE * 256)]), pa.array(keys % (MODE * 256) // 256), pa.array(keys % 256), pa.array(n)],
                names=["node", "at", "mark", "n"],
            )

    counted = rows.mapInArrow(common, "node long, at long, mark long, n long").groupBy("node", "at", "mark").agg(F.sum("n").alias("n"))
    best = counted.groupBy("node", "at").agg(F.max(F.struct("n", "mark")).alias("best"))
    modes = best.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("at", "best.mark"))).alias("modes"))
    modes = stored(modes.select("node", F.col("modes.mark").alias("modes")), "modes")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = matrix(batch.column(2), np.uint8)[:, :MODE]
            modes = np.array(batch.column(3).to_pylist(), dtype=np.int64).reshape(-1, MODE)
            score = (marks == modes).sum(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(score)], names=["node", "sid", "marks", "score"])

    full = rows.join(broadcast_if_small(modes), "node").select("node", "sid", "marks", "modes")
    full = full.mapInArrow(scored, "node long, sid long, marks binary, score long")
    first = full.groupBy("node").agg(F.max(F.struct("score", "sid", "marks")).alias("one"))
    return first.select("node", F.col("one.sid").alias("pivot"), F.col("one.marks").alias("pivot_marks"))


def near_pivot(rows: DataFrame, chosen: DataFrame, least: int) -> DataFrame:
    """(node, a, b): the pivot and each set of its node that looks like it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            equal = (matrix(batch.column(3), np.uint8) == matrix(batch.column(4), np.uint8)).sum(axis=1) >= least
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(equal)) for c in batch.columns[:3]], names=["node", "a", "b"])

    both = rows.join(broadcast_if_small(chosen), "node").where("sid <> pivot")
    return both.select("node", F.col("pivot").alias("a"), F.col("sid").alias("b"), "pivot_marks", "marks").mapInArrow(
        run, "node long, a long, b long"
    )


def placed(near: DataFrame, exact: DataFrame, percent: int) -> DataFrame:
    """(node, a, b, d, linked, between): the distance of each set from its node's pivot, and its kind.

    What is ``between`` the pivot's links and the far sets is linked with nothing the pivot
    links to, unless it is compared with it.
    """
    far = 1 - percent / 100
    known = near.join(exact, ["a", "b"]).withColumn("d", 1 - F.col("both") / (F.col("n_a") + F.col("n_b") - F.col("both")))
    linked = F.expr(f"100 * both >= {percent} * (n_a + n_b - both)")
    return known.select("node", "a", "b", "d", linked.alias("linked"), (~linked & (F.col("d") <= 2 * far + 1e-9)).alias("between"))


def around_pivots(known: DataFrame, percent: int) -> DataFrame:
    """(node, sid, fresh): around each pivot, the sets between (fresh) and the linked ones that can reach them."""
    far = 1 - percent / 100
    each = known.groupBy("a", "b").agg(F.first("d").alias("d"), F.first("linked").alias("linked"), F.first("between").alias("between"))
    each = stored(each.where("linked OR between"), "around-pivots")
    nearest = each.where("between").groupBy("a").agg(F.min("d").alias("nearest"))
    return (
        each.join(broadcast_if_small(stored(nearest, "nearest")), "a")
        .where(F.col("between") | (F.col("d") >= F.col("nearest") - far - 1e-9))
        .select(F.col("a").alias("node"), F.col("b").alias("sid"), F.col("between").alias("fresh"))
    )


def left_over(rows: DataFrame, chosen: DataFrame, known: DataFrame) -> DataFrame:
    """(node, sid, fresh): without the pivots and what they link to; what lies between is fresh no more."""
    seen = known.where("linked OR between").select("node", F.col("b").alias("sid"), "linked").unionByName(
        chosen.select("node", F.col("pivot").alias("sid"), F.lit(True).alias("linked"))
    )
    both = rows.select("node", "sid", "fresh").join(seen, ["node", "sid"], "left")
    return both.where("linked IS NULL OR NOT linked").select("node", "sid", (F.col("fresh") & F.col("linked").isNull()).alias("fresh"))


def in_blocks(rows: DataFrame, block: int) -> DataFrame:
    """(node, sid): nodes as pairs of blocks, so that each fresh set meets all others of its node.

    Sets that are not fresh do not meet each other. A set is sent once for each block it meets.
    """
    count = "CAST((count_if({}) + {}) div {} AS BIGINT)"
    sizes = rows.groupBy("node").agg(
        F.expr(count.format("fresh", block - 1, block)).alias("s"), F.expr(count.format("NOT fresh", block - 1, block)).alias("c")
    )
    sizes = stored(sizes.where("s > 0"), "block-counts")
    up_to = "filter(sequence(0L, greatest({0}, 1L) - 1), o -> {0} > 0)".format
    to_fresh = f"transform({up_to('s')}, o -> xxhash64(node, 0, least(o, block), greatest(o, block)))"
    to_others = f"transform({up_to('c')}, o -> xxhash64(node, 1, block, o))"
    from_others = f"transform({up_to('s')}, o -> xxhash64(node, 1, o, block))"
    return (
        rows.join(broadcast_if_small(sizes), "node")
        .withColumn("block", F.expr("pmod(xxhash64(sid), CASE WHEN fresh THEN s ELSE c END)"))
        .select(F.explode(F.expr(f"CASE WHEN fresh THEN concat({to_fresh}, {to_others}) ELSE {from_others} END")).alias("node"), "sid")
    )


def dealt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes with few fresh sets as (node, sid), ready to be compared; the rows of the others."""
    many = stored(rows.groupBy("node").agg(F.count_if("fresh").alias("f")).where(F.col("f") > FEW).select("node"), "large-nodes")
    marked = broadcast_if_small(many)
    return in_blocks(rows.join(marked, "node", "left_anti"), BLOCK), rows.join(marked, "node", "left_semi")


# -- full sets -------------------------------------------------------------------------


def full_sets(wanted: DataFrame, docs: DataFrame, sets: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """(sid, hashes) of the sets asked for, from a text of each."""
    ones = sets.select("sid", "one").join(wanted.select("sid").distinct(), "sid").select("sid", "one.*")
    # Few sets at a time are looked at again: the texts are not shuffled for them, unless they are many.
    ones = broadcast_if_small(stored(ones, "wanted-sets"))
    body = text_of(docs[text])
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.xxhash64(body).alias("text_key"), body.alias("text"))
    rows = texts.join(ones, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("text_key") == F.col("key"))).select("sid", "text")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                found = [shingle_set(t, size) for t in part.column(1).to_pylist()]
                # Another text with the same id and key is not the one looked for.
                good = [set_id(s) == sid for s, sid in zip(found, part.column(0).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).filter(pa.array(good)),
                        pa.array([s.tobytes() for s, g in zip(found, good, strict=True) if g], pa.binary()),
                    ],
                    names=["sid", "hashes"],
                )

    return stored(rows.mapInArrow(hashed, "sid long, hashes binary").dropDuplicates(["sid"]), "full-sets")


def confirmed(pairs: DataFrame, full: DataFrame) -> DataFrame:
    """(a, b, both, n_a, n_b): how many shingles the full sets of each pair have in common."""

    def common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both, sizes = [], [[], []]
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = [np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in (x, y)]
                both.append(len(np.intersect1d(x, y, assume_unique=True)))
                sizes[0].append(len(x))
                sizes[1].append(len(y))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(c, pa.int64()) for c in (both, *sizes)]], names=["a", "b", "both", "n_a", "n_b"]
            )

    right = pairs.join(full.select(F.col("sid").alias("b"), F.col("hashes").alias("hashes_b")), "b")
    both = right.join(full.select(F.col("sid").alias("a"), F.col("hashes").alias("hashes_a")), "a")
    found = both.select("a", "b", "hashes_a", "hashes_b").mapInArrow(common, "a long, b long, both long, n_a long, n_b long")
    return stored(found, "confirmed")


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """The number of hashes that each pair of sets has in common."""
    _, where, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.where(counts > 1, np.cumsum(counts > 1) - 1, -1)[where]
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])[shared >= 0]
    shared = shared[shared >= 0]
    out = np.zeros((len(sets), len(sets)), dtype=np.float64)
    order = np.argsort(shared, kind="stable")
    shared, row = shared[order], row[order]
    for first in range(0, int(shared[-1]) + 1 if len(shared) else 0, 4_096):
        x, y = np.searchsorted(shared, [first, first + 4_096])
        held = np.zeros((len(sets), 4_096), dtype=np.float32)
        held[row[x:y], shared[x:y] - first] = 1
        out += held @ held.T
    return out


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what all links connect."""
    left, out = linked.any(axis=1), []
    while left.any():
        queue = [int(np.argmax(left))]
        left[queue[0]] = False
        while queue:
            i = queue.pop()
            found = np.flatnonzero(linked[i] & left).tolist()
            left[found] = False
            queue += found
            out += [(i, j) for j in found]
    return out


def linked_within(tasks: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that connect what the links within each node (node, sid) connect, on full sets."""
    rows = tasks.join(full, "sid").select("node", "sid", "hashes").repartition("node").sortWithinPartitions("node", "sid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def members() -> Iterator[tuple[int, int, bytes]]:
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    yield from zip(*[c.to_pylist() for c in batch.slice(at, 256).columns], strict=True)

        for _, group in groupby(members(), key=lambda m: m[0]):
            found = {sid: np.frombuffer(h, dtype=np.uint64) for _, sid, h in group}
            sids, sets = list(found), list(found.values())
            both, n = overlaps(sets), np.array([len(s) for s in sets])
            linked = 100 * both >= percent * (n[:, None] + n[None, :] - both)
            np.fill_diagonal(linked, False)
            if edges := forest(linked):
                yield pa.RecordBatch.from_arrays([pa.array([sids[e[k]] for e in edges], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return stored(rows.mapInArrow(run, "a long, b long"), "links-within")


# -- the join --------------------------------------------------------------------------


def labelled(
    docs: DataFrame, doc_id: str, text: str, size: int, percent: int, recall: float
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key, n, sid) of each document, and (node, label) of the sets that have links."""
    ids = stored(sketched(docs, doc_id, text, size), "sketches")
    one = F.min(F.struct("doc_id", "key")).alias("one")
    sets = stored(ids.where("n > 0").groupBy("sid").agg(F.first("tokens").alias("tokens"), F.first("marks").alias("marks"), one), "sets")
    link = F.expr(f"100 * both >= {percent} * (n_a + n_b - both)")
    full = lambda wanted: full_sets(wanted, docs, sets, doc_id, text, size)
    ends = lambda pairs: pairs.select(F.col("a").alias("sid")).union(pairs.select("b"))

    rows = stored(from_roots(sets, trees_for(percent, recall)), "nodes")
    many = stored(rows.groupBy("node").count().where(F.col("count") > NODE).select("node"), "large-nodes")
    marked = broadcast_if_small(many)
    leaves, links = [rows.join(marked, "node", "left_anti")], []
    rows = rows.join(marked, "node", "left_semi").withColumn("fresh", F.lit(True))
    for level in range(LEVELS):
        many = stored(rows.join(sets.select("sid", "marks"), "sid").select("node", "sid", "marks", "fresh"), "many")
        if many.isEmpty():
            break
        chosen = stored(pivots(many.where("fresh")), "pivots")
        near = stored(near_pivot(many, chosen, least_equal(2 * percent - 100)), "near-pivots")
        pairs = stored(near.select("a", "b").distinct(), "pivot-pairs")
        whole = full(ends(pairs))
        exact = confirmed(pairs, whole)
        known = stored(placed(near, exact, percent), "placed")
        links.append(exact.where(link).select("a", "b"))
        links.append(linked_within(in_blocks(around_pivots(known, percent), BLOCK), whole, percent))
        small, rows = dealt(stored(left_over(many, chosen, known), "left-over"))
        leaves.append(small)
        if level == LEVELS - 1:
            leaves.append(in_blocks(stored(rows, "last-nodes"), BLOCK))
            break
        rows = stored(rows, "large-rest")
        if rows.isEmpty():
            break
        small, rows = dealt(stored(branched(rows, sets), "nodes"))
        leaves.append(small)

    small = leaves[0]
    for more in leaves[1:]:
        small = small.unionByName(more)
    found = stored(compared(small, sets, least_equal(percent)), "compared")
    pairs = found.where("a IS NOT NULL").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = stored(pairs, "star-pairs")
    links.append(confirmed(pairs, full(ends(pairs))).where(link).select("a", "b"))
    edges = links[0]
    for more in links[1:]:
        edges = edges.unionByName(more)
    edges = stored(edges.distinct(), "links")
    labels = components(edges)
    rest = found.where("sids IS NOT NULL").select("sids").distinct()
    open_ = stored(open_groups(rest, labels), "open-groups")
    if not open_.isEmpty():
        more = linked_within(open_, full(open_), percent)
        labels = components(edges.unionByName(more))
    return ids.select("doc_id", "key", "n", "sid"), labels


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = 5,
    percent: int = 80,
    recall: float = 0.99999,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each document.

    Two documents link when their sets' similarity is at least ``percent``; a linked pair at
    the threshold is found with probability ``recall`` or more. ``kept`` marks the documents
    whose id is their component's.
    """
    ids, labels = labelled(docs, doc_id, text, size, percent, recall)
    named = ids.where("n > 0").join(labels.withColumnRenamed("node", "sid"), "sid", "left")
    named = named.select("doc_id", "n", F.coalesce("label", "sid").alias("label"))
    smallest = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    full = named.join(smallest, "label").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = ids.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
