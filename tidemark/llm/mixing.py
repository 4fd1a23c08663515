"""Mixing sources to target weights, in blocks of words.

The words of a source, document after document in a fixed random order, are cut into
blocks of fixed length. Output shards draw how many slots each source gets; a slot's
number goes through a pseudorandom permutation of its source's blocks, once per epoch,
and the slots are joined to the blocks by number. Slots below twice the number of blocks
use each block at most twice, so no document is taken more than twice.

Nothing is gathered per source: documents are spread over buckets of a source, the
buckets' totals are summed up first, and offsets inside a bucket are added to them.
The driver sees one row for each source and one for each shard and source.

Rules for odd rows
    * A null text has size 0; a null source is a source of its own, last in order.
    * Rows that repeat are documents of their own and are packed one after the other.
    * Empty tables, and tables without a word, give targets and takings of 0.
    * Extra columns are handed through; made columns replace those of the same name.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.words import carried, handed_back, text_of, words_of
from tidemark.session import stored

SOURCES = pa.schema(
    [
        ("source", pa.string()),
        ("rank", pa.int32()),
        ("source_size", pa.int64()),
        ("blocks", pa.int64()),
        ("target", pa.float64()),
        ("slots", pa.int64()),
    ]
)
COUNTS = pa.schema([("shard", pa.int64()), ("rank", pa.int32()), ("first", pa.int64()), ("n", pa.int64())])


@dataclass(frozen=True)
class Plan:
    """``weights`` repeat over the sources in order; ``share`` is the mix's size over the input's."""

    weights: tuple[float, ...] = (5, 2, 1)
    share: float = 1.5
    repeats: int = 2
    block_words: int = 128
    shard_slots: int = 1 << 18
    bucket_rows: int = 4_000
    rounds: int = 12
    seed: int = 20_240_601


def targets(sizes: Sequence[int], plan: Plan) -> list[float]:
    """Words wanted of each source: by weight, stopped at ``repeats`` times its size, the excess dealt again."""
    weights = [plan.weights[i % len(plan.weights)] for i in range(len(sizes))]
    caps = [plan.repeats * s for s in sizes]
    total = plan.share * sum(sizes)
    out = [0.0] * len(sizes)
    open_ = [i for i, s in enumerate(sizes) if s > 0]
    while open_:
        rest = total - sum(out[i] for i in range(len(sizes)) if i not in set(open_))
        weight = sum(weights[i] for i in open_)
        over = [i for i in open_ if rest * weights[i] / weight > caps[i]]
        if not over:
            for i in open_:
                out[i] = rest * weights[i] / weight
            break
        for i in over:
            out[i] = float(caps[i])
        open_ = [i for i in open_ if i not in set(over)]
    return out


def shard_counts(slots: Sequence[int], plan: Plan) -> list[tuple[int, int, int, int]]:
    """(shard, source rank, first slot, slots): multinomial draws shard by shard.

    Each shard's draw uses what is still wanted of each source as its weights, and what
    exceeds that is drawn again, so that the sources' sums come out as wanted.
    """
    rng = np.random.default_rng(plan.seed)
    left = np.array(slots, dtype=np.int64)
    taken = np.zeros_like(left)
    out = []
    shard = 0
    while left.sum() > 0:
        room = int(min(plan.shard_slots, left.sum()))
        drawn = np.zeros_like(left)
        while room > 0:
            free = left - drawn
            more = np.minimum(rng.multinomial(room, free / free.sum()), free)
            drawn += more
            room -= int(more.sum())
        out += [(shard, i, int(taken[i]), int(n)) for i, n in enumerate(drawn) if n]
        taken += drawn
        left -= drawn
        shard += 1
    return out


def handed_over(spark: SparkSession, rows: Sequence[tuple], schema: pa.Schema) -> DataFrame:
    """The driver's few rows as a table; as Arrow data, which no Python worker has to read again."""
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema))


def permuted(slots: DataFrame, plan: Plan) -> DataFrame:
    """Adds ``block``: the slot's number sent through a permutation of ``blocks`` numbers.

    Swap-or-not rounds: a number and its partner swap or stay by one bit of a hash that
    is the same for both, which is a permutation for any count.
    """
    key = [F.lit(plan.seed), F.col("rank"), F.col("epoch")]

    def swapped(number: Column, turn: Column) -> Column:
        partner = F.pmod(F.xxhash64(*key, turn) - number, F.col("blocks"))
        bit = F.xxhash64(*key, turn, F.greatest(number, partner)).bitwiseAND(F.lit(1))
        return F.when(bit == 1, partner).otherwise(number)

    turns = F.sequence(F.lit(1), F.lit(plan.rounds))
    return slots.withColumn("block", F.aggregate(turns, F.col("slot") % F.col("blocks"), swapped))


class Mix:
    """A mix over ``docs``; its documents are sized and placed once, in the shared folder."""

    def __init__(
        self,
        docs: DataFrame,
        text: str = "text",
        source: str = "source",
        carry: Sequence[str] | None = None,
        plan: Plan = Plan(),
    ):
        self.plan = plan
        self.spark: SparkSession = docs.sparkSession
        self.text = text
        self.names = docs.columns if carry is None else list(carry)
        rows = docs.select(
            carried(docs, [n for n in self.names if n != text] or [source]),
            docs[source].cast("string").alias("source"),
            F.md5(docs[text].cast("string")).alias("digest"),
            docs[text].alias("text"),
        )
        rows = rows.withColumn("place", F.xxhash64(F.lit(plan.seed), "digest", "row"))
        # Texts stay out of what is written and placed; they are joined to the result once.
        self.texts = rows.groupBy("place", "digest").agg(F.first("text").alias("text"))
        sized = rows.select("row", "source", F.size(words_of(text_of("text"))).cast("long").alias("size"), "digest", "place")
        sized = stored(sized, "mix-sizes")
        self.sources = self._sources(sized)
        self.docs = self._placed(sized)

    def _sources(self, sized: DataFrame) -> DataFrame:
        found = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
        found.sort(key=lambda r: (r.source is None, r.source or ""))
        self.buckets = math.ceil(sum(r.n for r in found) / self.plan.bucket_rows) or 1
        sizes = [r["size"] for r in found]
        blocks = [math.ceil(s / self.plan.block_words) for s in sizes]
        wanted = targets(sizes, self.plan)
        slots = [
            min(self.plan.repeats * b, round(w * b / s)) if s else 0 for s, b, w in zip(sizes, blocks, wanted, strict=True)
        ]
        self.counts = shard_counts(slots, self.plan)
        rows = [
            (r.source, i, *x) for i, (r, x) in enumerate(zip(found, zip(sizes, blocks, wanted, slots, strict=True), strict=True))
        ]
        return F.broadcast(handed_over(self.spark, rows, SOURCES))

    def _placed(self, sized: DataFrame) -> DataFrame:
        """Adds ``start``: the words of the same source before this document."""
        rows = sized.withColumn("bucket", F.pmod("place", F.lit(self.buckets)))
        before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        totals = (
            rows.groupBy("source", "bucket")
            .agg(F.sum("size").alias("size"))
            .select("source", "bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
        )
        inside = (
            Window.partitionBy("source", "bucket")
            .orderBy("place", "digest")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        rows = rows.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        rows = rows.alias("r").join(
            totals.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source")) & (F.col("r.bucket") == F.col("t.bucket"))
        )
        rows = rows.select("row", F.col("r.source").alias("source"), "size", "digest", "place", (F.col("base") + F.col("inner")).alias("start"))
        placed = rows.alias("r").join(self.sources.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source")))
        return stored(
            placed.select("row", "size", "digest", "place", "start", "rank", "source_size", "target"), "mix-docs"
        )

    def pieces(self) -> DataFrame:
        """Blocks with the parts of documents they hold: rank, block, start, from_word, n."""
        length = self.plan.block_words
        last = F.col("start") + F.col("size") - 1
        rows = self.docs.where("size > 0").select(
            "rank", "start", "size", F.explode(F.sequence(F.expr(f"start div {length}"), F.expr(f"(start + size - 1) div {length}"))).alias("block")
        )
        begin = F.greatest(F.col("block") * length, F.col("start"))
        end = F.least((F.col("block") + 1) * length - 1, last)
        return rows.select(
            "rank", "block", "start", (begin - F.col("start")).alias("from_word"), (end - begin + 1).alias("n")
        )

    def slots(self, step: int = 4096) -> DataFrame:
        """Every slot: shard, place in its shard, rank, epoch and block."""
        counts = handed_over(self.spark, self.counts, COUNTS)
        # A stated number of tasks: by their size in bytes the few rows would go to one.
        tasks = math.ceil(sum(n for *_, n in self.counts) / (16 * step)) or 1
        parts = counts.select(
            "shard", "rank", "first", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {step}"))).alias("part")
        ).repartition(tasks, "shard", "rank", "part")
        slots = parts.select(
            "shard",
            "rank",
            F.explode(
                F.sequence(
                    F.col("first") + F.col("part") * step,
                    F.col("first") + F.least(F.col("n"), (F.col("part") + 1) * step) - 1,
                )
            ).alias("slot"),
        )
        slots = slots.join(self.sources.select("rank", "blocks"), "rank").withColumn("epoch", F.expr("slot div blocks"))
        slots = slots.withColumn("place", F.xxhash64(F.lit(self.plan.seed), "shard", "rank", "slot"))
        return permuted(slots, self.plan).select("shard", "place", "rank", "epoch", "block")

    def mixed(self) -> DataFrame:
        """The mix: for each slot the parts of documents in its block."""
        # Slots are far more than the few counts that Spark sees them made of: not to be broadcast.
        return self.slots().hint("merge").join(self.pieces(), ["rank", "block"])

    def takings(self) -> DataFrame:
        """Each document with ``size``, ``source_size``, ``target`` and ``taken`` words."""
        uses = self.slots().groupBy("rank", "block").agg(F.count("*").alias("uses"))
        taken = (
            self.pieces()
            .join(uses.hint("merge"), ["rank", "block"])
            .groupBy("rank", "start")
            .agg(F.sum(F.col("n") * F.col("uses")).alias("taken"))
        )
        has_words = F.col("d.size") > 0
        joined = self.docs.alias("d").join(
            taken.alias("t"), (F.col("d.rank") == F.col("t.rank")) & (F.col("d.start") == F.col("t.start")) & has_words, "left"
        )
        joined = joined.select("d.row", "d.digest", "d.place", "d.size", "source_size", "target", "taken")
        made = {}
        if self.text in self.names:
            joined = self._with_texts(joined)
            made[self.text] = F.col("text")
        return handed_back(
            joined,
            self.names,
            {
                **made,
                "size": F.col("size"),
                "source_size": F.col("source_size"),
                "target": F.col("target"),
                "taken": F.coalesce(F.col("taken"), F.lit(0)).cast("long"),
            },
        )

    def _with_texts(self, rows: DataFrame) -> DataFrame:
        """Adds ``text``; a row's place is a hash of all its columns, so that copies of a text spread."""
        same = (F.col("m.place") == F.col("t.place")) & F.col("m.digest").eqNullSafe(F.col("t.digest"))
        return rows.alias("m").join(self.texts.alias("t"), same).select("m.*", "t.text")

    def documents(self, n_chars: str | None = "n_chars") -> DataFrame:
        """The mix as documents: a row per document and epoch it is used in.

        Its text is the words of the blocks taken in that epoch, in the document's order,
        with one blank between words; a document taken whole keeps its text as it is.
        """
        parts = (
            self.mixed()
            .groupBy("rank", "start", "epoch")
            .agg(F.sort_array(F.collect_list(F.struct("from_word", "n"))).alias("parts"), F.sum("n").alias("words"))
        )
        joined = self.docs.alias("d").where("size > 0").join(
            parts.alias("p"), (F.col("d.rank") == F.col("p.rank")) & (F.col("d.start") == F.col("p.start"))
        )
        joined = self._with_texts(joined.select("row", "digest", "place", "size", "words", "parts"))
        joined = joined.withColumn("tokens", words_of(text_of("text")))
        cut = F.array_join(
            F.transform("parts", lambda p: F.array_join(F.slice("tokens", (p["from_word"] + 1).cast("int"), p["n"].cast("int")), " ")), " "
        )
        joined = joined.withColumn("cut", F.when(F.col("words") == F.col("size"), F.col("text")).otherwise(cut))
        made: dict[str, Column] = {self.text: F.col("cut")}
        if n_chars in self.names:
            made[n_chars] = F.length("cut").cast("long")
        return joined.select(
            *[made[n].alias(n) if n in made else F.col("row").getField(n).alias(n) for n in self.names]
        )
