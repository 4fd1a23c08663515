"""Phrases that occur together more often than their parts would, by the stripes pattern.

A stripe belongs to a prefix of words: an associative counter of the word that follows it.
Tasks count stripes of their own, stripes of one prefix are merged elementwise, and a merged
stripe holds all that is asked for: how often each extension occurs, how often the prefix
occurs (the sum of its counts), and the most frequent extension, which may subsume it.

1. The stripe of the empty prefix counts words.
2. The stripes of words count pairs of words; those of pairs, in turn, count triples.

Between the levels a phrase is followed up only where both its ends can be frequent. What is
frequent is passed on as a bitmap of fixed size: a bit set by chance costs rows, never a
count, so however full it is the counts are exact. Other extensions are summed up under
``NONE``, so that the prefix's total stays whole.

Words are 64-bit hashes until the end; two words of one language with one hash are noticed
when words are counted, and the next seed is taken. A prefix that holds more than one part in
``HOT_SHARE`` of all words has its stripe split by the next word; there are at most
``HOT_SHARE`` of them.

Rules for odd rows
    * Null texts are empty; a null language is ``und``.
    * Repeated rows count as often as they occur.
    * Ties of the score go to the more frequent phrase, then to the smaller in UTF-8 bytes;
      ties of the cut to the earlier one.
    * Empty tables give empty results; extra columns take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.jaccard import MULTIPLIER, mixed, powers
from tidemark.llm.words import text_of
from tidemark.session import stored

# Signs (all ASCII) that end a piece, and those that end a word.
ENDS = np.zeros(256, dtype=bool)
ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
BREAKS = ENDS.copy()
BREAKS[[0x20, 0x09]] = True

NONE = 0
HOT_SHARE = 2_000
# Bits of the map of what is frequent: 4 MB.
BITS = 1 << 25
# Occurrences counted at a time in a task, bytes of text read at a time, entries of a row.
OCCURRENCES, SLICE, ENTRIES = 3_000_000, 1 << 20, 256
LONG_WORD = 255


def word_hashes(raw: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash, piece) of each word of the bytes; a hash is never ``NONE``."""
    apart = np.ones(len(raw) + 2, dtype=bool)
    apart[1:-1] = BREAKS[raw]
    edges = np.flatnonzero(apart[1:] != apart[:-1])
    starts, ends = edges[::2], edges[1::2]
    values = mixed(np.arange(1, 257, dtype=np.uint64) + np.uint64(seed << 9))
    up, down = powers(len(raw))
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(values[raw] * up[: len(raw)], out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    for i in np.flatnonzero(ends - starts > LONG_WORD).tolist():
        digest = hashlib.blake2b(raw[starts[i] : ends[i]].tobytes(), digest_size=8, salt=seed.to_bytes(8, "little"))
        hashes[i] = int.from_bytes(digest.digest(), "little")
    hashes[hashes == NONE] = 1
    return starts, ends, hashes, np.cumsum(ENDS[raw])[starts] if len(raw) else starts


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray]]:
    """(lang, bytes) of whole texts in lower case, a piece's end between them."""
    for batch in batches:
        held: dict[str, list[bytes]] = {}
        size = 0
        for start in range(0, batch.num_rows, 64):
            part = batch.slice(start, 64)
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                raw = text.encode("utf-8", "surrogatepass").lower()
                held.setdefault(lang, []).append(raw)
                size += len(raw)
            if size > SLICE or start + 64 >= batch.num_rows:
                for lang, texts in held.items():
                    yield lang, np.frombuffer(b"\n".join(texts), dtype=np.uint8)
                held, size = {}, 0


def lang_key(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little"))


def phrase_key(lang: str, *words: np.ndarray) -> np.ndarray:
    """One hash for a phrase, for the bitmap and for the list of hot prefixes."""
    out = words[0] ^ lang_key(lang)
    for word in words[1:]:
        out = mixed(out * np.uint64(MULTIPLIER) + word)
    return mixed(out)


def runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new run of equal keys starts, in keys that are sorted."""
    new = np.ones(len(keys[0]), dtype=bool)
    if len(new):
        new[1:] = False
        for key in keys:
            new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def binary_rows(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The entries from each start to the next as one binary value."""
    offsets = np.append(starts, len(data)).astype(np.int32) * data.itemsize
    return pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


# -- words ---------------------------------------------------------------------------


def counted_words(rows: DataFrame, seed: int) -> DataFrame:
    """(lang, h, word, n, clash): the empty prefix's stripe of each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray, pa.Array]]] = {}
        size = 0

        def flushed() -> Iterator[pa.RecordBatch]:
            for lang, found in held.items():
                h = np.concatenate([x[0] for x in found])
                words = pa.concat_arrays([x[2] for x in found])
                h, first, where = np.unique(h, return_index=True, return_inverse=True)
                n = np.bincount(where, weights=np.concatenate([x[1] for x in found])).astype(np.int64)
                for at in range(0, len(h), 50_000):
                    part = slice(at, at + 50_000)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(h[part]), pa.string()),
                            pa.array(h[part].view(np.int64)),
                            words.take(pa.array(first[part])),
                            pa.array(n[part]),
                        ],
                        names=["lang", "h", "word", "n"],
                    )

        for lang, raw in slices(batches):
            starts, ends, hashes, _ = word_hashes(raw, seed)
            h, first, n = np.unique(hashes, return_index=True, return_counts=True)
            lengths = (ends - starts)[first]
            offsets = np.append(0, np.cumsum(lengths))
            text = raw[np.arange(offsets[-1]) + np.repeat(starts[first] - offsets[:-1], lengths)]
            words = pa.StringArray.from_buffers(len(h), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(text))
            held.setdefault(lang, []).append((h, n, words))
            size += len(h)
            if size > OCCURRENCES:
                yield from flushed()
                held, size = {}, 0
        yield from flushed()

    found = rows.mapInArrow(run, "lang string, h long, word string, n long")
    return found.groupBy("lang", "h").agg(
        F.min("word").alias("word"), (F.min("word") != F.max("word")).alias("clash"), F.sum("n").alias("n")
    )


# -- what is frequent, and what is hot --------------------------------------------------


def bitmap(frequent: DataFrame, width: int) -> np.ndarray:
    """The bits of the phrases (lang, w1, ...) of ``width`` words; its size is fixed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(BITS, dtype=bool)
        for batch in batches:
            langs = batch.column(0).to_pandas()
            words = [batch.column(1 + i).to_numpy().view(np.uint64) for i in range(width)]
            for lang, at in langs.groupby(langs).indices.items():
                bits[phrase_key(lang, *[w[at] for w in words]) % np.uint64(BITS)] = True
        packed = np.packbits(bits).view(np.int64)
        slot = np.flatnonzero(packed)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(packed[slot])], names=["slot", "bits"])

    names = ["lang", *[f"w{i + 1}" for i in range(width)]]
    words = frequent.select(*names).mapInArrow(run, "slot long, bits long")
    # At most BITS / 64 rows.
    found = words.groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    packed = np.zeros(BITS // 64, dtype=np.int64)
    packed[found.column("slot").to_numpy()] = found.column("bits").to_numpy()
    return packed.view(np.uint8)


def is_set(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys % np.uint64(BITS)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & np.uint8(1) != 0


def hot_prefixes(prefixes: DataFrame, all_words: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, buckets) of the prefixes that hold more than one part in ``HOT_SHARE`` of all words."""
    names = [f"w{i + 1}" for i in range(width)]
    found = prefixes.where(F.col("n") * HOT_SHARE > all_words).select("lang", *names, "n").collect()
    out = sorted(
        (int(phrase_key(r["lang"], *[np.array([r[c]], dtype=np.int64).view(np.uint64) for c in names])[0]), -(-r["n"] * HOT_SHARE // all_words))
        for r in found
    )
    return np.array([k for k, _ in out], dtype=np.uint64), np.array([b for _, b in out], dtype=np.uint64)


# -- stripes ------------------------------------------------------------------------------


def stripes(rows: DataFrame, seed: int, width: int, bits: np.ndarray, hot: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(lang, p1, p2, bucket, next, n): counters of what follows prefixes of ``width`` words.

    Buckets of split stripes are numbered from 1; the others are bucket 0.
    """
    shared = rows.sparkSession.sparkContext.broadcast((bits, *hot))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, hot_keys, hot_buckets = shared.value
        held: dict[str, list[tuple[np.ndarray, ...]]] = {}
        size = 0

        def occurrences(lang: str, raw: np.ndarray) -> tuple[np.ndarray, ...]:
            _, _, h, piece = word_hashes(raw, seed)
            if len(h) < width:
                return tuple(np.empty(0, dtype=np.uint64) for _ in range(width + 2))
            # frequent[i]: whether the ``width`` words from i on can be frequent and lie in one piece
            ends = [h[i : len(h) - width + 1 + i] for i in range(width)]
            frequent = is_set(bits, phrase_key(lang, *ends)) & (piece[: len(ends[0])] == piece[width - 1 :])
            goes_on = np.zeros(len(frequent), dtype=bool)
            goes_on[:-1] = frequent[1:] & (piece[: len(frequent) - 1] == piece[width:])
            follower = np.zeros(len(frequent), dtype=np.uint64)
            follower[:-1] = h[width:]
            follower = np.where(goes_on, follower, np.uint64(NONE))[frequent]
            prefix = [e[frequent] for e in ends]
            bucket = np.zeros(len(follower), dtype=np.uint64)
            if len(hot_keys):
                key = phrase_key(lang, *prefix)
                at = np.minimum(np.searchsorted(hot_keys, key), len(hot_keys) - 1)
                bucket = np.where(hot_keys[at] == key, np.uint64(1) + follower % hot_buckets[at], np.uint64(0))
            return (*prefix, bucket, follower)

        def flushed() -> Iterator[pa.RecordBatch]:
            for lang, found in held.items():
                columns = [np.concatenate(c) for c in zip(*found, strict=True)]
                order = np.lexsort(columns[::-1])
                columns = [c[order] for c in columns]
                new = runs(*columns)
                n = np.diff(np.append(new, len(order))).astype(np.int64)
                *key, follower = [c[new] for c in columns]
                starts = runs(*key)
                # Long counters are cut, so that no row is large.
                lengths = np.diff(np.append(starts, len(n)))
                cuts = -(-lengths // ENTRIES)
                starts = np.repeat(starts, cuts) + ENTRIES * (np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts))
                p2 = key[1] if width == 2 else np.zeros(len(n), dtype=np.uint64)
                for at in range(0, len(starts), 20_000):
                    first = starts[at : at + 20_000]
                    last = starts[at + 20_000] if at + 20_000 < len(starts) else len(n)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(first), pa.string()),
                            *[pa.array(c[first].view(np.int64)) for c in (key[0], p2, key[-1])],
                            binary_rows(follower[first[0] : last], first - first[0]),
                            binary_rows(n[first[0] : last], first - first[0]),
                        ],
                        names=["lang", "p1", "p2", "bucket", "next", "n"],
                    )

        for lang, raw in slices(batches):
            found = occurrences(lang, raw)
            held.setdefault(lang, []).append(found)
            size += len(found[0])
            if size > OCCURRENCES:
                yield from flushed()
                held, size = {}, 0
        yield from flushed()

    return rows.mapInArrow(run, "lang string, p1 long, p2 long, bucket long, next binary, n binary")


def merged(found: DataFrame, least: int) -> DataFrame:
    """(lang, p1, p2, total, best, next, a): stripes merged elementwise, extensions of ``least`` or more.

    A task reads its stripes in the order of their prefixes and holds one of them at a time,
    beside the rows just read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key: tuple | None = None
        open_counter: tuple[np.ndarray, np.ndarray] = (np.empty(0, np.int64), np.empty(0, np.int64))

        def rows_of(names: list[tuple], run_of: np.ndarray, follower: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            totals = np.bincount(run_of, weights=n, minlength=len(names)).astype(np.int64)
            good = (follower != NONE) & (n >= least)
            best = np.zeros(len(names), dtype=np.int64)
            np.maximum.at(best, run_of[follower != NONE], n[follower != NONE])
            bounds = np.searchsorted(run_of[good], np.arange(len(names) + 1))
            # Parts of a split stripe are needed for the total even without a frequent extension.
            kept = np.flatnonzero((np.diff(bounds) > 0) | np.array([k[3] > 0 for k in names], dtype=bool))
            lists = [
                pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(x[good])).take(pa.array(kept)) for x in (follower, n)
            ]
            columns = list(zip(*[names[i] for i in kept.tolist()], strict=True)) or [()] * 3
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.string()),
                    pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.int64()),
                    pa.array(totals[kept]),
                    pa.array(best[kept]),
                    *lists,
                ],
                names=["lang", "p1", "p2", "total", "best", "next", "a"],
            )

        def summed(run_of: np.ndarray, follower: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
            order = np.lexsort((follower, run_of))
            run_of, follower, n = run_of[order], follower[order], n[order]
            new = runs(run_of, follower)
            return run_of[new], follower[new], np.add.reduceat(n, new) if len(new) else n

        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                keys = list(zip(*[part.column(i).to_pylist() for i in range(4)], strict=True))
                followers, counts = part.column(4).to_pylist(), part.column(5).to_pylist()
                names = [open_key] if open_key is not None else []
                run_of_row = []
                for key in keys:
                    if not names or names[-1] != key:
                        names.append(key)
                    run_of_row.append(len(names) - 1)
                run_of = np.repeat(run_of_row, [len(x) // 8 for x in counts])
                follower = np.frombuffer(b"".join(followers), dtype=np.int64)
                n = np.frombuffer(b"".join(counts), dtype=np.int64)
                run_of, follower, n = summed(
                    np.concatenate([np.zeros(len(open_counter[0]), np.int64), run_of]),
                    np.concatenate([open_counter[0], follower]),
                    np.concatenate([open_counter[1], n]),
                )
                last = np.searchsorted(run_of, len(names) - 1)
                if len(names) > 1:
                    yield rows_of(names[:-1], run_of[:last], follower[:last], n[:last])
                open_key, open_counter = names[-1], (follower[last:], n[last:])
        if open_key is not None:
            yield rows_of([open_key], np.zeros(len(open_counter[0]), np.int64), *open_counter)

    key = ["lang", "p1", "p2", "bucket"]
    rows = found.repartition(*[F.col(c) for c in key]).sortWithinPartitions(*key)
    return rows.mapInArrow(
        run, "lang string, p1 long, p2 long, total long, best long, next array<long>, a array<long>"
    )


def following(counted: DataFrame, width: int) -> DataFrame:
    """(lang, w1, .., a, total, best): one row for each extension of a merged stripe."""
    prefix = ["lang", "p1"] if width == 1 else ["lang", "p1", "p2"]
    whole = counted.groupBy(*prefix).agg(F.sum("total").alias("total"), F.max("best").alias("best"))
    each = counted.select(*prefix, F.explode(F.arrays_zip("next", "a")).alias("e")).select(*prefix, "e.next", "e.a")
    names = {"p1": "w1", "p2": "w2"}
    return each.join(whole, prefix).select(
        "lang", *[F.col(c).alias(names[c]) for c in prefix[1:]], F.col("next").alias(f"w{width + 1}"), "a", "total", "best"
    )


# -- collocations -----------------------------------------------------------------------------


def score(l: str, r: str) -> Column:
    """floor(1000000 * a * a / (l * r)) in whole numbers of up to 38 digits."""
    wide = "CAST({} AS DECIMAL(19, 0))".format
    return F.expr(f"(CAST(1000000 AS DECIMAL(7, 0)) * {wide('a')} * {wide('a')}) DIV ({wide(l)} * {wide(r)})")


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", least: int = 10, subsumed: int = 50, top: int = 2_000
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of two and three words of each language.

    ``a`` is how often the phrase occurs within a piece, ``l`` and ``r`` its parts at the cut
    that scores lowest, ``n`` the words of the language. A phrase is dropped where a longer
    one that holds it occurs at least ``subsumed`` percent as often.
    """
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), text_of(docs[text]).alias("text"))
    rows = rows.where("text <> ''")
    for seed in range(8):
        words = stored(counted_words(rows, seed), "words")
        if words.where("clash").isEmpty():
            break
    else:
        raise ValueError("words of one hash with every seed")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    all_words = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    frequent = words.where(F.col("n") >= least).select("lang", F.col("h").alias("w1"), "word", "n")

    def extended(prefixes: DataFrame, width: int) -> DataFrame:
        counted = merged(
            stripes(rows, seed, width, bitmap(prefixes, width), hot_prefixes(prefixes, all_words, width)), least
        )
        return stored(following(stored(counted, "stripes"), width), "phrases")

    pairs = extended(frequent, 1)
    triples = extended(pairs.withColumn("n", F.col("a")), 2)

    def named(df: DataFrame, i: int) -> DataFrame:
        return df.join(frequent.select("lang", F.col("w1").alias(f"w{i}"), F.col("word").alias(f"word{i}"), F.col("n").alias(f"n{i}")), ["lang", f"w{i}"])

    # What a pair is part of: the best extension of its own stripe, or of the word before it.
    behind = triples.select("lang", "w1", "w2", F.col("best").alias("longer"))
    before = triples.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), F.col("a").alias("longer"))
    longer = behind.unionByName(before).groupBy("lang", "w1", "w2").agg(F.max("longer").alias("longer"))
    two = (
        named(named(pairs, 1), 2)
        .join(longer, ["lang", "w1", "w2"], "left")
        .where((F.coalesce("longer", F.lit(0)) < least) | (100 * F.col("longer") < subsumed * F.col("a")))
        .select("lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), "a", F.col("total").alias("l"), F.col("n2").alias("r"))
        .withColumn("score", score("l", "r"))
    )
    ends = pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("end"))
    three = (
        named(named(named(triples.join(ends, ["lang", "w2", "w3"]), 1), 2), 3)
        .withColumn("first", score("n1", "end"))
        .withColumn("second", score("total", "n3"))
        .withColumn("early", F.col("first") <= F.col("second"))
        .select(
            "lang",
            F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"),
            "a",
            F.when(F.col("early"), F.col("n1")).otherwise(F.col("total")).alias("l"),
            F.when(F.col("early"), F.col("end")).otherwise(F.col("n3")).alias("r"),
            F.least("first", "second").alias("score"),
        )
    )
    best_first = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = two.unionByName(three).withColumn("rank", F.row_number().over(best_first).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
