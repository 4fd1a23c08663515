"""Alignment of the tokens of two tokenizers, with a fast path for identical tokens.

Tokenizer A is a byte-level BPE, B a SentencePiece model; both encode a blank and the text,
without special tokens. Byte offsets at which a token of either ends cut the text into
groups, and tokens of A and B whose byte ranges overlap are linked.

1. For every id of A the id of B with the same bytes is known beforehand (the identity map).
   A group of one token each that the map foresees is counted in a vector as long as A's
   vocabulary. Only the other groups give pairs of ids, counted by chunk of documents.
2. The counts of all chunks are added up, and each id of B gets its highest count. The
   vector, as long as A's vocabulary, goes to every task; the pairs a chunk holds go back to
   that chunk, where its documents are summed up.

Texts are encoded by units: a blank and what follows up to the next one, where no token of
either tokenizer can cross the cut. Units seen before are looked up. Chunks are bounded by
the pairs their documents hold, so a task holds one chunk whatever the size of the corpus.

Rules for odd rows
    * A null or empty text, and one whose joined tokens are not a blank and the text in
      UTF-8 (such as one that holds U+2581), has no tokens: all numbers are 0, the digest ''.
    * Strings of special tokens inside a text are plain text.
    * Repeated rows count as often as they occur; null ids are handed through.
    * Empty tables give empty results; a carried column named like a made one is replaced.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.words import carried, handed_back, text_of
from tidemark.session import stored

# Fixed value: how byte-level BPE splits a text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
MARK = "▁"
# Units kept by a worker, and signs up to which a unit is kept.
KEPT, KEPT_SIGNS = 120_000, 48
# Signs from which a unit goes to the encoder whose time grows with its length only.
LONG = 256
# Documents encoded side by side, and pairs of documents that end a chunk.
SLICE, CHUNK_PAIRS = 256, 2_000_000

# A cut before a blank is safe after a sign that is no white space, and before a single blank
# that a sign other than white space follows. A single blank at the end is left where it is.
CUT = re.compile(r"(?<=\S)(?= )(?! \Z)|(?<=[^ ])(?= \S)")
# Where it is not as simple as cutting at every blank.
ODD = re.compile(r"  |\s \s| \Z")


def byte_signs() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


@dataclass(frozen=True)
class Tokenizers:
    """Both tokenizers as their files' content."""

    a: str
    b: bytes

    def __reduce__(self):
        """Only the files' content is sent; what follows from it is worked out again."""
        return Tokenizers, (self.a, self.b)

    @classmethod
    def read(cls, a: str, b: str) -> "Tokenizers":
        """``a``: path of the byte-level BPE in JSON; ``b``: path of the SentencePiece model."""
        with open(a, encoding="utf-8") as file:
            text = file.read()
        with open(b, "rb") as file:
            return cls(text, file.read())

    @cached_property
    def _parsed(self) -> dict:
        return json.loads(self.a)

    @cached_property
    def processor(self) -> sentencepiece.SentencePieceProcessor:
        return sentencepiece.SentencePieceProcessor(model_proto=self.b)

    @cached_property
    def bytes_a(self) -> list[bytes]:
        vocab, sign = self._parsed["model"]["vocab"], byte_signs()
        out = [b""] * (max([*vocab.values(), *(t["id"] for t in self._parsed["added_tokens"])]) + 1)
        added = {t["content"] for t in self._parsed["added_tokens"]}
        for token, i in vocab.items():
            if token not in added:
                out[i] = bytes(sign[c] for c in token)
        return out

    @cached_property
    def bytes_b(self) -> list[bytes]:
        b = self.processor
        out = []
        for i in range(b.get_piece_size()):
            piece = b.id_to_piece(i)
            if b.is_byte(i):
                out.append(bytes([int(piece[3:5], 16)]))
            elif b.is_control(i) or b.is_unknown(i) or b.is_unused(i):
                out.append(b"")
            else:
                out.append(piece.replace(MARK, " ").encode())
        return out

    @cached_property
    def identity(self) -> np.ndarray:
        """For each id of A the id of B with the same bytes, -1 without one; whole pieces before bytes."""
        b = self.processor
        ids: dict[bytes, int] = {}
        for by_byte in (True, False):
            for i in reversed(range(len(self.bytes_b))):
                if self.bytes_b[i] and b.is_byte(i) == by_byte:
                    ids[self.bytes_b[i]] = i
        return np.array([ids.get(t, -1) if t else -1 for t in self.bytes_a], dtype=np.int64)

    @cached_property
    def by_units(self) -> bool:
        """Whether no token of either crosses a safe cut."""
        before = self._parsed["pre_tokenizer"] or {}
        plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        return (
            plain
            and not self._parsed["normalizer"]
            and not any(MARK in self.processor.id_to_piece(i).lstrip(MARK) for i in range(len(self.bytes_b)))
        )

    @cached_property
    def _library(self) -> tokenizers.Tokenizer:
        out = tokenizers.Tokenizer.from_str(self.a)
        out.encode_special_tokens = True
        return out

    @cached_property
    def _ranked(self) -> tiktoken.Encoding | None:
        """An encoder by ranks, where ids follow the order of the merges."""
        merges = [m.split(" ") if isinstance(m, str) else m for m in self._parsed["model"]["merges"]]
        vocab = self._parsed["model"]["vocab"]
        made = [vocab[left + right] for left, right in merges]
        if not self.by_units or made != sorted(made):
            return None
        ranks = {t: i for i, t in enumerate(self.bytes_a) if t}
        return tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode_a(self, texts: Sequence[str]) -> list[list[int]]:
        ranked = self._ranked
        if ranked is None or any(len(t) > LONG for t in texts):
            short = [t for t in texts if ranked is not None and len(t) <= LONG]
            quick = iter([ranked.encode_ordinary(t) for t in short] if ranked is not None else [])
            return [
                next(quick) if ranked is not None and len(t) <= LONG else self._library.encode(t, add_special_tokens=False).ids
                for t in texts
            ]
        return [ranked.encode_ordinary(t) for t in texts]

    def encode_b(self, texts: Sequence[str]) -> list[list[int]]:
        return self.processor.encode(list(texts), num_threads=1)

    def units(self, text: str) -> list[str]:
        """The units of a blank and the text, each without its first blank."""
        if not self.by_units:
            return [text]
        if ODD.search(text) is None and text[:1] not in ("", " "):
            return text.split(" ")
        return [unit[1:] for unit in CUT.split(" " + text)]


def gathered(offsets: np.ndarray, data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries of the rows, one row after the other, and each row's number of them."""
    lengths = offsets[rows + 1] - offsets[rows]
    at = np.arange(lengths.sum()) + np.repeat(offsets[rows] - (np.cumsum(lengths) - lengths), lengths)
    return data[at], lengths


class Units:
    """Aligned units by number: sums, digest text, regular ids of A and other pairs."""

    def __init__(self, both: Tokenizers):
        self.both = both
        self.number: dict[str, int] = {}
        self.lengths = [np.array([len(t) for t in table], dtype=np.int64) for table in (both.bytes_a, both.bytes_b)]
        self.clear()

    def clear(self) -> None:
        self.number.clear()
        self.text: list[str] = []
        self.sums = array("q")  # n_a, n_b, n_groups, n_links, whether its bytes come back
        self.regular, self.regular_at = array("q"), array("q", [0])
        self.pairs, self.pairs_at = array("q"), array("q", [0])

    def numbers(self, units: Sequence[str]) -> list[int]:
        """The number of each unit; new ones are aligned first."""
        known = self.number
        out = list(map(known.get, units))
        if None in out:
            self.add(list(dict.fromkeys(u for u, n in zip(units, out, strict=True) if n is None)))
            out = [known[u] if n is None else n for u, n in zip(units, out, strict=True)]
        return out

    def end_slice(self) -> None:
        """Forget what is not worth keeping once the slice's numbers are used up."""
        if len(self.text) > KEPT or len(self.pairs) + len(self.regular) > 20 * KEPT:
            self.clear()
        elif self.long_units:
            for unit in self.long_units:
                del self.number[unit]
        self.long_units = []

    long_units: list[str] = []

    def add(self, units: list[str]) -> None:
        both = self.both
        first = len(self.text)
        self.number.update(zip(units, range(first, first + len(units))))
        self.long_units = [*self.long_units, *(u for u in units if len(u) > KEPT_SIGNS)]
        raw = [(" " + u).encode("utf-8", "surrogatepass") for u in units]
        a, b = both.encode_a([" " + u for u in units]), both.encode_b(units)
        good = [
            bool(r) and b"".join(map(both.bytes_a.__getitem__, x)) == r and b"".join(map(both.bytes_b.__getitem__, y)) == r
            for r, x, y in zip(raw, a, b, strict=True)
        ]
        a = [x if g else [] for x, g in zip(a, good, strict=True)]
        b = [x if g else [] for x, g in zip(b, good, strict=True)]
        n_a, n_b = np.array([len(x) for x in a], dtype=np.int64), np.array([len(x) for x in b], dtype=np.int64)
        ids_a = np.fromiter((i for x in a for i in x), dtype=np.int64, count=n_a.sum())
        ids_b = np.fromiter((i for x in b for i in x), dtype=np.int64, count=n_b.sum())
        ends_a, ends_b = np.cumsum(self.lengths[0][ids_a]), np.cumsum(self.lengths[1][ids_b])
        ends = np.union1d(ends_a, ends_b)
        # Between two ends lies what one token of A and one of B have in common: a link.
        at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        groups = np.intersect1d(ends_a, ends_b)
        group = np.searchsorted(groups, ends)
        size = np.bincount(group, minlength=len(groups))
        unit_ends = np.cumsum([len(r) if g else 0 for r, g in zip(raw, good, strict=True)])
        unit_of_group = np.searchsorted(unit_ends, groups) if len(groups) else np.empty(0, dtype=np.int64)
        n_groups = np.bincount(unit_of_group, minlength=len(units))
        n_links = np.bincount(unit_of_group[group], minlength=len(units)) if len(group) else np.zeros(len(units), np.int64)
        sums = np.stack([n_a, n_b, n_groups, n_links, np.array(good, dtype=np.int64)], axis=1)
        self.sums.frombytes(sums.astype(np.int64).tobytes())

        link_a, link_b = ids_a[at_a], ids_b[at_b]
        regular = (size[group] == 1) & (both.identity[link_a] == link_b)
        unit_of_link = unit_of_group[group] if len(group) else np.empty(0, dtype=np.int64)
        for kind, values, data, offsets in (
            (regular, link_a, self.regular, self.regular_at),
            (~regular, link_a * len(both.bytes_b) + link_b, self.pairs, self.pairs_at),
        ):
            counts = np.bincount(unit_of_link[kind], minlength=len(units))
            offsets.frombytes((offsets[-1] + np.cumsum(counts)).astype(np.int64).tobytes())
            data.frombytes(values[kind].astype(np.int64).tobytes())

        # The text of each group; tokens that end within it are at_a + 1 up to the last link's.
        last = np.cumsum(size) - 1
        to_a, to_b = (at_a[last] + 1).tolist(), (at_b[last] + 1).tolist()
        list_a, list_b = list(map(str, ids_a.tolist())), list(map(str, ids_b.tolist()))
        texts, i, j = [], 0, 0
        for k, m in zip(to_a, to_b, strict=True):
            if k - i == 1 and m - j == 1:
                texts.append(f"{list_a[i]}|{list_b[j]}")
            else:
                texts.append(f"{','.join(list_a[i:k])}|{','.join(list_b[j:m])}")
            i, j = k, m
        at = 0
        for n in n_groups.tolist():
            self.text.append(";".join(texts[at : at + n]))
            at += n


_units: dict[str, Units] = {}


def units_of(both: Tokenizers) -> Units:
    """The worker's table of units for these tokenizers."""
    key = hashlib.md5(both.a.encode() + both.b).hexdigest()
    if key not in _units:
        _units.clear()
        _units[key] = Units(both)
    return _units[key]


def counted(doc: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, value, times), sorted."""
    order = np.lexsort((values, doc))
    doc, values = doc[order], values[order]
    new = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (values[1:] != values[:-1])))) if len(doc) else order
    return doc[new], values[new], np.diff(np.append(new, len(doc)))


def parts(data: np.ndarray, doc: np.ndarray, n_docs: int) -> list[bytes]:
    """The values of each document as bytes."""
    bounds = np.searchsorted(doc, np.arange(n_docs + 1))
    raw, width = data.tobytes(), data.itemsize
    return [raw[x * width : y * width] for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


SUMS = ("n_a", "n_b", "n_groups", "n_links")
MADE = "chunk long, whole boolean, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, " + (
    "regular binary, regular_n binary, pairs binary, pairs_n binary"
)
ARROW = pa.schema(
    [("chunk", pa.int64()), ("whole", pa.bool_()), *[(n, pa.int64()) for n in SUMS], ("groups_sha256", pa.string())]
    + [(n, pa.binary()) for n in ("regular", "regular_n", "pairs", "pairs_n")]
)


def merged(values: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, sorted, and the sum of their times."""
    found, where = np.unique(np.concatenate(values), return_inverse=True)
    return found, np.bincount(where, weights=np.concatenate(times), minlength=len(found)).astype(np.int64)


def encoded_parts(docs: DataFrame, text: str, both: Tokenizers, carry: Sequence[str] | None) -> DataFrame:
    """A row for each document, and one with ``whole`` set for each chunk of them."""
    model = docs.sparkSession.sparkContext.broadcast(both)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = units_of(model.value)
        context = TaskContext.get()
        chunk = (context.partitionId() if context else 0) << 32
        seen: dict[str, list[list[np.ndarray]]] = {"regular": [[], []], "pairs": [[], []]}
        held = 0

        def whole(row_type: pa.DataType) -> pa.RecordBatch:
            out = {"row": pa.nulls(1, row_type), "chunk": [chunk], "whole": [True]}
            out |= {name: [0] for name in SUMS} | {"groups_sha256": [""]}
            for name, (values, times) in seen.items():
                found, n = merged(values, times) if values else (np.empty(0, np.int64), np.empty(0, np.int64))
                out |= {name: [found.tobytes()], f"{name}_n": [n.tobytes()]}
                seen[name] = [[], []]
            return pa.RecordBatch.from_arrays(
                [out["row"], *[pa.array(out[f.name], f.type) for f in ARROW]], names=["row", *ARROW.names]
            )

        row_type = None
        for batch in batches:
            row_type = batch.column(0).type
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                lists = [units.both.units(t) if t else [] for t in part.column(1).to_pylist()]
                flat = units.numbers([u for x in lists for u in x])
                n = np.array([len(x) for x in lists], dtype=np.int64)
                at = np.cumsum(n) - n
                number, doc = np.array(flat, dtype=np.int64), np.repeat(np.arange(len(lists)), n)
                table = np.frombuffer(units.sums, dtype=np.int64).reshape(-1, 5)
                bad = np.bincount(doc, weights=1 - table[number, 4], minlength=len(lists)) > 0
                sums = [np.where(bad, 0, np.bincount(doc, weights=table[number, k], minlength=len(lists))).astype(np.int64) for k in range(4)]
                digests = [
                    hashlib.sha256(";".join(map(units.text.__getitem__, flat[i : i + k])).encode()).hexdigest() if k and not b else ""
                    for i, k, b in zip(at.tolist(), n.tolist(), bad.tolist(), strict=True)
                ]
                out = {"chunk": [chunk] * len(lists), "whole": [False] * len(lists), "groups_sha256": digests}
                out |= dict(zip(SUMS, sums, strict=True))
                good = ~bad[doc]
                for name, data, offsets in (("regular", units.regular, units.regular_at), ("pairs", units.pairs, units.pairs_at)):
                    values, lengths = gathered(
                        np.frombuffer(offsets, dtype=np.int64), np.frombuffer(data, dtype=np.int64), number[good]
                    )
                    of, values, times = counted(np.repeat(doc[good], lengths), values)
                    out |= {name: parts(values, of, len(lists)), f"{name}_n": parts(times, of, len(lists))}
                    if len(values):
                        found, m = merged([values], [times])
                        seen[name][0].append(found)
                        seen[name][1].append(m)
                    held += len(values)
                del table
                units.end_slice()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(out[f.name], f.type) for f in ARROW]], names=["row", *ARROW.names]
                )
                if held > CHUNK_PAIRS:
                    yield whole(row_type)
                    chunk, held = chunk + 1, 0
        if row_type is not None:
            yield whole(row_type)

    rows = docs.select(carried(docs, carry), text_of(docs[text]).alias("text"))
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, {MADE}")


def chunk_pairs(wholes: DataFrame, both: Tokenizers) -> DataFrame:
    """(chunk, pair, n, regular) of each chunk; a pair is A's id times B's ids plus B's id."""
    identity, size_b = both.identity, len(both.bytes_b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for name in ("regular", "pairs"):
                    values = np.frombuffer(row[name], dtype=np.int64)
                    times = np.frombuffer(row[f"{name}_n"], dtype=np.int64)
                    if name == "regular":
                        values = values * size_b + identity[values]
                    chunk, regular = np.full(len(values), row["chunk"]), np.full(len(values), name == "regular")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in (chunk, values, times, regular)], names=["chunk", "pair", "n", "regular"]
                    )

    return wholes.select("chunk", "regular", "regular_n", "pairs", "pairs_n").mapInArrow(
        run, "chunk long, pair long, n long, regular boolean"
    )


def aligned(
    docs: DataFrame, both: Tokenizers, text: str = "text", carry: Sequence[str] | None = None
) -> DataFrame:
    """Each document with its tokens, groups, links, and how common its links are in the corpus.

    ``n_best`` counts the links whose pair of ids is the most frequent one of its B id,
    ``count_sum`` adds up the corpus-wide counts of all links.
    """
    names = docs.columns if carry is None else list(carry)
    rows = stored(encoded_parts(docs, text, both, carry), "aligned-parts")
    by_chunk = stored(chunk_pairs(rows.where("whole"), both), "aligned-pairs")
    size_b = len(both.bytes_b)
    counts = by_chunk.groupBy("pair").agg(F.sum("n").alias("count"), F.max("regular").alias("regular"))
    # An id of B meets at most as many ids as A has.
    highest = F.max("count").over(Window.partitionBy(F.col("pair") % size_b))
    counts = stored(counts.withColumn("best", F.col("count") == highest), "aligned-counts")

    # At most one row for each id of A.
    known = counts.where("regular").select((F.col("pair") / size_b).cast("long").alias("a"), "count", "best").toArrow()
    count_of, best_of = np.zeros(len(both.bytes_a), dtype=np.int64), np.zeros(len(both.bytes_a), dtype=np.int64)
    ids = known.column("a").to_numpy()
    count_of[ids], best_of[ids] = known.column("count").to_numpy(), known.column("best").to_numpy(zero_copy_only=False)
    vectors = docs.sparkSession.sparkContext.broadcast((count_of, best_of))

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        of, best = vectors.value
        order = np.argsort(right.column("pair").to_numpy())
        pair = right.column("pair").to_numpy()[order]
        pair_of = right.column("count").to_numpy()[order]
        pair_best = right.column("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
        n_best, count_sum = [np.zeros(left.num_rows, dtype=np.int64) for _ in range(2)]
        for name in ("regular", "pairs"):
            values = left.column(name).to_pylist()
            at = np.repeat(np.arange(left.num_rows), [len(x) // 8 for x in values])
            values = np.frombuffer(b"".join(values), dtype=np.int64)
            times = np.frombuffer(b"".join(left.column(f"{name}_n").to_pylist()), dtype=np.int64)
            if name == "pairs":
                where = np.searchsorted(pair, values)
                each, good = pair_of[where], pair_best[where]
            else:
                each, good = of[values], best[values]
            np.add.at(count_sum, at, each * times)
            np.add.at(n_best, at, good * times)
        return pa.table({"row": left.column("row"), **{c: left.column(c) for c in (*SUMS, "groups_sha256")}, "n_best": n_best, "count_sum": count_sum})

    back = by_chunk.where("NOT regular").select("chunk", "pair").join(counts.select("pair", "count", "best"), "pair")
    row_type = rows.schema["row"].dataType.simpleString()
    found = (
        rows.where("NOT whole")
        .groupBy("chunk")
        .cogroup(back.groupBy("chunk"))
        .applyInArrow(
            summed,
            f"row {row_type}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long",
        )
    )
    made = (*SUMS, "n_best", "count_sum", "groups_sha256")
    return handed_back(found, names, {name: F.col(name) for name in made})
