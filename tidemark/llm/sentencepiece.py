"""SentencePiece encoding and decoding with a suffix array over each batch.

The distinct segments of a batch (a run of blanks and what follows up to the next) are put
one after the other; the suffix array of that text, ordered as far as the longest piece
reaches, is searched in two bisections for every piece of the model. Each occurrence is an
edge from its start to its end. The edges, sorted by position, are then relaxed:

    * unigram models: the best score of each place is passed on along the edges leaving it;
    * BPE models: an edge can be taken once two neighbouring symbols fill it; the best
      scored edge, the leftmost of equals, is taken until none is left.

A segment is independent of its neighbours only if no piece has a blank after another
sign; models with such pieces take the whole text as one segment. Signs without an edge
become their bytes' pieces, or the unknown piece in models without these.

The model file is read by the driver once and handed to the tasks; its path is an
argument. Models that normalise texts are refused, so that decoding gives back the text.

Rules for odd rows
    * A null text has null ids; an empty one none.
    * A blank mark U+2581 in a text is a blank after decoding, as the format has it;
      ``exact`` is false for such a text and true for every other one.
    * Repeated rows are encoded each; empty tables give empty results; extra columns are
      handed through, and a column with the name of a made one is replaced.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"
# Kinds of pieces and of models in the model file's format.
NORMAL, UNKNOWN, USER, UNUSED, BYTE = 1, 2, 4, 5, 6
UNIGRAM, BPE = 1, 2
# Longer segments are not relaxed side by side.
LONG = 48
# Most signs put into one index, unless one segment is longer; signs of segments, each
# counted with 16 more for its keeping, that a generation of remembered ones holds.
INDEX_CHARS, REMEMBERED = 1 << 17, 4_000_000
# Texts whose segments and ids a task holds at a time, as Python's objects.
TEXTS = 128


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 2: None, 5: 4}[key & 7]
            size = varint() if size is None else size
            yield key >> 3, data[at : at + size]
            at += size


def as_bytes(ids: Sequence[int]) -> bytes:
    return np.array(ids, dtype=np.int32).tobytes()


class Known:
    """The ids of segments met lately, in two generations of a bounded number of signs.

    When the younger one is full it becomes the older one. A segment found in the older one
    moves to the younger, so that frequent segments are never forgotten.
    """

    def __init__(self) -> None:
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def of(self, segments: list[str], model: "Model") -> list[bytes]:
        if self.held > REMEMBERED:
            self.old, self.young, self.held = self.young, {}, 0
        young, old = self.young, self.old
        found = list(map(young.get, segments))
        missing = dict.fromkeys(s for s, ids in zip(segments, found, strict=True) if ids is None)
        if missing:
            fresh = [s for s in missing if s not in old]
            missing.update((s, old[s]) for s in missing if s in old)
            missing.update(zip(fresh, model.encode_new(fresh), strict=True))
            # A very long segment is not worth its place.
            kept = {s: ids for s, ids in missing.items() if len(s) <= LONG}
            young.update(kept)
            self.held += sum(map(len, kept)) + 16 * len(kept)
            found = [missing[s] if ids is None else ids for s, ids in zip(segments, found, strict=True)]
        return found


@dataclass
class Model:
    """Pieces by id, with the settings that encoding needs."""

    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    algorithm: int = UNIGRAM
    byte_fallback: bool = False
    dummy_prefix: bool = True
    byte_ids: dict[int, int] = field(default_factory=dict)
    unknown: int = 0

    def __post_init__(self) -> None:
        own = [i for i, k in enumerate(self.kinds) if k in (NORMAL, USER, UNUSED)]
        self.byte_ids = {int(self.pieces[i][1:-1], 16): i for i, k in enumerate(self.kinds) if k == BYTE}
        # What a piece stands for by itself; other bytes and kinds need their neighbours or a rule.
        self.plain = [p if k in (NORMAL, USER, UNUSED) else None for p, k in zip(self.pieces, self.kinds, strict=True)]
        for byte, i in self.byte_ids.items():
            if byte < 128:
                self.plain[i] = chr(byte)
        self.unknown = next((i for i, k in enumerate(self.kinds) if k == UNKNOWN), 0)
        self.width = max((len(self.pieces[i]) for i in own), default=1)
        self.own = np.array(own, dtype=np.int64)
        # The signs of the pieces, a row for each, filled up with zeros.
        self.signs = np.array([self.pieces[i] for i in own], dtype=f"U{self.width}").view(np.uint32).reshape(-1, self.width)
        self.lengths = np.array([len(self.pieces[i]) for i in own], dtype=np.int64)
        self.ranks = np.unique(-np.array(self.scores), return_inverse=True)[1].astype(np.int64)
        self.worst = min((self.scores[i] for i in own), default=0.0) - 10.0
        apart = not any(re.search(f"[^{MARK}]{MARK}", self.pieces[i]) for i in own)
        self.segment = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+") if apart else re.compile(".+", re.DOTALL)

    @classmethod
    def read(cls, path: str) -> Model:
        with open(path, "rb") as file:
            return cls.parse(file.read())

    @classmethod
    def parse(cls, data: bytes) -> Model:
        pieces, scores, kinds = [], [], []
        trainer: dict[int, int | bytes] = {}
        rules: dict[int, int | bytes] = {}
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                pieces.append(piece.get(1, b"").decode())
                scores.append(float(np.frombuffer(piece.get(2, b"\0\0\0\0"), dtype="<f4")[0]))
                kinds.append(int(piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                rules = dict(_fields(value))
        algorithm = int(trainer.get(3, UNIGRAM))
        if algorithm not in (UNIGRAM, BPE) or rules.get(2) or rules.get(4, 1) or not rules.get(5, 1):
            raise ValueError("the model normalises texts, drops blanks or is neither unigram nor BPE")
        return cls(pieces, scores, kinds, algorithm, bool(trainer.get(35, 0)), bool(rules.get(3, 1)))

    # Encoding

    def segments(self, text: str) -> list[str]:
        if not text:
            return []
        return self.segment.findall((MARK if self.dummy_prefix else "") + text.replace(" ", MARK))

    def edges(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, piece) of every occurrence of a piece, sorted by start, then end.

        Signs are numbered as they occur in the text, so that several fit into one integer: a
        suffix is ordered by a few integers, of which most pieces need the first only.
        """
        width = self.width
        signs = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        met = np.zeros(0x110000, dtype=bool)
        met[signs] = True
        met = np.flatnonzero(met)
        bits = (len(met) + 1).bit_length()
        # Half as wide as the integers they are packed into: the tables of a batch add up.
        number = np.zeros(0x110000, dtype=np.uint32)
        number[met] = np.arange(1, len(met) + 1)
        each = 64 // bits
        parts = -(-width // each)

        def packed(rows: np.ndarray, part: int, fill: int) -> np.ndarray:
            """The numbers of ``each`` signs, the first one highest; ``rows`` has a column for each sign."""
            out = np.zeros(rows.shape[0], dtype=np.uint64)
            for k in range(part * each, (part + 1) * each):
                out = out << np.uint64(bits)
                out |= rows[:, k] if k < rows.shape[1] else np.uint64(fill)
            return out

        text_numbers = np.zeros(len(signs) + width, dtype=np.uint64)
        text_numbers[: len(signs)] = number[signs]
        windows = np.lib.stride_tricks.sliding_window_view(text_numbers, width)[: len(signs)]
        keys = [packed(windows, part, 0) for part in range(parts)]
        suffixes = np.lexsort(keys[::-1])
        keys = [key[suffixes] for key in keys]
        suffixes = suffixes.astype(np.int32)

        # Pieces with a sign that the text lacks do not occur; beyond a piece's end, any sign fits.
        inside = np.arange(width) < self.lengths[:, None]
        rows = np.where(inside, number[self.signs], np.uint32(0))
        occurs = np.flatnonzero(((rows > 0) | ~inside).all(axis=1))
        rows, inside = rows[occurs], inside[occurs]
        most = (1 << bits) - 1
        low = [packed(rows, part, 0) for part in range(parts)]
        high = [packed(np.where(inside, rows, np.uint32(most)), part, most) for part in range(parts)]
        first, last = np.searchsorted(keys[0], low[0], side="left"), np.searchsorted(keys[0], high[0], side="right")
        for part in range(1, parts):
            # Longer pieces: two bisections by the next integer among the suffixes found so far.
            longer = np.flatnonzero((self.lengths[occurs] > part * each) & (first < last))
            x, y = first[longer], last[longer]
            first[longer] = self._bisected(keys[part], x, y, low[part][longer], strictly=True)
            last[longer] = self._bisected(keys[part], x, y, high[part][longer], strictly=False)
        counts = last - first
        piece = np.repeat(occurs.astype(np.int32), counts)
        place = np.repeat(first - (np.cumsum(counts) - counts), counts)
        place += np.arange(len(place))
        start = suffixes[place]
        del place
        order = np.argsort(start.astype(np.int64) * (width + 1) + self.lengths[piece])
        start, piece = start[order], piece[order]
        return start, start + self.lengths[piece], self.own[piece]

    @staticmethod
    def _bisected(keys: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: np.ndarray, strictly: bool) -> np.ndarray:
        """The first place from low to high whose key is not below (or, not strictly, above) the wanted one."""
        low, high = low.copy(), high.copy()
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) >> 1
            before = keys[middle] < wanted[open_] if strictly else keys[middle] <= wanted[open_]
            low[open_] = np.where(before, middle + 1, low[open_])
            high[open_] = np.where(before, high[open_], middle)
        return low

    def encode_segments(self, segments: Sequence[str]) -> list[bytes]:
        """The ids of each segment, four bytes each; ``segments`` are indexed together."""
        start, end, piece = self.edges("\0".join(segments))
        bases = np.cumsum([0] + [len(s) + 1 for s in segments])
        if self.algorithm == BPE:
            return self._relax_together(segments, bases, start, end, piece)
        cuts = np.searchsorted(start, bases)
        return [
            as_bytes(self._relax_scores(s, self._inside(start, end, piece, int(bases[k]), cuts[k], cuts[k + 1])))
            for k, s in enumerate(segments)
        ]

    @staticmethod
    def _inside(start, end, piece, base: int, a: int, b: int) -> list[tuple[int, int, int]]:
        return list(zip((start[a:b] - base).tolist(), (end[a:b] - base).tolist(), piece[a:b].tolist(), strict=True))

    def _relax_together(self, segments, bases, start, end, piece) -> list[bytes]:
        """BPE for all segments at once: each round takes the best edge of every segment.

        Segments longer than ``LONG`` signs would need as many rounds; each has a queue.
        """
        out: list[bytes] = [b""] * len(segments)
        sizes = np.diff(bases) - 1
        cuts = np.searchsorted(start, bases)
        for k in np.flatnonzero(sizes > LONG):
            edges = self._inside(start, end, piece, int(bases[k]), cuts[k], cuts[k + 1])
            out[k] = as_bytes(self._relax_merges(segments[k], edges))
        # Edges of short segments by place and length; a long one has its own queue.
        span = self.width + 1
        rows = np.cumsum(np.repeat(sizes <= LONG, sizes + 1)) - 1
        table = np.full((int(rows[-1]) + 1 if len(rows) else 0) * span + span, -1, dtype=np.int32)
        near = np.repeat(sizes <= LONG, sizes + 1)[start] if len(start) else np.empty(0, dtype=bool)
        table[rows[start[near]] * span + (end - start)[near]] = piece[near]

        def lookup(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            """The piece from i to j, or -1."""
            length = j - i
            return np.where(length <= self.width, table[rows[i] * span + np.minimum(length, self.width)], -1)

        never = np.int64(1) << 62

        def priority(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            found = lookup(i, j)
            return np.where(found >= 0, self.ranks[found] << 32, never)

        short = np.flatnonzero((sizes > 0) & (sizes <= LONG))
        owner = np.repeat(short, sizes[short])
        first = np.repeat(bases[short] - np.concatenate(([0], np.cumsum(sizes[short])[:-1])), sizes[short])
        i = np.arange(len(owner)) + first
        j = i + 1
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        best = np.full(len(i), never)
        if len(i) > 1:
            best[:-1] = np.where(owner[:-1] == owner[1:], priority(i[:-1], j[1:]), never)
        while len(i):
            heads = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            # Equal scores: the leftmost, by the symbol's number in the lower half.
            top = np.minimum.reduceat(np.where(best < never, best | np.arange(len(best)), never), heads)
            open_ = top < never
            lengths = np.diff(np.append(heads, len(i)))
            if not open_.all():
                closed = np.repeat(~open_, lengths)
                done.append((owner[closed], i[closed], j[closed]))
            at = top[open_] & 0xFFFFFFFF
            j[at] = j[at + 1]
            keep = np.repeat(open_, lengths)
            keep[at + 1] = False
            moved = np.cumsum(keep) - 1
            owner, i, j, best = owner[keep], i[keep], j[keep], best[keep]
            at = moved[at]
            for around in (at, at[at > 0] - 1):
                near = around[around + 1 < len(i)]
                best[around] = never
                near = near[owner[near] == owner[near + 1]]
                best[near] = priority(i[near], j[near + 1])
        if done:
            owner, i, j = (np.concatenate(x) for x in zip(*done, strict=True))
            order = np.argsort(i, kind="stable")
            owner, i, j = owner[order], i[order], j[order]
            ids = lookup(i, j).astype(np.int32)
            raw, bounds = ids.tobytes(), np.searchsorted(owner, np.arange(len(segments) + 1)) * 4
            uncovered = set(owner[ids < 0].tolist())
            ends = bounds.tolist()
            for k in short.tolist():
                out[k] = raw[ends[k] : ends[k + 1]]
            for k in uncovered:
                whole: list[int] = []
                for at in range(ends[k] // 4, ends[k + 1] // 4):
                    base = int(bases[k])
                    whole += [int(ids[at])] if ids[at] >= 0 else self._signs(segments[k][i[at] - base : j[at] - base])
                out[k] = as_bytes(whole)
        return out

    def _signs(self, signs: str) -> list[int]:
        """The ids of signs that no piece covers."""
        if self.byte_fallback:
            return [self.byte_ids[b] for b in signs.encode("utf-8", "surrogatepass")]
        return [self.unknown]

    def _relax_scores(self, segment: str, edges: list[tuple[int, int, int]]) -> list[int]:
        best: list[float] = [0.0] + [-np.inf] * len(segment)
        back: list[tuple[int, int]] = [(0, -1)] * (len(segment) + 1)
        at = 0
        for i in range(len(segment)):
            single = False
            while at < len(edges) and edges[at][0] == i:
                _, j, piece = edges[at]
                single |= j == i + 1
                if best[i] + self.scores[piece] > best[j]:
                    best[j], back[j] = best[i] + self.scores[piece], (i, piece)
                at += 1
            if not single and best[i] + self.worst > best[i + 1]:
                best[i + 1], back[i + 1] = best[i] + self.worst, (i, -1)
        out: list[list[int]] = []
        j, open_ = len(segment), len(segment)
        while j > 0:
            i, piece = back[j]
            if piece >= 0:
                out.append([piece])
                open_ = i
            elif i == 0 or back[i][1] >= 0:  # a run of uncovered signs ends here
                out.append(self._signs(segment[i:open_]))
                open_ = i
            j = i
        return [x for ids in reversed(out) for x in ids]

    def _relax_merges(self, segment: str, edges: list[tuple[int, int, int]]) -> list[int]:
        n = len(segment)
        found = {(i, j): p for i, j, p in edges}
        right = list(range(1, n + 1))  # end of the symbol that starts here
        left = list(range(-1, n))  # start of the symbol before the one that starts here
        alive = [True] * n
        queue: list[tuple[float, int, int, int]] = []

        def offer(i: int) -> None:
            middle = right[i]
            if middle < n and (p := found.get((i, right[middle]))) is not None:
                heapq.heappush(queue, (-self.scores[p], i, middle, right[middle]))

        for i in range(n - 1):
            offer(i)
        while queue:
            _, i, middle, j = heapq.heappop(queue)
            if not alive[i] or right[i] != middle or not alive[middle] or right[middle] != j:
                continue
            alive[middle] = False
            right[i] = j
            if j < n:
                left[j] = i
            offer(i)
            if left[i] >= 0:
                offer(left[i])
        out: list[int] = []
        i = 0
        while i < n:
            piece = found.get((i, right[i]))
            out += [piece] if piece is not None else self._signs(segment[i : right[i]])
            i = right[i]
        return out

    def encode_flat(self, texts: Sequence[str | None], known: "Known | None" = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text's start; a null text has none."""
        known = Known() if known is None else known
        cut = [[] if t is None else self.segments(t) for t in texts]
        flat = list(chain.from_iterable(cut))
        found = known.of(flat, self)
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) >> 2
        ends = np.concatenate(([0], np.cumsum(sizes)))
        offsets = ends[np.concatenate(([0], np.cumsum([len(c) for c in cut]))).astype(np.int64)]
        return np.frombuffer(b"".join(found), dtype=np.int32), offsets

    def encode_new(self, fresh: list[str]) -> Iterator[bytes]:
        """The ids of distinct segments, as many at a time as an index holds."""
        at = 0
        while at < len(fresh):
            to, size = at, 0
            while to < len(fresh) and (to == at or size + len(fresh[to]) < INDEX_CHARS):
                size += len(fresh[to]) + 1
                to += 1
            yield from self.encode_segments(fresh[at:to])
            at = to

    def encode(self, texts: Sequence[str | None], known: "Known | None" = None) -> list[list[int] | None]:
        """The ids of each text; ``known`` keeps the segments of earlier batches."""
        ids, offsets = self.encode_flat(texts, known)
        ids = ids.tolist()
        return [None if t is None else ids[a:b] for t, a, b in zip(texts, offsets, offsets[1:], strict=False)]

    def decode(self, ids: Sequence[int]) -> str:
        plain = list(map(self.plain.__getitem__, ids))
        if None not in plain:
            text = "".join(plain).replace(MARK, " ")
            return text[1:] if self.dummy_prefix and text.startswith(" ") else text
        out: list[str] = []
        raw = bytearray()
        for i in ids:
            if self.kinds[i] == BYTE:
                raw.append(int(self.pieces[i][1:-1], 16))
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            out.append(self.pieces[i] if self.kinds[i] in (NORMAL, USER, UNUSED) else " ⁇ " if i == self.unknown else "")
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        text = "".join(out).replace(MARK, " ")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


def encoded(
    docs: DataFrame, model: Model, text: str = "text", ids: str = "ids", exact: str = "exact"
) -> DataFrame:
    """``docs`` without ``text``, with ``ids`` and ``exact``: whether decoding gives the text back."""
    rest = [c for c in docs.columns if c not in (text, ids, exact)]
    rows = docs.select(*[F.col(f"`{c}`") for c in rest], F.col(text).cast("string").alias("\0text"))
    schema = T.StructType(
        [*rows.schema.fields[:-1], T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(exact, T.BooleanType())]
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = shared.value, Known()
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                texts = part.column(part.num_columns - 1).to_pylist()
                found, offsets = model.encode_flat(texts, known)
                each, starts = found.tolist(), offsets.tolist()
                back = [
                    None if t is None else model.decode(each[x:y]) == t
                    for t, x, y in zip(texts, starts, starts[1:], strict=False)
                ]
                none = pa.array([t is None for t in texts], pa.bool_())
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(found, pa.int32()), mask=none)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], lists, pa.array(back, pa.bool_())], names=[*rest, ids, exact])

    return rows.mapInArrow(run, schema)


def decoded(rows: DataFrame, model: Model, ids: str = "ids", text: str = "text") -> DataFrame:
    """``rows`` with ``text`` read back from ``ids``; null ids give a null text."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.udf("string", useArrow=True)
    def read(value):
        return None if value is None else shared.value.decode(value)

    return rows.withColumn(text, read(F.col(ids)))
