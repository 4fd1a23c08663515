"""Substring de-duplication by hashed sentences, lines or paragraphs.

Each text is cut into units: lines (or paragraphs) at a separator, and those after each
sentence mark that white space follows, which stays with its sentence. A unit's normalised
form (lower case, single blanks) is digested; equal digests are grouped over all documents,
the earliest ranked occurrence stays and every other one is cut out. Rank is the document's
id, then the place in the text. The cuts are kept as offsets in code points of the original
text; a line all of whose units go takes one separator with it.

Only digests and places are shuffled for the grouping, one row for each unit; they are worked
out once and written. The earliest place of a digest is a minimum, summed up in each task
before the shuffle; the join that marks the later ones is left to adaptive execution, which
splits hot digests.

Rules for odd rows
    * A null text comes back null, an empty one empty; neither has units.
    * Null ids rank after all others.
    * Rows with the same id and text are one document given twice: both keep the same.
      Rows with the same id and different texts are ranked by the text's digest.
    * Units whose normalised form has fewer than ``min_chars`` code points are never cut,
      however often they repeat; with 1 every unit that has a word counts. Text without
      blanks counts by its signs, as any other.
    * Empty tables give empty results; extra columns are handed through, and a column
      with the name of a made one is replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import carried, handed_back, text_of
from tidemark.session import stored

BLANK = re.compile(r"[ \t-\r]+")
# White space after a sentence mark, but for new lines.
AFTER_SENTENCE = re.compile(r"(?<=[.!?。])[ \t\x0b-\r]+")
# About as long as eight words: shorter sentences recur without being copied.
MIN_CHARS = 50
# Texts whose units a task holds at a time, as Python's objects.
TEXTS = 1_000


def lines(text: str, separator: str) -> list[tuple[int, int]]:
    """The (start, end) of each line; the separators belong to none."""
    out, start = [], 0
    while (end := text.find(separator, start)) >= 0:
        out.append((start, end))
        start = end + len(separator)
    out.append((start, len(text)))
    return out


def units(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """The (start, end) of each sentence of a line, which they make up without a gap."""
    cuts = [m.end() for m in AFTER_SENTENCE.finditer(text, start, end) if m.start() > start]
    return [(x, y) for x, y in zip([start, *cuts], [*cuts, end], strict=True) if x < y]


def digest(unit: str, min_chars: int) -> bytes | None:
    """MD5 of the normalised unit; None if it is too short."""
    form = BLANK.sub(" ", unit).strip(" ").lower()
    if len(form) < max(min_chars, 1):
        return None
    return hashlib.md5(form.encode("utf-8", "surrogatepass")).digest()


def without(text: str, spans: Sequence[tuple[int, int]], separator: str) -> str:
    """The text without the spans; a line that loses all its units goes with one separator."""
    gone = set(map(tuple, spans))
    kept = []
    for start, end in lines(text, separator):
        parts = units(text, start, end)
        left = [text[x:y] for x, y in parts if (x, y) not in gone]
        if left or not parts:
            kept.append("".join(left))
    return separator.join(kept)


def located(docs: DataFrame, doc_id: str, text: str, separator: str, min_chars: int) -> DataFrame:
    """A row for each unit that counts: hash, doc, key, start, end."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), TEXTS):
                part = batch.iloc[at : at + TEXTS]
                out: dict[str, list] = {"hash": [], "doc": [], "key": [], "start": [], "end": []}
                for doc, key, body in zip(part["doc"].array, part["key"], part["body"], strict=True):
                    for line in lines(body, separator):
                        for a, b in units(body, *line):
                            if (d := digest(body[a:b], min_chars)) is not None:
                                for name, value in zip(out, (d, doc, key, a, b), strict=True):
                                    out[name].append(value)
                frame = pd.DataFrame(out)
                frame["doc"] = pd.array(frame["doc"], dtype="Int64")
                yield frame

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc"), F.xxhash64(text_of(docs[text])).alias("key"), text_of(docs[text]).alias("body")
    )
    rows = rows.select(F.coalesce("doc", F.lit(NULL_ID)).alias("doc"), "key", "body").where("body <> ''")
    return rows.mapInPandas(cut, "hash binary, doc long, key long, start int, end int")


# Ranks null ids last.
NULL_ID = 2**63 - 1


def deduplicated(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    separator: str = "\n",
    min_chars: int = MIN_CHARS,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """The documents with ``text`` cut, and ``removed``: the (start, end) of each cut in the original.

    ``n_chars``-like columns are left as they are; see ``documents`` for the pipeline's form.
    """
    names = docs.columns if carry is None else list(carry)
    found = stored(located(docs, doc_id, text, separator, min_chars), "units")
    place = F.struct("doc", "key", "start")
    first = found.groupBy("hash").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last")
    later = (
        found.join(first, "hash")
        .where(place != F.col("first"))
        .groupBy("doc", "key")
        .agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("removed"))
    )
    # The text goes through the join once, as the operator's own column.
    rows = docs.select(
        carried(docs, [n for n in names if n != text] or [doc_id]),
        docs[text].alias("body"),
        F.coalesce(docs[doc_id].cast("long"), F.lit(NULL_ID)).alias("doc"),
        F.xxhash64(text_of(docs[text])).alias("key"),
    )
    joined = rows.join(later, ["doc", "key"], "left")

    @F.pandas_udf("string")
    def kept(body: pd.Series, removed: pd.Series) -> pd.Series:
        return pd.Series(
            [
                None if b is None else without(b, [(s["start"], s["end"]) for s in r], separator)
                for b, r in zip(body, removed, strict=True)
            ],
            dtype=object,
        )

    # As a plain function it would be worked out again in a filter on its result: a second
    # pass, with a Python worker of its own beside that of the first.
    kept = kept.asNondeterministic()
    none = F.array().cast("array<struct<start:int,end:int>>")
    # Only the texts that lose something are sent to Python; the others go as null, in the same
    # pass, so that units and texts are shuffled once.
    changed = F.when(F.col("removed").isNotNull(), F.col("body"))
    both = joined.withColumn("cut", F.coalesce(kept(changed, "removed"), F.col("body")))
    return handed_back(both, names, {text: F.col("cut"), "removed": F.coalesce("removed", none)})


def documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars", min_chars: int = MIN_CHARS
) -> DataFrame:
    """The documents that keep a word, in their own columns."""
    out = deduplicated(docs, doc_id, text, min_chars=min_chars)
    if n_chars in docs.columns:
        out = out.withColumn(n_chars, F.length(text).cast("long"))
    return out.where(F.regexp_like(text_of(text), F.lit(r"[^ \t-\r]"))).select(*docs.columns)
