"""Quality rules: counts over each text, and lines that many documents of a host share.

Only DataFrame functions run here. The counts need no shuffle: they are array
expressions over one row. For the line rule every text is reduced to digests of its
normalised lines; these, not the texts, are shuffled.

Rules for odd rows
    * A null text is an empty text: no words, so it fails the base rule.
    * A null host is a host of its own.
    * A document of a host is a distinct text: exact copies count once in the line
      frequency and get the same verdict, whatever their ids.
    * Empty tables give empty results; extra columns are handed through, and a column
      with the name of a made one is replaced.
Windows of eight words are compared by 64-bit hashes within one text, lines and texts
by MD5.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import blanked, carried, handed_back, text_of, words_of
from tidemark.session import stored

WINDOW = 8
SYMBOLS = r"[#*$%&|<>]"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Limits:
    """When a document is rejected and when a line counts as boilerplate.

    A line goes if at least ``line_docs`` distinct documents of its host hold it and these
    are more than ``line_percent`` percent of the host's documents. A document is depleted
    if fewer than ``min_words`` words stay, or more than ``depleted_percent`` percent go.
    """

    min_words: int = 20
    repeat_percent: int = 30
    line_docs: int = 10
    line_percent: int = 5
    depleted_percent: int = 50


def with_counts(rows: DataFrame) -> DataFrame:
    """Adds the base counts and ``lines`` to rows that have a ``text`` without nulls.

    ``lines`` has, for each line with a word, the digest of its normalised form (lower
    case, single blanks) and its number of words.
    """
    given = rows.columns
    rows = rows.withColumn(
        "by_line",
        F.transform(F.split(blanked(F.col("text"), "\n"), "\n"), lambda x: F.array_remove(F.split(x, " "), "")),
    )
    rows = rows.withColumn("words", F.flatten("by_line"))
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    # A window's hash is put together from those of its halves, down to the words: each
    # level pairs the array with itself moved on.
    rows = rows.withColumn("windows", F.transform("words", lambda w: F.xxhash64(w)))
    for step in (1, 2, 4):
        moved = F.slice("windows", step + 1, F.size("windows"))
        rows = rows.withColumn(
            "windows", F.when(F.col("n_words") >= WINDOW, F.zip_with("windows", moved, lambda a, b: F.xxhash64(a, b)))
        )
    rows = rows.withColumn("windows", F.slice("windows", F.lit(1), F.size("words") - (WINDOW - 1)))
    # Few texts hold a window twice; only theirs are sorted.
    rows = rows.withColumn(
        "sorted",
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    twin = lambda x, i: (F.get("sorted", i - 1)["h"] == x["h"]) | (F.get("sorted", i + 1)["h"] == x["h"])
    rows = rows.withColumn(
        "places",
        F.sort_array(F.transform(F.filter("sorted", lambda x, i: F.coalesce(twin(x, i), F.lit(False))), lambda x: x["i"])),
    )
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    covered = F.aggregate(
        "places",
        start,
        lambda acc, p: F.struct(
            (p + WINDOW).alias("end"), (acc["n"] + p + WINDOW - F.greatest(p, acc["end"])).alias("n")
        ),
        lambda acc: acc["n"],
    )
    with_word = lambda _, i: F.size(F.get("by_line", i)) > 0
    rows = rows.withColumn("raw", F.filter(F.split("text", "\n"), with_word))
    entry = lambda w: F.struct(line_digest(w).alias("line"), F.size(w).alias("n"))
    return rows.select(
        *given,
        "n_words",
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("raw") - F.size(F.array_distinct("raw"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.transform(F.filter("by_line", lambda w: F.size(w) > 0), entry).alias("lines"),
    )


def line_digest(words: Column) -> Column:
    return F.unhex(F.md5(F.lower(F.array_join(words, " "))))


def boilerplate(rows: DataFrame, limits: Limits) -> DataFrame:
    """Per distinct text of a host that holds frequent lines: their digests and their words.

    ``rows`` has ``host``, ``digest`` and ``lines``. Exact copies are merged before the
    lines are counted, and counts are summed in each task before the shuffle, so that
    neither a copied text nor a frequent line gathers rows in one task. The join with the
    frequent lines is left to adaptive execution: there are at most ``100 / line_percent``
    times the mean lines of a document for each host, and a hot key on the other side is
    split.
    """
    texts = rows.groupBy("host", "digest").agg(F.first("lines").alias("lines"))
    hosts = texts.groupBy("host").agg(F.count("*").alias("host_docs"))
    exploded = texts.select("host", "digest", F.explode("lines").alias("x")).select("host", "digest", "x.line", "x.n")
    held = exploded.groupBy("host", "digest", "line").agg(F.sum("n").alias("n"))
    counted = held.groupBy("host", "line").agg(F.count("*").alias("docs"))
    frequent = (
        counted.where(F.col("docs") >= limits.line_docs)
        .alias("c")
        .join(hosts.alias("h"), F.col("c.host").eqNullSafe(F.col("h.host")))
        .where(F.col("docs") * 100 > F.col("host_docs") * limits.line_percent)
        .select(F.col("c.host").alias("host"), "line")
    )
    return (
        held.alias("l")
        .join(frequent.alias("f"), F.col("l.host").eqNullSafe(F.col("f.host")) & (F.col("l.line") == F.col("f.line")))
        .groupBy("l.host", "l.digest")
        .agg(F.sum("l.n").alias("gone"), F.collect_set("l.line").alias("frequent"))
    )


def judged(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    carry: Sequence[str] | None = None,
    limits: Limits = Limits(),
    keep_text: bool = False,
) -> DataFrame:
    """Each document with its counts, ``removed_words``, ``base_failed`` and ``kept``.

    With ``keep_text`` also ``cleaned``, the text without its frequent lines.
    """
    names = docs.columns if carry is None else list(carry)
    rows = docs.select(carried(docs, carry), docs[host].alias("host"), text_of(docs[text]).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.md5("text")))
    # What both the counts and the line rule need of the texts is written, the texts are not:
    # where they are kept, ``docs`` is read again, and a text's counts go back onto its rows.
    counted = with_counts(rows).drop("text")
    counted = stored(counted.drop("row") if keep_text else counted, "quality")
    marks = boilerplate(counted, limits)
    if keep_text:
        counts = [F.first(c).alias(c) for c in COUNTS]
        marks = counted.groupBy("host", "digest").agg(*counts).alias("c").join(
            marks.alias("m"), F.col("c.host").eqNullSafe(F.col("m.host")) & (F.col("c.digest") == F.col("m.digest")), "left"
        ).select("c.host", "c.digest", *COUNTS, "gone", "frequent")
    else:
        rows = counted
    joined = rows.alias("r").join(
        marks.alias("m"), F.col("r.host").eqNullSafe(F.col("m.host")) & (F.col("r.digest") == F.col("m.digest")), "left"
    )
    gone = F.coalesce(F.col("gone"), F.lit(0))
    failed = (F.col("n_words") < limits.min_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * limits.repeat_percent
    )
    depleted = (F.col("n_words") - gone < limits.min_words) | (
        gone * 100 > F.col("n_words") * limits.depleted_percent
    )
    cleaned = {}
    if keep_text:
        stay = F.filter(F.split("text", "\n"), lambda x: ~F.array_contains("frequent", line_digest(words_of(x))))
        cleaned["cleaned"] = F.when(F.col("frequent").isNull(), F.col("text")).otherwise(F.array_join(stay, "\n"))
    return handed_back(
        joined,
        names,
        {
            **{c: F.col(c) for c in COUNTS},
            "removed_words": gone.cast("long"),
            "base_failed": failed,
            "kept": ~failed & ~((gone > 0) & depleted),
            **cleaned,
        },
    )


def filtered(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    n_chars: str = "n_chars",
    limits: Limits = Limits(),
) -> DataFrame:
    """The documents that pass, without their frequent lines, in the columns of ``docs``."""
    names = docs.columns
    # The text itself is carried once, as the operator's own column.
    rest = F.struct(*[docs[f"`{n}`"] for n in names if n != text]).alias("rest")
    passed = judged(docs.select(rest, text, host), text, host, ["rest"], limits, keep_text=True).where("kept")
    made = {text: F.col("cleaned")}
    if n_chars in names:
        made[n_chars] = F.length("cleaned").cast("long")
    return passed.select(*[made[n].alias(n) if n in made else F.col("rest").getField(n).alias(n) for n in names])
