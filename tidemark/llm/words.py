"""Words, lines and row handling that several operators share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space between words: the blank and the five control characters from tab to return.
BLANKS = " \t\n\x0b\x0c\r"


def text_of(column: str | Column) -> Column:
    """The text, empty where it is null."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def blanked(text: Column, keep: str = "") -> Column:
    """The text with every white space sign, but for those in ``keep``, made a blank."""
    for sign in BLANKS[1:]:
        if sign not in keep:
            text = F.replace(text, F.lit(sign), F.lit(" "))
    return text


def words_of(text: Column) -> Column:
    """The words of a text that is not null, as an array."""
    return F.array_remove(F.split(blanked(text), " "), "")


def carried(docs: DataFrame, carry: Sequence[str] | None) -> Column:
    """The columns handed through, as one struct that no working column can clash with."""
    names = docs.columns if carry is None else list(carry)
    return F.struct(*[docs[f"`{name}`"] for name in names]).alias("row")


def handed_back(df: DataFrame, names: Sequence[str], made: dict[str, Column]) -> DataFrame:
    """The carried columns and the made ones; a made column replaces a carried one of its name."""
    return df.select(
        *[F.col("row").getField(name).alias(name) for name in names if name not in made],
        *[column.alias(name) for name, column in made.items()],
    )
