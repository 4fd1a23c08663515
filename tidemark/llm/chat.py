"""Chat formatting in windows of whole turns, with a loss mask.

Only DataFrame functions run here. Prefix sums of the turns' tokens choose the windows:
one opens at a turn if the turns since the last opening would pass the budget that the
system turn and the repeated history leave. Each window shows the system turn again, then
as many whole turns of history as fit into their share, then its own turns. Loss is taken
on the assistant turns among its own; a repeated turn is masked. So every assistant text
is a target once. A turn longer than the budget has a window of its own and stays whole.

The template is ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts ``\\``
becomes ``\\s`` and ``<|`` becomes ``<\\p``, in roles a new line becomes ``\\n``: no text
can end or open a turn, and ``parsed`` gives back every code point.

Rules for odd rows
    * Null texts and roles are empty; a null conversation id is one conversation.
    * Turns with the same number, and null numbers, which come first, are in order of
      role and text; repeated rows are turns of their own.
    * The system turn is the first turn if its role is ``system``.
    * Empty tables give empty results; other columns take no part.
A conversation is an array in one row, as long as the conversation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

START, END = "<|im_start|>", "<|im_end|>\n"
# What the template adds to a turn, in tokens.
TURN_TOKENS = 4


@dataclass(frozen=True)
class Budget:
    """Tokens of a window, and the most of them that repeated history may take."""

    window: int = 512
    history: int = 128


def escaped(text: Column, role: bool = False) -> Column:
    text = F.replace(F.replace(text, F.lit("\\"), F.lit("\\s")), F.lit("<|"), F.lit("<\\p"))
    return F.replace(text, F.lit("\n"), F.lit("\\n")) if role else text


def unescaped(text: Column, role: bool = False) -> Column:
    text = F.replace(text, F.lit("\\p"), F.lit("|"))
    text = F.replace(text, F.lit("\\n"), F.lit("\n")) if role else text
    return F.replace(text, F.lit("\\s"), F.lit("\\"))


def tokens(text: Column) -> Column:
    """Runs of letters and digits, and single other signs, counted without the template."""
    return F.size(F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"), F.lit(0)))


def _opened(turns: Column, budget: Budget) -> Column:
    """Indexes at which windows open, from the prefix sums ``before`` of the turns."""
    room = F.greatest(F.lit(1), F.lit(budget.window - budget.history) - F.col("system_tokens"))
    start = F.struct(
        F.array().cast("array<int>").alias("at"), F.lit(-1).cast("long").alias("from"), F.lit(0).alias("i")
    )

    def step(acc: Column, x: Column) -> Column:
        own = acc["i"] >= F.col("n_system")
        full = own & ((acc["from"] < 0) | (x["before"] + x["tokens"] - acc["from"] > room))
        return F.struct(
            F.when(full, F.concat(acc["at"], F.array(acc["i"]))).otherwise(acc["at"]).alias("at"),
            F.when(full, x["before"]).otherwise(acc["from"]).alias("from"),
            (acc["i"] + 1).alias("i"),
        )

    return F.aggregate(turns, start, step, lambda acc: acc["at"])


def windows(
    rows: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    budget: Budget = Budget(),
) -> DataFrame:
    """One row per window.

    ``conv_id``, ``window`` from 0, ``n_repeated`` leading turns seen in earlier windows,
    ``formatted``, and ``loss`` as an array of (start, end) in code points of ``formatted``.
    A conversation of a system turn alone has one window.
    """
    text_, role_ = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    turns = rows.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), role_.alias("role"), text_.alias("text"))
    turns = turns.withColumn("tokens", tokens(F.col("text")).cast("long") + TURN_TOKENS)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1))
    turns = turns.withColumn("i", F.row_number().over(order) - 1).withColumn("before", F.coalesce(before, F.lit(0)))
    name = escaped(F.col("role"), True)
    piece = F.concat(F.lit(START), name, F.lit("\n"), escaped(F.col("text")), F.lit(END))
    rows = turns.select(
        "conv_id",
        F.struct(
            "i", "tokens", "before", "role", piece.alias("piece"), (F.length(name) + len(START) + 1).alias("head")
        ).alias("t"),
    )
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    first = F.col("turns")[0]
    convs = convs.withColumn("n_system", F.when(first["role"] == "system", 1).otherwise(0)).withColumn(
        "system_tokens", F.when(F.col("n_system") == 1, first["tokens"]).otherwise(0)
    )
    convs = convs.withColumn("at", _opened(F.col("turns"), budget))
    convs = convs.withColumn("at", F.when(F.size("at") == 0, F.array(F.lit(0))).otherwise(F.col("at")))
    cut = convs.select("conv_id", "turns", "n_system", "at", F.posexplode("at").alias("window", "open"))
    cut = cut.withColumn("close", F.coalesce(F.get("at", F.col("window") + 1), F.size("turns")))
    # History: the whole turns right before the window that fit into its share.
    base = F.get("turns", F.col("open"))["before"]
    earlier = F.filter("turns", lambda t: (t["i"] >= F.col("n_system")) & (t["i"] < F.col("open")) & (base - t["before"] <= budget.history))
    cut = cut.withColumn("earlier", earlier)
    cut = cut.withColumn(
        "shown",
        F.concat(
            F.when(F.col("window") > 0, F.slice("turns", 1, F.col("n_system"))).otherwise(F.slice("turns", 1, 0)),
            F.col("earlier"),
            F.slice("turns", F.when(F.col("window") == 0, F.lit(1)).otherwise(F.col("open") + 1), F.col("close") - F.when(F.col("window") == 0, F.lit(0)).otherwise(F.col("open"))),
        ),
    ).withColumn("n_repeated", F.when(F.col("window") == 0, F.lit(0)).otherwise(F.col("n_system") + F.size("earlier")))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit(0).alias("i"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("loss"))

    def step(acc: Column, t: Column) -> Column:
        target = (acc["i"] >= F.col("n_repeated")) & (t["role"] == "assistant")
        span = F.struct(
            (acc["at"] + t["head"]).alias("start"), (acc["at"] + F.length(t["piece"]) - len(END)).alias("end")
        )
        return F.struct(
            (acc["at"] + F.length(t["piece"])).alias("at"),
            (acc["i"] + 1).alias("i"),
            F.when(target, F.concat(acc["loss"], F.array(span))).otherwise(acc["loss"]).alias("loss"),
        )

    return cut.select(
        "conv_id",
        "window",
        "n_repeated",
        F.array_join(F.transform("shown", lambda t: t["piece"]), "").alias("formatted"),
        F.aggregate("shown", start, step, lambda acc: acc["loss"]).alias("loss"),
    )


def parsed(formatted: Column) -> Column:
    """The turns of a formatted window, as an array of (role, text)."""
    pieces = F.split(formatted, r"<\|im_end\|>\n")
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        inner = F.substring(piece, F.lit(len(START) + 1), F.length(piece))
        at = F.locate("\n", inner)
        return F.struct(
            unescaped(F.substring(inner, F.lit(1), at - 1), True).alias("role"),
            unescaped(F.substring(inner, at + 1, F.length(inner))).alias("text"),
        )

    return F.transform(pieces, turn)


def read_back(windowed: DataFrame) -> DataFrame:
    """Per conversation what the windows hold: digests of its turns and of its targets."""
    own = windowed.withColumn("turns", parsed(F.col("formatted"))).withColumn(
        "turns", F.slice("turns", F.col("n_repeated") + 1, F.size("turns"))
    )
    own = own.select(
        "conv_id",
        "window",
        F.size("turns").alias("n"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"),
        F.array_join(
            F.transform("loss", lambda s: unescaped(F.substring("formatted", (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), ""
        ).alias("target"),
        F.length("formatted").alias("chars"),
    )
    convs = own.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("window", "said", "target"))).alias("w"),
        F.sum("chars").cast("long").alias("formatted_chars"),
    )
    joined = lambda field: F.array_join(F.transform("w", lambda x: x[field]), "")
    return convs.select(
        "conv_id",
        F.col("n_turns").cast("long").alias("n_turns"),
        F.sha2(joined("said"), 256).alias("turns_sha256"),
        F.length(joined("target")).cast("long").alias("loss_chars"),
        F.sha2(joined("target"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
