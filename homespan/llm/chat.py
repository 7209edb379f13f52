"""Chat training windows under a token budget, with SQL functions only.

Template. A turn is ``<|im_start|>role`` + line feed + text + ``<|im_end|>`` + line feed. ``&`` and ``<`` inside
roles and texts become ``&amp;`` and ``&lt;`` (and a line feed in a role ``&#10;``), so no text can hold a mark
of the template, and the way back is exact.

Method. Prefix sums of turn tokens place every turn on a line. The line is cut into spans of ``S`` tokens; a turn
belongs to the span it starts in, so spans are aligned with turns. ``S`` is half of what the budget leaves beside
the system turn and the history, so a span with its last turn fits; a turn of more than ``S`` tokens is a window
of its own. A window is the system turn (where it lies before the window), the turns that lie whole in the
``history`` tokens before it, and the turns of its span. Only new assistant turns are under the loss mask:
repeated ones are masked.

Scale. Prefix sums are made in two steps, per 256 turn numbers and then within, so one long conversation is spread
over tasks; a span, with its history, is the largest thing a group holds. Reading back joins the windows
of a conversation, not its rows.

Cases. Null text and null role are empty. Turns are ordered by turn, role and text; repeated rows are turns of their
own; a null turn number comes first. Null conversation ids are one conversation. A single turn longer than
the budget makes a window over budget, never cut. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET = 1024
HISTORY = 192
TURN_MARKS = 4
LEAST_SPAN = 128
BUCKET = 256

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_ \t\n\x0B\f\r]"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def _escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("&#10;"))


def _unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def placed_turns(conversations: DataFrame) -> DataFrame:
    """Turns with their tokens and the tokens before them in the conversation (``begins``)."""
    turns = conversations.select(
        F.col("conv_id").alias("conv"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    turns = turns.withColumns(
        {
            "bucket": F.coalesce(F.floor(F.col("turn") / BUCKET), F.lit(-(2**40))),
            "tokens": F.regexp_count("text", F.lit(TOKEN)).cast("long") + TURN_MARKS,
        }
    )
    sums = turns.groupBy("conv", "bucket").agg(F.sum("tokens").alias("own"))
    before = Window.partitionBy("conv").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("conv").alias("c"), F.col("bucket").alias("b"), F.coalesce(F.sum("own").over(before), F.lit(0)).alias("offset")
    )
    inside = (
        Window.partitionBy("conv", "bucket")
        .orderBy(F.asc_nulls_first("turn"), "role", "text")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    joined = turns.join(offsets, F.col("conv").eqNullSafe(F.col("c")) & (F.col("bucket") == F.col("b")))
    begins = F.col("offset") + F.coalesce(F.sum("tokens").over(inside), F.lit(0))
    return joined.select("conv", "turn", "role", "text", "tokens", begins.alias("begins"))


def _with_system(turns: DataFrame, budget: int, history: int) -> DataFrame:
    """Add the conversation's first system turn, and the length of its spans."""
    first = F.min_by(F.struct("begins", "tokens", "role", "text"), "begins")
    system = turns.filter("role = 'system'").groupBy("conv").agg(first.alias("system"))
    system = system.withColumnRenamed("conv", "c")
    joined = turns.join(system, F.col("conv").eqNullSafe(F.col("c")), "left").drop("c")
    room = F.lit(budget - history) - F.coalesce(F.col("system.tokens"), F.lit(0))
    return joined.withColumn("span", F.greatest(F.floor(room / 2), F.lit(max(LEAST_SPAN, history))))


def chat_windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """``conv_id, window, tokens, formatted, repeated, new_turns, loss`` for every window.

    ``window`` is the place of its first new turn in tokens, ``repeated`` the number of leading turns that earlier
    windows have as new ones, ``loss`` the (start, length) of the texts to learn, in code points.
    """
    turns = _with_system(placed_turns(conversations), budget, history)
    home = F.floor(F.col("begins") / F.col("span"))
    reaches = F.col("begins") >= (home + 1) * F.col("span") - history
    copies = F.array_compact(F.array(F.struct(home.alias("block"), F.lit(True).alias("own")),
                                     F.when(reaches, F.struct((home + 1).alias("block"), F.lit(False).alias("own")))))
    spread = turns.withColumn("copy", F.explode(copies))
    turn = F.struct("begins", "tokens", "role", "text", F.col("copy.own").alias("own"))
    groups = spread.groupBy("conv", F.col("copy.block").alias("block")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns"),
        F.first("system").alias("system"),
        F.first("span").alias("span"),
    )
    long = lambda t: t["tokens"] > F.col("span")
    short_own = F.filter("turns", lambda t: t["own"] & ~long(t))
    long_own = F.filter("turns", lambda t: t["own"] & long(t))
    earlier = F.filter("turns", lambda t: ~t["own"])
    parts = F.array(
        F.struct(short_own.alias("new"), earlier.alias("past")),
        F.struct(long_own.alias("new"), F.concat(earlier, short_own).alias("past")),
    )
    windows = groups.select("conv", "system", F.explode(F.filter(parts, lambda p: F.size(p["new"]) > 0)).alias("part"))
    windows = windows.select("conv", "system", "part.new", "part.past", F.col("part.new")[0]["begins"].alias("window"))
    kept_system = F.col("system").isNotNull() & (F.col("system.begins") < F.col("window"))
    is_system = lambda t: F.coalesce(t["begins"] == F.col("system.begins"), F.lit(False))
    plain = lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"), t["tokens"].alias("tokens"))
    recent = F.filter("past", lambda t: (t["begins"] >= F.col("window") - history) & ~is_system(t))
    lead = F.when(kept_system, F.array(plain(F.col("system")))).otherwise(F.array().cast("array<struct<role:string,text:string,tokens:bigint>>"))
    led = F.concat(lead, F.transform(recent, plain))
    windows = windows.select("conv", "window", led.alias("led"), F.transform("new", plain).alias("new"))
    return _formatted(windows)


def _formatted(windows: DataFrame) -> DataFrame:
    both = F.concat("led", "new")
    head = lambda t: F.concat(F.lit(OPEN), _escaped_role(t["role"]), F.lit("\n"))
    pieces = F.transform(both, lambda t: F.struct(head(t).alias("head"), escaped(t["text"]).alias("body"),
                                                  (t["role"] == "assistant").alias("answer")))
    marked = windows.select(
        F.col("conv").alias("conv_id"),
        "window",
        F.aggregate(both, F.lit(0).cast("long"), lambda n, t: n + t["tokens"]).alias("tokens"),
        F.size("led").alias("repeated"),
        F.size("new").alias("new_turns"),
        pieces.alias("pieces"),
    )
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("seen"), F.array().cast("array<struct<start:int,length:int>>").alias("loss"))

    def step(so_far: Column, piece: Column) -> Column:
        begins = so_far["at"] + F.length(piece["head"])
        ends = begins + F.length(piece["body"])
        learnt = piece["answer"] & (so_far["seen"] >= F.col("repeated"))
        span = F.struct(begins.alias("start"), F.length(piece["body"]).alias("length"))
        return F.struct(
            (ends + len(CLOSE)).alias("at"),
            (so_far["seen"] + 1).alias("seen"),
            F.when(learnt, F.array_append(so_far["loss"], span)).otherwise(so_far["loss"]).alias("loss"),
        )

    text = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "")
    return marked.select(
        "conv_id", "window", "tokens", text.alias("formatted"), "repeated", "new_turns",
        F.aggregate("pieces", start, step, lambda s: s["loss"]).alias("loss"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """Turns and learnt texts per conversation, read from the formatted text and the loss mask alone."""
    cut = F.split("formatted", r"<\|im_end\|>\n")
    turns = F.slice(cut, F.col("repeated") + 1, F.size(cut) - 1 - F.col("repeated"))

    def said(part: Column) -> Column:
        body = F.substring(part, F.lit(len(OPEN) + 1), F.length(part))
        line = F.instr(body, "\n")
        role = F.substring(body, F.lit(1), line - 1)
        return F.concat(_unescaped_role(role), F.lit("\n"), unescaped(F.substring(body, line + 1, F.length(body))), F.lit("\n"))

    learnt = F.transform("loss", lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["length"])))
    parts = windows.select(
        "conv_id",
        "window",
        F.size(turns).cast("long").alias("n"),
        F.array_join(F.transform(turns, said), "").alias("turns"),
        F.array_join(learnt, "").alias("learnt"),
        F.length("formatted").cast("long").alias("chars"),
    )
    held = F.sort_array(F.collect_list(F.struct("window", "turns", "learnt")))
    whole = parts.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), held.alias("held"))
    all_turns = F.array_join(F.transform("held", lambda h: h["turns"]), "")
    all_learnt = F.array_join(F.transform("held", lambda h: h["learnt"]), "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(all_turns, 256).alias("turns_sha256"),
        F.length(all_learnt).cast("long").alias("loss_chars"),
        F.sha2(all_learnt, 256).alias("loss_sha256"),
        "formatted_chars",
    )
