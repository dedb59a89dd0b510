"""Chat formatting into windows of a token budget, in DataFrame functions alone.

The turns of a conversation are numbered and their tokens summed up over range partitions, so that one conversation may
hold any share of the rows. Blocks of BLOCK turns choose their windows from the prefix sums: a window takes whole turns
until the next one would not fit. A window repeats the system turn and up to HISTORY_TURNS of the turns before it, if
these fit the history budget, and carries a loss mask: (start, length) in code points of every assistant text that is
new in it. Repeated turns are never under the mask, so each assistant text is a target once.

The template writes a turn as ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts a backslash is doubled and
each control string gets a backslash after its first character; a line break in a role is written ``\\n``. The way back
is exact.

Tokens are counted as runs of up to four letters, of up to three digits, and other visible characters, plus four for
the marks of a turn.

Defined results: a null text or role is empty. Turns are ordered by turn number (nulls first), then role, then text, so
ties and repeated rows have one order; every row is a turn. A null ``conv_id`` is a conversation of its own. A system
turn is retained only if it is the first turn. A window exceeds the budget only if a single turn with what is repeated
does, and says so in ``over_budget``. An empty table gives no windows. Other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.order import running_total
from ..session import staged

BUDGET, HISTORY_TOKENS, HISTORY_TURNS, BLOCK = 1024, 192, 2, 256
_TURN_TOKENS = 4
_START, _END = "<|im_start|>", "<|im_end|>\n"
#: Strings that templates and tokenizers treat as control, as what follows their first character.
_CONTROL = r"([<\[])(?=\|im_(?:start|end)\|>|\|endoftext\|>|/?s>|</?SYS>>|/?INST\])"


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _CONTROL, r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def _role(text: Column) -> Column:
    pieces = F.split(text, r"\\\\")
    return F.array_join(
        F.transform(pieces, lambda p: unescaped(F.replace(p, F.lit("\\n"), F.lit("\n")))), "\\")


def turn_tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[\p{L}\p{M}]{1,4}|\p{N}{1,3}|[^\x09-\x0D\x20\p{L}\p{M}\p{N}]")) + _TURN_TOKENS


def _spans(turns: DataFrame, budget: int, history_tokens: int) -> DataFrame:
    """``conv_id, first, last, before``: turns of each window and the tokens before it."""
    heads = turns.filter((F.col("seq") == 1) & (F.col("role") == "system")).select(
        F.col("conv_id").alias("_conv"), F.col("tokens").alias("system_tokens"))
    blocks = turns.groupBy("conv_id", ((F.col("seq") - 1) / BLOCK).cast("long").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("seq", "prefix", "tokens"))).alias("t"))  # BLOCK entries at most
    blocks = blocks.join(heads, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").withColumn(
        "room", F.greatest(F.lit(budget - history_tokens) - F.coalesce("system_tokens", F.lit(0)),
                           F.lit(budget // 4)))
    span = F.struct(F.col("t")[0]["seq"].alias("first"), (F.col("t")[0]["prefix"] - F.col("t")[0]["tokens"])
                    .alias("before"))
    cuts = F.aggregate("t", F.array(span), lambda a, x: F.when(
        (x["prefix"] - F.element_at(a, -1)["before"] > F.col("room")) & (x["seq"] > F.element_at(a, -1)["first"]),
        F.concat(a, F.array(F.struct(x["seq"].alias("first"), (x["prefix"] - x["tokens"]).alias("before"))))
    ).otherwise(a))
    cut = blocks.select("conv_id", cuts.alias("cuts"), F.element_at("t", -1)["seq"].alias("end"))
    return cut.select("conv_id", F.inline_outer(F.transform("cuts", lambda c, i: F.struct(
        c["first"].alias("first"), F.coalesce(F.get("cuts", i + 1)["first"] - 1, F.col("end")).alias("last"),
        c["before"].alias("before")))))


def chat_windows(conversations: DataFrame, budget: int = BUDGET, history_tokens: int = HISTORY_TOKENS,
                 history_turns: int = HISTORY_TURNS, id_column: str = "conv_id", turn_column: str = "turn",
                 role_column: str = "role", text_column: str = "text") -> DataFrame:
    """Windows: ``conv_id, first_turn`` (number of its first new turn), ``n_repeated`` (turns repeated at its head),
    ``n_new, tokens, over_budget, text, loss`` (array of start and length)."""
    rows = conversations.select(
        F.col(id_column).alias("conv_id"), F.col(turn_column).alias("turn"),
        F.coalesce(F.col(role_column), F.lit("")).alias("role"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    rows = rows.withColumn("tokens", turn_tokens(F.col("text")).cast("long")).withColumn("one", F.lit(1).cast("long"))
    turns = staged(running_total(rows, ["turn", "role", "text"], {"seq": "one", "prefix": "tokens"}, ["conv_id"]),
                   "turns")
    spans = _spans(turns, budget, history_tokens)
    members = spans.select(
        F.col("conv_id").alias("_conv"), "first", "before", F.explode(F.array_union(
            F.array(F.lit(1).cast("long")),
            F.sequence(F.greatest(F.lit(1).cast("long"), F.col("first") - history_turns), "last"))).alias("_seq"))
    joined = members.join(turns, F.col("_conv").eqNullSafe(F.col("conv_id")) & (F.col("_seq") == F.col("seq")))
    new = F.col("seq") >= F.col("first")
    system = (F.col("seq") == 1) & (F.col("role") == "system")
    history = ((F.col("seq") >= F.col("first") - history_turns)
               & (F.col("before") - F.col("prefix") + F.col("tokens") <= history_tokens))
    opened = F.concat(F.lit(_START), _escaped_role(F.col("role")), F.lit("\n"))
    part = F.struct("seq", (~new).alias("repeated"), F.when(new & (F.col("role") == "assistant"), True)
                    .otherwise(False).alias("target"), "tokens", opened.alias("head"),
                    escaped(F.col("text")).alias("body"))
    grouped = joined.filter(new | system | history).groupBy("conv_id", F.col("first").alias("first_turn")).agg(
        F.sort_array(F.collect_list(part)).alias("parts"))  # a window: bounded by the budget or a single turn
    masked = F.aggregate(
        "parts", F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("loss")),
        lambda a, p: F.struct(
            (a["at"] + F.length(p["head"]) + F.length(p["body"]) + len(_END)).alias("at"),
            F.when(p["target"], F.concat(a["loss"], F.array(F.struct(
                (a["at"] + F.length(p["head"])).alias("start"), F.length(p["body"]).alias("length")))))
            .otherwise(a["loss"]).alias("loss")),
        lambda a: a["loss"])
    text = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(_END))), "")
    repeated = F.size(F.filter("parts", lambda p: p["repeated"]))
    tokens = F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + p["tokens"])
    return grouped.select(
        "conv_id", "first_turn", repeated.alias("n_repeated"), (F.size("parts") - repeated).alias("n_new"),
        tokens.alias("tokens"), (tokens > budget).alias("over_budget"), text.alias("text"), masked.alias("loss"))


def parsed_turns(text: Column) -> Column:
    """The turns of a formatted text: array of role and text."""
    def turn(piece):
        body = F.substring(piece, F.lit(1), F.length(piece) - len(_END))
        head = F.substring_index(body, "\n", 1)
        return F.struct(_role(head).alias("role"),
                        unescaped(F.substring(body, F.length(head) + 2, F.length(body))).alias("text"))

    pieces = F.split(text, r"<\|im_start\|>")
    return F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), turn)


def masked_text(text: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, in order and with nothing between."""
    return F.array_join(F.transform(
        loss, lambda s: unescaped(F.substring(text, s["start"] + 1, s["length"]))), "")


def conversation_digests(windows: DataFrame) -> DataFrame:
    """What the windows of a conversation hold, read back from their texts, as one row of digests.

    A digest over a conversation needs its new turns in order; that is the one place where they meet in a row.
    """
    turns = parsed_turns(F.col("text"))
    new = F.slice(F.col("turns"), F.col("n_repeated") + 1, F.size("turns"))
    read = windows.withColumn("turns", turns).select(
        "conv_id", "first_turn", F.size(new).cast("long").alias("n"),
        F.array_join(F.transform(new, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
        .alias("said"),
        masked_text(F.col("text"), F.col("loss")).alias("target"), F.length("text").cast("long").alias("chars"))
    ordered = read.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
        F.sort_array(F.collect_list(F.struct("first_turn", "said", "target"))).alias("w"))
    said = F.array_join(F.transform("w", lambda x: x["said"]), "")
    target = F.array_join(F.transform("w", lambda x: x["target"]), "")
    return ordered.select(
        "conv_id", "n_turns", F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length(target).cast("long").alias("loss_chars"), F.sha2(target.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars")
