"""Operator 2: conversations as budgeted training windows. DataFrame functions only.

A window is a string of turns and the spans of it that count for the loss:

    <s>role[INST]text[/INST]</s><s>role[INST]text[/INST]</s>...

A control string inside a role or a text gets a backslash behind its first character, and a backslash is doubled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEGIN, OPEN, CLOSE, END = "<s>", "[INST]", "[/INST]", "</s>"
#: Tokens that the marks of a turn count for.
MARKS = 4
#: Turn numbers that are worked on together; a longer conversation is spread over tasks.
CHUNK = 256

_CONTROL = r"(<(?=/?s>|</?SYS>>)|\[(?=/?INST\]))"


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _CONTROL, r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def token_count(text: Column) -> Column:
    """Runs of letters and digits, and other visible characters, as a stand-in for a tokenizer's count."""
    return F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"))


def format_chats(
    df: DataFrame, budget: int = 2048, history: int = 4, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", chunk: int = CHUNK
) -> DataFrame:
    """Windows of conversations: conv_id, chunk, window, formatted, n_repeated, loss_spans (start, length), n_tokens, n_chunks.

    Every turn is new in exactly one window. Prefix sums of turn tokens are cut into strides of three quarters of what the
    system turn leaves of ``budget``; the turns inside a stride share a window, and a turn that crosses the end of a stride
    has its own. A window starts with the system turn (the first turn of role system, unless it is new there) and up to
    ``history`` turns before it as far as they fit; ``n_repeated`` counts these. Loss spans cover the texts of new
    assistant turns. Only a single turn, or a system turn, that is larger than the budget makes a window exceed it.

    Turns are dealt by conversation and ``chunk`` turn numbers, so a long conversation is no single group: windows end
    with their chunk, and the last ``history`` turn numbers go to the next chunk as history too. Null texts and roles are
    empty, a null turn counts as -1, null conversations are one conversation. Turns of one number are ordered by role
    and text; repeated rows are repeated turns. No rows give no windows. Other columns are not read.
    """
    at = F.coalesce(df[turn].cast("long"), F.lit(-1))
    said = df.select(
        df[conv].alias("conv_id"),
        F.floor(at / chunk).alias("chunk"),
        at.alias("turn"),
        F.coalesce(df[role].cast("string"), F.lit("")).alias("role"),
        F.coalesce(df[text].cast("string"), F.lit("")).alias("text"),
    )
    turns = said.select(
        "conv_id",
        "chunk",
        "turn",
        escaped(F.col("role")).alias("role"),
        escaped(F.col("text")).alias("text"),
        (token_count(F.col("role")) + token_count(F.col("text")) + MARKS).cast("long").alias("tokens"),
    )
    last = F.pmod(F.col("turn"), F.lit(chunk)) >= chunk - history
    dealt = turns.withColumn(
        "to",
        F.explode(
            F.when(last, F.array(F.struct("chunk", F.lit(2).alias("kind")), F.struct((F.col("chunk") + 1).alias("chunk"), F.lit(1).alias("kind")))).otherwise(
                F.array(F.struct("chunk", F.lit(2).alias("kind")))
            )
        ),
    ).select("conv_id", F.col("to.chunk").alias("chunk"), F.col("to.kind").alias("kind"), "turn", "role", "text", "tokens", F.lit(0).cast("long").alias("n_chunks"))
    # one row per chunk of a conversation: how many there are, and the system turn
    system = F.min(F.when(F.col("role") == "system", F.struct("turn", "role", "text", "tokens")))
    whole = Window.partitionBy("conv_id")
    heads = (
        turns.groupBy("conv_id", "chunk")
        .agg(system.alias("system"))
        .select("conv_id", "chunk", F.lit(0).alias("kind"), F.min("system").over(whole).alias("system"), F.count(F.lit(1)).over(whole).alias("n_chunks"))
        .select("conv_id", "chunk", "kind", "system.turn", "system.role", "system.text", "system.tokens", "n_chunks")
    )
    groups = (
        dealt.unionByName(heads)
        .groupBy("conv_id", "chunk")
        .agg(F.sort_array(F.collect_list(F.struct("kind", "turn", "role", "text", "tokens", "n_chunks"))).alias("rows"))
        .withColumn("head", F.try_element_at("rows", F.lit(1)))
        # a chunk that got history only has no head
        .filter("head.kind = 0")
    )
    parts = groups.select(
        "conv_id",
        "chunk",
        F.col("head.n_chunks").alias("n_chunks"),
        F.col("head").alias("system"),
        F.filter("rows", lambda x: x["kind"] == 1).alias("past"),
        F.filter("rows", lambda x: x["kind"] == 2).alias("own"),
        F.floor((F.lit(budget) - F.coalesce("head.tokens", F.lit(0))) * 3 / 4).alias("room"),
    ).withColumn("room", F.greatest("room", F.lit(1)))
    sums = F.aggregate("own", F.array(F.lit(0).cast("long")), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x["tokens"])))

    def window_of(i: Column) -> Column:
        stride = F.floor(F.get("ends", i) / F.col("room"))
        return stride * 2 + (F.get("ends", i + 1) > (stride + 1) * F.col("room")).cast("long")

    numbered = (
        parts.withColumn("ends", sums)
        .withColumn("number", F.transform("own", lambda _, i: window_of(i)))
        .select("*", F.explode(F.array_distinct("number")).alias("window"))
        .withColumn("first", F.array_position("number", F.col("window")).cast("int"))
        .withColumn("new", F.slice("own", F.col("first"), F.size(F.filter("number", lambda n: n == F.col("window")))))
        .withColumn("before", F.concat("past", F.slice("own", F.lit(1), F.col("first") - 1)))
    )

    def is_system(x: Column) -> Column:
        return F.coalesce((x["role"] == "system") & (x["turn"] == F.col("system.turn")) & (x["text"] == F.col("system.text")), F.lit(False))

    def total(turns: str) -> Column:
        return F.aggregate(turns, F.lit(0).cast("long"), lambda acc, x: acc + x["tokens"])

    lead = F.when(F.col("system.role").isNull() | F.exists("new", is_system), F.slice(F.array("system"), 1, 0)).otherwise(F.array("system"))
    chosen = (
        numbered.withColumn("lead", lead)
        .withColumn("before", F.filter(_tail("before", history), lambda x: ~is_system(x)))
        .withColumn("left", F.lit(budget) - total("lead") - total("new"))
        .withColumn("repeated", F.concat("lead", F.filter("before", lambda x, i: _rest("before", i) <= F.col("left"))))
        .withColumn("turns", F.concat("repeated", "new"))
    )

    def piece(x: Column) -> Column:
        return F.concat(F.lit(BEGIN), x["role"], F.lit(OPEN), x["text"], F.lit(CLOSE + END))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.expr("CAST(array() AS array<struct<start:bigint,length:bigint>>)").alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + len(BEGIN + OPEN) + F.length(x["role"])
        here = F.struct(begin.cast("long").alias("start"), F.length(x["text"]).cast("long").alias("length"))
        return F.struct(
            (begin + F.length(x["text"]) + len(CLOSE + END)).cast("long").alias("at"),
            F.when(x["role"] == "assistant", F.concat(acc["spans"], F.array(here))).otherwise(acc["spans"]).alias("spans"),
        )

    return (
        chosen.withColumn("formatted", F.array_join(F.transform("turns", piece), ""))
        .withColumn("shift", F.aggregate("repeated", F.lit(0).cast("long"), lambda acc, x: acc + F.length(piece(x))))
        .withColumn("spans", F.aggregate("new", start, step)["spans"])
        .select(
            "conv_id",
            "chunk",
            "window",
            "formatted",
            F.size("repeated").alias("n_repeated"),
            F.transform("spans", lambda s: F.struct((s["start"] + F.col("shift")).alias("start"), s["length"].alias("length"))).alias("loss_spans"),
            total("turns").alias("n_tokens"),
            "n_chunks",
        )
    )


def _tail(array: str, most: int) -> Column:
    return F.slice(array, F.greatest(F.size(array) - most + 1, F.lit(1)), F.lit(most))


def _rest(array: str, i: Column) -> Column:
    """Tokens of the turns from place i on."""
    return F.aggregate(F.slice(array, i + 1, F.size(array) - i), F.lit(0).cast("long"), lambda acc, x: acc + x["tokens"])


def new_turns(windows: DataFrame) -> Column:
    """The turns that are new in a window, parsed from its string: role and text, unescaped."""
    marked = F.split("formatted", END, -1)
    new = F.slice(marked, F.col("n_repeated") + 1, F.size(marked) - 1 - F.col("n_repeated"))

    def parse(p: Column) -> Column:
        halves = F.split(F.substr(p, F.lit(len(BEGIN) + 1)), r"\[INST\]", 2)
        text = F.element_at(halves, 2)
        return F.struct(
            unescaped(F.element_at(halves, 1)).alias("role"), unescaped(F.substr(text, F.lit(1), F.length(text) - len(CLOSE))).alias("text")
        )

    return F.transform(new, parse)


def loss_text(windows: DataFrame) -> Column:
    """All text under the loss mask of a window, unescaped."""
    return F.array_join(F.transform("loss_spans", lambda s: unescaped(F.substr("formatted", s["start"] + 1, s["length"]))), "")


def read_back(windows: DataFrame) -> DataFrame:
    """Per conversation, from its windows alone: turns and loss text as counts and digests, and characters of all windows.

    A digest over a conversation needs its text in one value. A conversation of one chunk is digested where its windows
    are; only texts of longer ones are shuffled once more.
    """
    parsed = windows.select(
        "conv_id", "chunk", "window", "n_chunks", F.length("formatted").alias("chars"), new_turns(windows).alias("turns"), loss_text(windows).alias("loss")
    ).select(
        "conv_id",
        "chunk",
        "window",
        "n_chunks",
        "chars",
        "loss",
        F.size("turns").alias("n"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"),
    )
    alone = F.col("n_chunks") == 1
    chunks = (
        parsed.groupBy("conv_id", "chunk")
        .agg(
            F.max("n_chunks").alias("n_chunks"),
            F.sum("n").alias("n"),
            F.sum("chars").alias("chars"),
            F.sum(F.length("loss")).alias("loss_chars"),
            F.sort_array(F.collect_list(F.struct("window", "turns", "loss"))).alias("parts"),
        )
        .withColumn("turns", F.array_join("parts.turns", ""))
        .withColumn("loss", F.array_join("parts.loss", ""))
        .select(
            "conv_id",
            "chunk",
            "n",
            "chars",
            "loss_chars",
            F.when(alone, F.sha2("turns", 256)).alias("turns_sha256"),
            F.when(alone, F.sha2("loss", 256)).alias("loss_sha256"),
            F.when(~alone, F.struct("chunk", "turns", "loss")).alias("part"),
        )
    )
    return (
        chunks.groupBy("conv_id")
        .agg(
            F.sum("n").alias("n_turns"),
            F.max("turns_sha256").alias("turns_sha256"),
            F.sum("loss_chars").alias("loss_chars"),
            F.max("loss_sha256").alias("loss_sha256"),
            F.sum("chars").alias("formatted_chars"),
            F.sort_array(F.collect_list("part")).alias("parts"),
        )
        .select(
            "conv_id",
            "n_turns",
            F.coalesce("turns_sha256", F.sha2(F.array_join("parts.turns", ""), 256)).alias("turns_sha256"),
            "loss_chars",
            F.coalesce("loss_sha256", F.sha2(F.array_join("parts.loss", ""), 256)).alias("loss_sha256"),
            "formatted_chars",
        )
    )
