"""Chat formatting by perspective rotation: every participant of a dialogue is the assistant once.

For each participant the dialogue is rendered with that speaker's turns as the assistant's
and all others' as named users'; the mask spans cover the assistant's words and the mark
that ends a turn, which is what a model is trained on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import join_groups, let, staged

#: Turns are rendered in blocks of this many turn numbers, so that no conversation is one task's or one row's work.
BLOCK = 64
SYSTEM = "system"
UNNAMED = "unnamed"
END = "<|end|>\n"


def _head(speaker: Column, perspective: Column, system: str) -> Column:
    user = F.concat(F.lit("<|user name="), speaker, F.lit("|>\n"))
    return F.when(speaker == perspective, F.lit("<|assistant|>\n")).when(speaker == system, F.lit("<|system|>\n")).otherwise(user)


def rotate(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", system: str = SYSTEM, block: int = BLOCK
) -> DataFrame:
    """One row for each conversation, perspective and block of turns: n_turns, rendered, mask, n_trained.

    The system's turns are shown to all and never the assistant's. Turns come in the order
    of turn (nulls first), role and text; the turns whose number is null make block null. A row that repeats
    another one wholly is the same turn and is rendered once. A null role is `unnamed`, a null
    text is empty. A conversation of the system alone has no participant and gives no row; an
    empty table gives none. mask holds "start:stop" pairs of characters in `rendered`, comma-joined. Other
    columns are not read.

    A speaker list goes to a conversation's rows by a join that no hot conversation skews.
    The output has a row set for each participant: that is the operator's own size.
    """
    turns = df.select(
        F.col(f"`{conv_col}`").alias("conv_id"),
        F.col(f"`{turn_col}`").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit(UNNAMED)).alias("role"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )
    turns = staged(turns.distinct().withColumn("conv_key", F.coalesce(F.col("conv_id").cast("string"), F.lit(""))).withColumn("spread", F.xxhash64("conv_id", "turn", "role", "text")))
    speakers = turns.where(F.col("role") != system).groupBy("conv_key", "role").count()
    sizes = turns.groupBy("conv_key").agg(F.count(F.lit(1)).alias("n"))
    people = staged(speakers.groupBy("conv_key").agg(F.sort_array(F.collect_list("role")).alias("people")).join(sizes, "conv_key"))
    shown = join_groups(turns, people, "conv_key", "n", turns.count(), "spread").select(
        "conv_id", F.explode("people").alias("perspective"), F.floor(F.col("turn") / block).cast("long").alias("block"), "turn", "role", "text"
    )
    grouped = shown.groupBy("conv_id", "perspective", "block").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))

    def pieces(of: Column) -> Column:
        def piece(t: Column) -> Column:
            head = _head(t["role"], F.col("perspective"), system)
            return F.struct(
                F.concat(head, t["text"], F.lit(END)).alias("all"),
                F.char_length(head).alias("head"),
                (F.char_length(t["text"]) + len(END) - 1).alias("body"),
                (t["role"] == F.col("perspective")).alias("own"),
            )

        return F.transform(of, piece)

    def rendered(parts: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.lit("").alias("mask"), F.lit(0).alias("trained"))

        def step(state: Column, p: Column) -> Column:
            begin = state["at"] + p["head"]
            span = F.concat(begin.cast("string"), F.lit(":"), (begin + p["body"]).cast("string"))
            mask = F.when(~p["own"], state["mask"]).when(state["mask"] == "", span).otherwise(F.concat(state["mask"], F.lit(","), span))
            trained = state["trained"] + F.when(p["own"], p["body"]).otherwise(F.lit(0))
            return F.struct((state["at"] + F.char_length(p["all"])).alias("at"), mask.alias("mask"), trained.alias("trained"))

        spans = F.aggregate(parts, start, step)
        return F.struct(F.array_join(F.transform(parts, lambda p: p["all"]), "").alias("rendered"), spans.alias("spans"))

    out = grouped.withColumn("r", let(pieces(F.col("turns")), rendered))
    return out.select(
        F.col("conv_id").alias(conv_col),
        "perspective",
        "block",
        F.size("turns").cast("long").alias("n_turns"),
        F.col("r.rendered").alias("rendered"),
        F.col("r.spans.mask").alias("mask"),
        F.col("r.spans.trained").cast("long").alias("n_trained"),
    )
