"""Chat formatting by prefix-target expansion, in DataFrame operations only.

Every turn is written as ``<s>[INST]role[/INST]text</s>``. Each assistant turn becomes an example of
its own: all turns before it as context, then its reply, which alone is under the loss mask (a start
and a length in code points). A conversation that does not end with an assistant turn gets one more
example without a target, so that its last turns are in the output too.

Control strings inside roles and texts get one backslash after their first character, and so do those
that already have some; taking one away restores the text. No control string is left in a text, hence
the marks alone delimit the turns. Not reversible is only what was null: null roles and texts are
written as empty.

A conversation is put together in one row, since an example is one text; the expansion cuts its
examples out of that row.

Defined cases: turns are ordered by turn (nulls first), then role, then text; repeated rows are turns
of their own; a null conv_id is one conversation; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TARGET_ROLE = "assistant"
OPEN, ROLE_END, CLOSE = "<s>[INST]", "[/INST]", "</s>"
TURN_PATTERN = r"(?s)<s>\[INST\](.*?)\[/INST\](.*?)</s>"
CONTROL = r"(/?(?:s>|INST\]))"


def escape(text: Column) -> Column:
    """One more backslash in everything that looks like a control string."""
    return F.regexp_replace(text, rf"([<\[])(\\*){CONTROL}", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*){CONTROL}", r"$1$2$3")


def examples(turns: DataFrame) -> DataFrame:
    """conv_id, example, text, loss_start, loss_length and whole (the example has all turns)."""
    raw = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(ROLE_END))
    written = (
        raw.withColumn("head", head)
        .withColumn("body", escape(F.col("text")))
        .withColumn("written", F.concat("head", "body", F.lit(CLOSE)))
        .withColumn("number", F.row_number().over(in_order))
        .withColumn("end", F.sum(F.length("written").cast("long")).over(so_far))
    )
    body_length = F.length("body").cast("long")
    turn = F.struct(
        F.col("number"),
        (F.col("role") == TARGET_ROLE).alias("is_target"),
        F.col("end"),
        (F.col("end") - len(CLOSE) - body_length).alias("body_start"),
        body_length.alias("body_length"),
        F.col("written"),
    )
    whole = (
        written.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(turn)).alias("turns"))
        .select(
            "conv_id",
            F.array_join(F.col("turns.written"), "").alias("conversation"),
            F.size("turns").alias("n"),
            F.transform("turns", lambda t: t.dropFields("written")).alias("turns"),
        )
    )
    expanded = whole.select(
        "conv_id",
        "conversation",
        "n",
        F.explode(
            F.filter("turns", lambda t: t["is_target"] | (t["number"] == F.col("n")))
        ).alias("last"),
    )
    return expanded.select(
        "conv_id",
        F.col("last.number").cast("long").alias("example"),
        F.substring(F.col("conversation"), F.lit(1), F.col("last.end").cast("int")).alias("text"),
        F.col("last.body_start").alias("loss_start"),
        F.when(F.col("last.is_target"), F.col("last.body_length"))
        .otherwise(F.lit(0).cast("long"))
        .alias("loss_length"),
        F.col("last.is_target").alias("has_target"),
        (F.col("last.number") == F.col("n")).alias("whole"),
    )


def parsed_turns(text: Column) -> Column:
    """Roles and texts of a formatted text, unescaped."""
    roles = F.regexp_extract_all(text, F.lit(TURN_PATTERN), F.lit(1))
    texts = F.regexp_extract_all(text, F.lit(TURN_PATTERN), F.lit(2))
    return F.zip_with(
        roles, texts, lambda r, t: F.struct(unescape(r).alias("role"), unescape(t).alias("text"))
    )


def trained_text(text: Column, start: Column, length: Column) -> Column:
    """What stands under the loss mask, unescaped."""
    return unescape(F.substring(text, (start + 1).cast("int"), length.cast("int")))


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Digests of the conversations, read back from formatted examples.

    ``formatted_chars`` counts the code points of all examples of a conversation.
    """
    turns = parsed_turns(F.col("text"))
    read = formatted.select(
        "conv_id",
        F.length("text").cast("long").alias("n_chars"),
        F.when(F.col("whole"), turns).alias("turns"),
        F.when(
            F.col("has_target"),
            F.struct(
                "example",
                trained_text(F.col("text"), F.col("loss_start"), F.col("loss_length")).alias("reply"),
            ),
        ).alias("target"),
    ).withColumn(
        "spelled",
        F.array_join(
            F.transform(
                "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
            ),
            "",
        ),
    )
    grouped = read.groupBy("conv_id").agg(
        F.max(F.size("turns")).cast("long").alias("n_turns"),
        F.max(F.sha2("spelled", 256)).alias("turns_sha256"),
        F.sort_array(F.collect_list("target")).alias("targets"),
        F.sum("n_chars").alias("formatted_chars"),
    )
    trained = F.array_join(F.col("targets.reply"), "")
    return grouped.select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.length(trained).cast("long").alias("loss_chars"),
        F.sha2(trained, 256).alias("loss_sha256"),
        "formatted_chars",
    )
