"""Chat formatting: typed content parts, one marked text per conversation, a loss mask.

A turn holds parts of the types text, image, audio and document.  A visitor
walks the parts in order: texts are escaped, every other part becomes a
placeholder and is recorded as an attachment with its place among the
placeholders, its reference and the number of tokens it expands to.

The template marks turns with control strings.  Every control string begins with
``<`` or ``[``; inside texts and roles these two and the backslash are written
as two-character escapes, so no text can hold a control string and the escaping
can be undone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Control strings of the template.
TURN, BODY, END = "<s>[", "]\n", "</s>\n"
PART_TYPES = ("image", "audio", "document")
#: Expansion: pixels of an image patch side, audio tokens a second, tokens a page.
PATCH, AUDIO_RATE, PAGE_TOKENS = 28, 25, 512

PARTS = ("array<struct<type string, text string, ref string, width int, height int, seconds double, pages int>>")


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\e"))
    text = F.replace(text, F.lit("<"), F.lit("\\l"))
    text = F.replace(text, F.lit("["), F.lit("\\b"))
    return F.replace(text, F.lit("]"), F.lit("\\r"))


def unescape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\l"), F.lit("<"))
    text = F.replace(text, F.lit("\\b"), F.lit("["))
    text = F.replace(text, F.lit("\\r"), F.lit("]"))
    return F.replace(text, F.lit("\\e"), F.lit("\\"))


def text_parts(text: Column) -> Column:
    """A plain text as one part."""
    none = lambda t: F.lit(None).cast(t)
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), none("string").alias("ref"),
                            none("int").alias("width"), none("int").alias("height"),
                            none("double").alias("seconds"), none("int").alias("pages")))


def _expanded(p: Column) -> Column:
    """Tokens that a part other than text stands for; unknown measures count as one."""
    side = lambda x: F.ceil(F.coalesce(x, F.lit(1)) / PATCH)
    return (F.when(p["type"] == "image", side(p["width"]) * side(p["height"]))
            .when(p["type"] == "audio", F.ceil(F.coalesce(p["seconds"], F.lit(0.0)) * AUDIO_RATE))
            .when(p["type"] == "document", F.coalesce(p["pages"], F.lit(1)) * PAGE_TOKENS).otherwise(0).cast("long"))


def visit_parts(parts: Column) -> tuple[Column, Column]:
    """Flattened text of a turn, and its attachments (kind, ref, tokens) in order.

    A part of another type than the four counts as text; null parts are empty.
    """
    known = lambda p: F.coalesce(p["type"].isin(*PART_TYPES), F.lit(False))
    parts = F.coalesce(parts, F.array().cast(PARTS))
    flat = F.array_join(F.transform(parts, lambda p: F.when(known(p), F.concat(F.lit("<|"), p["type"], F.lit("|>")))
                                    .otherwise(escape(F.coalesce(p["text"], F.lit(""))))), "")
    attached = F.transform(F.filter(parts, known), lambda p: F.struct(
        p["type"].alias("kind"), p["ref"].alias("ref"), _expanded(p).alias("tokens")))
    return flat, attached


def format_chat(turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation from rows conv_id, turn, role, parts.

    Result: conv_id, formatted (the whole text), segments (array of text, loss:
    formatted cut at the borders of the loss mask, which covers the bodies of
    turns with a role of ``loss_roles``), attachments (kind, ref, tokens, turn
    index and place in order) and expanded_tokens.  Turns are put in order of
    turn, role and text; equal rows stay as often as they come; a null role is
    an empty one; null parts are an empty body.  Rows with a null conv_id form
    one conversation.  Other columns are not looked at.  A conversation is one
    text, so its rows meet in one value however long it is.
    """
    flat, attached = visit_parts(F.col("parts"))
    rows = turns.select("conv_id", F.struct(
        F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), flat.alias("body"), attached.alias("att")).alias("r"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("r")).alias("r"))
    loss = lambda t: t["role"].isin(*loss_roles)
    pieces = F.flatten(F.transform("r", lambda t: F.array(
        F.struct(F.concat(F.lit(TURN), escape(t["role"]), F.lit(BODY)).alias("text"), F.lit(False).alias("loss")),
        F.struct(t["body"].alias("text"), loss(t).alias("loss")),
        F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")))))
    listed = F.flatten(F.transform("r", lambda t, i: F.transform(t["att"], lambda a: F.struct(
        a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens"), i.alias("turn_index")))))
    return (whole.select("conv_id", pieces.alias("segments"), listed.alias("attachments"))
            .withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))
            .withColumn("attachments", F.transform("attachments", lambda a, i: F.struct(
                a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens"),
                a["turn_index"].alias("turn_index"), i.alias("place"))))
            .withColumn("expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda s, a: s + a["tokens"]))
            .select("conv_id", "formatted", "segments", "attachments", "expanded_tokens"))


def read_turns(formatted: Column) -> Column:
    """Turns (role, text) read back from the marked text; placeholders stay as they are."""
    bodies = F.filter(F.split(formatted, "\\Q" + END + "\\E"), lambda x: x != "")
    inner = F.transform(bodies, lambda x: F.substring(x, F.lit(len(TURN) + 1), F.char_length(x)))
    return F.transform(inner, lambda x: F.struct(
        unescape(F.substring_index(x, BODY, 1)).alias("role"),
        unescape(F.substring(x, F.char_length(F.substring_index(x, BODY, 1)) + F.lit(len(BODY) + 1), F.char_length(x))).alias("text")))


def turn_digest(turns: Column) -> Column:
    """Lowercase hex of role, line feed, text, line feed for each turn."""
    return F.sha2(F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
