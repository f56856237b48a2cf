"""Chat formatting with column functions only: typed parts become text with placeholders, turns become one text.

A turn is written as ``### role: body</turn>`` and a line break. Inside texts ``\\``, ``<`` and ``#`` (in roles
``:`` too) are written as ``\\b``, ``\\l``, ``\\h`` (``\\c``), so no text can hold a marker, and reading back is
exact. Attachments appear in the body as ``<image:1>``, numbered through the conversation.

Null texts and roles are empty; a null list of parts is an empty body. A part of an unknown type is kept as an
attachment that takes no tokens. Turns are ordered by turn (null first), then role and body, so repeated rows
and equal turn numbers have one order. Rows without conversation id form a conversation of their own. An empty
table gives an empty table. Only the columns named here are read.

One conversation is one output value and so has to fit into a task; the conversations are spread by id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEAD, AFTER_ROLE, END = "### ", ": ", "</turn>\n"
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))
PART_TYPE = (
    "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
)


@dataclass(frozen=True)
class TokenCosts:
    """Tokens that an attachment expands to."""

    image_base: int = 85
    image_tile: int = 170
    tile_pixels: int = 512
    audio_per_second: int = 25
    document_per_page: int = 600


def escaped(text: Column, escapes=ESCAPES) -> Column:
    for plain, code in escapes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column, escapes=ESCAPES) -> Column:
    """The backslash comes last: until then every backslash begins a code."""
    for plain, code in reversed(escapes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def text_part(text: Column) -> Column:
    """A turn's plain text as a list of one part."""
    return F.array(F.struct(
        F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
        F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages"),
    ))


def _is_text(part: Column) -> Column:
    return F.coalesce(part["type"], F.lit("text")) == "text"


def _tokens(part: Column, costs: TokenCosts) -> Column:
    def tiles(side: str) -> Column:
        return F.ceil(F.coalesce(part[side], F.lit(0)) / F.lit(costs.tile_pixels))

    return (
        F.when(part["type"] == "image", costs.image_base + costs.image_tile * tiles("width") * tiles("height"))
        .when(part["type"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * costs.audio_per_second))
        .when(part["type"] == "document", F.coalesce(part["pages"], F.lit(0)) * costs.document_per_page)
        .otherwise(0).cast("long")
    )


def flatten_parts(turns: DataFrame, costs: TokenCosts = TokenCosts()) -> DataFrame:
    """Visit the parts of every turn: ``conv_id, turn, role, body, attachments``.

    ``turns`` has ``conv_id, turn, role, parts`` (``PART_TYPE``). The body holds the escaped texts and the
    placeholders in the order of the parts; each attachment has its number, type, reference and expanded tokens.
    """
    given = turns.select(
        "conv_id", "turn", F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.filter("parts", lambda part: part.isNotNull()), F.array().cast(PART_TYPE)).alias("parts"),
    ).withColumn("others", F.filter("parts", lambda part: ~_is_text(part)))
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", F.to_json("parts"))
    before = F.coalesce(F.sum(F.size("others")).over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    def visited(part: Column, place: Column) -> Column:
        number = F.col("before") + F.size(F.filter(F.slice("parts", 1, place + 1), lambda p: ~_is_text(p)))
        kind = F.replace(escaped(part["type"]), F.lit(">"), F.lit(""))
        return F.when(_is_text(part), escaped(F.coalesce(part["text"], F.lit("")))).otherwise(
            F.concat(F.lit("<"), kind, F.lit(":"), number.cast("string"), F.lit(">"))
        )

    return given.withColumn("before", before).select(
        "conv_id", "turn", "role",
        F.when(F.size("others") == 0, F.array_join(
            F.transform("parts", lambda part: escaped(F.coalesce(part["text"], F.lit("")))), ""
        )).otherwise(F.array_join(F.transform("parts", visited), "")).alias("body"),
        F.transform("others", lambda part, place: F.struct(
            (F.col("before") + place + 1).alias("number"), part["type"].alias("type"), part["ref"].alias("ref"),
            _tokens(part, costs).alias("tokens"),
        )).alias("attachments"),
    )


def format_conversations(flat: DataFrame, learnt_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, formatted, mask, attachments, expanded_tokens``.

    ``mask`` has one entry per turn, in code points of ``formatted``: where the turn starts, where its loss
    starts and how many code points it covers (0 unless the role is ``learnt_role``).
    """
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    opening = F.concat(F.lit(HEAD), escaped(F.col("role"), ROLE_ESCAPES), F.lit(AFTER_ROLE))
    size = F.length("opening") + F.length("body") + len(END)
    turns = (
        flat.withColumn("opening", opening).withColumn("place", F.row_number().over(in_order))
        .withColumn("start", F.coalesce(
            F.sum(size.cast("long")).over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")
        ))
    )
    turn = F.struct(
        "place",
        F.concat("opening", "body", F.lit(END)).alias("piece"),
        F.struct(
            F.col("start").alias("turn_start"),
            (F.col("start") + F.length("opening")).alias("loss_start"),
            F.when(F.col("role") == learnt_role, F.length("body")).otherwise(0).cast("long").alias("loss_chars"),
        ).alias("mask"),
        "attachments",
    )
    gathered = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return gathered.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.transform("turns", lambda t: t["mask"]).alias("mask"),
        F.flatten(F.transform("turns", lambda t: t["attachments"])).alias("attachments"),
    ).withColumn("expanded_tokens", F.aggregate(
        F.transform("attachments", lambda a: a["tokens"]), F.lit(0).cast("long"), lambda total, t: total + t
    ))


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds ``turns, loss_texts``, read from ``formatted`` and ``mask`` alone.

    ``turns`` holds the role and text of each turn, ``loss_texts`` the unescaped text under each mask entry.
    Attachments stay as placeholders in the texts.
    """
    pieces = F.split("formatted", END.replace("\n", "\\n"))
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)  # nothing stands after the last end mark

    def turn(piece: Column) -> Column:
        role_end = F.instr(piece, AFTER_ROLE)
        role = F.substr(piece, F.lit(len(HEAD) + 1), role_end - len(HEAD) - 1)
        return F.struct(
            unescaped(role, ROLE_ESCAPES).alias("role"),
            unescaped(F.substr(piece, role_end + len(AFTER_ROLE))).alias("text"),
        )

    def under_mask(piece: Column, mask: Column) -> Column:
        start = (mask["loss_start"] - mask["turn_start"] + 1).cast("int")
        return unescaped(F.substr(piece, start, mask["loss_chars"].cast("int")))

    return formatted.withColumn("pieces", pieces).select(
        "*", F.transform("pieces", turn).alias("turns"),
        F.zip_with("pieces", "mask", under_mask).alias("loss_texts"),
    ).drop("pieces")
