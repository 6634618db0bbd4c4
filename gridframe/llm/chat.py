"""Chat formatting of typed content parts, in DataFrame functions only.

A turn's content is an array of typed parts. A visitor flattens them in order:
text is escaped and written out, an image, audio or document part becomes a
placeholder, and its reference and expanded token count are recorded, so that
the k-th placeholder of a conversation belongs to its k-th attachment.

Every turn reads ``<|turn|>role<|text|>content<|end|>``. Inside roles and texts
a backslash is doubled and ``<|`` is written ``<\\|``, so no control string can
occur there, and removing one backslash before each character undoes it.

One conversation is one string, so all its rows meet in one task; one shuffle by
conversation serves ordering, offsets and joining.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
MEDIA = ("image", "audio", "document")
# Expanded tokens: an image has one per square of pixels, audio some per second, a document some per page.
IMAGE_SQUARE, AUDIO_TOKENS_PER_SECOND, DOCUMENT_TOKENS_PER_PAGE = 28, 25, 512

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


def text_part(text: Column) -> Column:
    """Content that is one text."""
    empty = F.lit(None)
    fields = {"type": F.lit("text"), "text": text, "ref": empty, "width": empty, "height": empty, "seconds": empty, "pages": empty}
    return F.array(F.struct(*[value.alias(name) for name, value in fields.items()]).cast(PART))


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def expanded_tokens(part: Column) -> Column:
    """Tokens an attachment stands for; a part without a size counts as one unit."""
    side = lambda pixels: F.ceil(F.greatest(F.coalesce(pixels, F.lit(1)), F.lit(1)) / IMAGE_SQUARE)
    return (
        F.when(part["type"] == "image", side(part["width"]) * side(part["height"]))
        .when(part["type"] == "audio", F.ceil(F.greatest(F.coalesce(part["seconds"], F.lit(1.0)), F.lit(0.0)) * AUDIO_TOKENS_PER_SECOND))
        .when(part["type"] == "document", F.greatest(F.coalesce(part["pages"], F.lit(1)), F.lit(0)) * DOCUMENT_TOKENS_PER_PAGE)
        .cast("bigint")
    )


def visit(parts: Column) -> tuple[Column, Column]:
    """Flattened content of a turn, and its attachments in order.

    A null part, or one of an unknown type, counts as text; null text is empty.
    Texts side by side are escaped as the one text they make, so no control
    string can form where they meet.
    """
    parts = F.coalesce(parts, F.array().cast(f"array<{PART}>"))
    is_media = lambda p: F.coalesce(p["type"].isin(*MEDIA), F.lit(False))
    text = lambda p: F.when(~is_media(p), F.coalesce(p["text"], F.lit("")))

    def written(parts: Column) -> Column:
        def piece(p: Column, i: Column) -> Column:
            before = F.coalesce(text(F.get(parts, F.when(i > 0, i - 1))), F.lit(""))
            meets = (i > 0) & F.endswith(before, F.lit("<")) & F.startswith(text(p), F.lit("|"))
            return F.when(is_media(p), F.concat(F.lit("<|"), p["type"], F.lit("|>"))).otherwise(F.concat(F.when(meets, "\\").otherwise(""), escape(text(p))))

        return F.array_join(F.transform(parts, piece), "")

    filled = F.filter(parts, lambda p: is_media(p) | (text(p) != ""))
    content = F.get(F.transform(F.array(filled), written), F.lit(0))
    attached = F.transform(F.filter(parts, is_media), lambda p: F.struct(p["type"].alias("type"), p["ref"].alias("ref"), expanded_tokens(p).alias("n_tokens")))
    return content, attached


def format_conversations(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts", learn_from: str = "assistant") -> DataFrame:
    """``conv_id, n_turns, formatted, loss, attachments`` for each conversation.

    ``loss`` has an element for each turn: null, or for turns of ``learn_from``
    the span of its content: ``start`` in ``formatted``, ``offset`` in the turn,
    and ``length``, in code points. ``attachments`` are those of all turns in
    order, each with its turn's number from 0.

    Turns go by ``turn``, nulls first, ties by role and then by content; repeated
    rows are turns of their own. A null role is empty. Rows with a null
    conversation form one conversation with a null id. Other columns are not
    looked at; a conversation without rows does not exist.
    """
    content, attached = visit(F.col(f"`{parts}`"))
    rows = df.select(
        F.col(f"`{conv_id}`").alias("conv_id"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        content.alias("content"),
        attached.alias("attached"),
    )
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT))
    rows = rows.withColumn("piece", F.concat(head, "content", F.lit(END))).withColumn("offset", F.char_length(head).cast("bigint"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "content")
    before = F.sum(F.char_length("piece")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("no", F.row_number().over(order) - 1).withColumn("start", F.coalesce(before, F.lit(0)) + F.col("offset"))
    span = F.when(F.col("role") == learn_from, F.struct("start", "offset", F.char_length("content").cast("bigint").alias("length")))
    attached = F.transform("attached", lambda a: F.struct(F.col("no").alias("turn"), a["type"].alias("type"), a["ref"].alias("ref"), a["n_tokens"].alias("n_tokens")))
    turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("no", "piece", span.alias("span"), attached.alias("attached")))).alias("turns"))
    return turns.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.array_join("turns.piece", "").alias("formatted"),
        F.col("turns.span").alias("loss"),
        F.flatten("turns.attached").alias("attachments"),
    )


def read_back(formatted: DataFrame, *kept: Column) -> DataFrame:
    """``conv_id, no, role, text, learned`` of each turn, from the output of ``format_conversations`` alone.

    ``learned`` is the unescaped text under the loss mask, null elsewhere.
    Placeholders stay as they are written. ``kept`` are further columns of each row.
    """
    pieces = F.split("formatted", r"<\|end\|>", -1)
    zipped = F.arrays_zip(F.slice(pieces, 1, F.size(pieces) - 1).alias("piece"), F.col("loss"))
    turns = formatted.select("conv_id", *kept, F.posexplode(zipped).alias("no", "turn"))
    piece, span = F.col("turn.piece"), F.col("turn.loss")
    head = F.split(piece, r"<\|text\|>", 2)
    return turns.select(
        "conv_id",
        "no",
        unescape(F.substr(F.get(head, F.lit(0)), F.lit(len(TURN) + 1))).alias("role"),
        unescape(F.get(head, F.lit(1))).alias("text"),
        F.when(span.isNotNull(), unescape(F.substr(piece, (span["offset"] + 1).cast("int"), span["length"].cast("int")))).alias("learned"),
        *[F.col(name) for name in turns.columns[1:-2]],
    )


def digests(formatted: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``, read back from the formatted text."""
    length = F.char_length("formatted").cast("bigint").alias("formatted_chars")
    ordered = F.array_sort(F.collect_list(F.struct("no", F.concat("role", F.lit("\n"), "text", F.lit("\n")).alias("line"), "learned")))
    read = read_back(formatted, length).groupBy("conv_id").agg(ordered.alias("turns"), F.max("formatted_chars").alias("formatted_chars"))
    learned = F.array_join("turns.learned", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join("turns.line", ""), 256).alias("turns_sha256"),
        F.char_length(learned).cast("bigint").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        "formatted_chars",
    )
