"""Chat formatting of typed content parts, with DataFrame functions only.

A message's content is an ordered array of parts ``struct<type, text, ref, tokens>``. A visitor
(one case per part type) flattens it: text parts are escaped and written as they are; image, audio
and document parts become one placeholder each, in order, and are recorded as attachment
references with their expanded token counts. Turns are wrapped in a template's marks; control
strings inside texts and roles are escaped reversibly, so the formatted text reads back exactly.

Corner cases: null text is empty, null role is empty, null or empty parts make an empty turn, a
part of another type counts as its text; null turns come first; turns with the same number follow
by role and rendered content; repeated rows are turns of their own; rows with a null conversation
id form one conversation; an empty table gives no conversation. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, END = "<|turn|>", "<|end|>\n"
# Part types that are attachments, and the tokens one expands to when the part does not say.
ATTACHMENTS = {"image": 576, "audio": 750, "document": 1024}
PARTS = "array<struct<type:string,text:string,ref:string,tokens:int>>"
# Control strings of this and of common other templates: their first character is set apart.
_CONTROL = r"(<(?=\|)|<(?=/?s>)|\[(?=/?INST\]))"


def escape(text: Column) -> Column:
    """Text without control strings: ``&`` is ``&amp;``, and ``&;`` splits a control string."""
    return F.regexp_replace(F.replace(text, F.lit("&"), F.lit("&amp;")), _CONTROL, r"$1&;")


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&;"), F.lit("")), F.lit("&amp;"), F.lit("&"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&n;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&n;"), F.lit("\n")))


def _is(part: Column) -> Column:
    return F.coalesce(part["type"].isin(*ATTACHMENTS), F.lit(False))


def visit_part(part: Column) -> Column:
    """The text a part becomes."""
    mark = F.concat(F.lit("<|"), part["type"], F.lit("|>"))
    return F.when(_is(part), mark).otherwise(escape(F.coalesce(part["text"], F.lit(""))))


def attachments(parts: Column) -> Column:
    """References of a content's attachments: type, ref and expanded tokens, in order."""
    def record(p: Column) -> Column:
        default = F.coalesce(*[F.when(p["type"] == k, F.lit(n)) for k, n in ATTACHMENTS.items()])
        return F.struct(p["type"].alias("type"), p["ref"].alias("ref"), F.coalesce(p["tokens"], default).cast("long").alias("tokens"))
    return F.transform(F.filter(F.coalesce(parts, F.array().cast(PARTS)), _is), record)


def text_parts(text: Column) -> Column:
    """A plain text as content: one text part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.cast("string").alias("text"),
                            F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("tokens")))


def format_conversations(messages: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         parts: Column | None = None, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted`` (its text), ``loss_spans`` (array of
    start and length in UTF-8 bytes of ``formatted``: the contents of turns whose role is in
    ``loss_roles``), ``attachments`` (array of turn index, type, ref, tokens) and
    ``attachment_tokens``.

    ``parts`` defaults to the column ``parts``. A conversation is one output value, so its turns
    meet in one row; nothing else of a key is gathered.
    """
    content = F.coalesce(parts if parts is not None else F.col("parts"), F.array().cast(PARTS))
    rows = messages.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
                           F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), content.alias("parts"))
    rows = rows.select("conv_id", "turn", "role", F.concat(F.lit(TURN), escape_role(F.col("role")), F.lit("\n")).alias("head"),
                       F.array_join(F.transform("parts", visit_part), "").alias("body"), attachments(F.col("parts")).alias("files"))
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    block = F.concat("head", "body", F.lit(END))
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select("conv_id", "role", "head", "body", "files", block.alias("block"),
                       F.coalesce(F.sum(F.octet_length(block).cast("long")).over(before), F.lit(0).cast("long")).alias("at"))
    spans = F.struct((F.col("at") + F.octet_length("head")).alias("start"), F.octet_length("body").cast("long").alias("length"))
    rows = rows.select("conv_id", F.struct("at", "block", F.when(F.col("role").isin(*loss_roles), spans).alias("span"), "files").alias("m"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("m")).alias("turns"))
    named = F.flatten(F.transform("turns", lambda m, i: F.transform(m["files"], lambda f: F.struct(
        i.cast("long").alias("turn"), f["type"].alias("type"), f["ref"].alias("ref"), f["tokens"].alias("tokens")))))
    return whole.select("conv_id", F.array_join(F.transform("turns", lambda m: m["block"]), "").alias("formatted"),
                        F.filter(F.transform("turns", lambda m: m["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
                        named.alias("attachments"),
                        F.aggregate("turns", F.lit(0).cast("long"), lambda n, m: n + F.aggregate(m["files"], F.lit(0).cast("long"), lambda k, f: k + f["tokens"])).alias("attachment_tokens"))


def read_turns(formatted: Column) -> Column:
    """A formatted text's turns, read back: array of role and text (attachments as placeholders)."""
    blocks = F.filter(F.split(formatted, r"<\|end\|>\n", -1), lambda b: b != "")
    def turn(block: Column) -> Column:
        inner = F.substring(block, len(TURN) + 1, 2**31 - 1)
        cut = F.locate("\n", inner)
        return F.struct(unescape_role(F.substring(inner, F.lit(1), cut - 1)).alias("role"),
                        unescape(F.substring(inner, cut + 1, F.lit(2**31 - 1))).alias("text"))
    return F.transform(blocks, turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped, one array element per span."""
    return F.element_at(F.transform(F.array(F.encode(formatted, "UTF-8")), lambda raw: F.transform(
        spans, lambda s: unescape(F.decode(F.substring(raw, (s["start"] + 1).cast("int"), s["length"].cast("int")), "UTF-8")))), 1)


def digest(formatted: DataFrame) -> DataFrame:
    """Figures of formatted conversations, read back from the output text and its loss mask."""
    rows = formatted.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"),
                            F.array_join(read_loss(F.col("formatted"), F.col("loss_spans")), "").alias("loss"),
                            F.size("attachments").cast("long").alias("n_attachments"), "attachment_tokens")
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return rows.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(said, 256).alias("turns_sha256"), F.char_length("loss").cast("long").alias("loss_chars"),
                       F.sha2("loss", 256).alias("loss_sha256"), F.char_length("formatted").cast("long").alias("formatted_chars"),
                       "n_attachments", "attachment_tokens")
