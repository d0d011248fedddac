"""Chat formatting with typed content parts (built-ins only).

A turn's content is plain text or an ordered array of parts
``struct<kind, text, uri, units>``, kind one of text, image, audio, document. A
visitor, one case per kind, flattens the parts in order: text is escaped and
written, any other part becomes a placeholder ``<|kind:i|>`` (i counts the
attachments of the turn from 0), its reference is recorded, and it expands to
``units`` times the tokens of its kind (null units: one). An unknown kind, or a
null one, is treated as text.

Template. A turn is ``<|role|>`` + the role + newline + content + ``<|end|>`` +
newline. Inside texts and roles ``&``, ``<`` and ``[`` are written ``&amp;``,
``&lt;`` and ``&#91;``, so no control string of this or another template
(``</s>``, ``[INST]``, ``<|...|>``) survives, and unescaping in the opposite order
restores every text. A line feed, which ends the role, is written ``&#10;`` inside roles. The loss mask covers the content of the ``loss_role`` turns.

Output per conv_id: n_turns, formatted, turn_starts and loss_spans (turn, start,
length), both in code points of the conversation, attachments (turn, index, kind, uri, tokens),
extra_tokens. Turns are ordered by (turn, role, text), nulls first; equal rows stay
separate turns. A null role is empty, null text is empty, null conv_id is one
conversation. Extra columns are ignored. A conversation is one output row, so its
turns meet in one row by definition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))
OPEN, CLOSE = "<|role|>", "<|end|>\n"
#: tokens that one unit expands to: an image tile, a second of audio, a page
UNIT_TOKENS = {"image": 256, "audio": 25, "document": 512}
PART = "struct<kind:string,text:string,uri:string,units:long>"


def escape(c: Column) -> Column:
    for raw, safe in ESCAPES:
        c = F.replace(c, F.lit(raw), F.lit(safe))
    return c


def unescape(c: Column) -> Column:
    for raw, safe in reversed(ESCAPES):
        c = F.replace(c, F.lit(safe), F.lit(raw))
    return c


def escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("&#10;"))


def unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("&#10;"), F.lit("\n")))


def text_part(text: Column) -> Column:
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), F.lit(None).cast("string").alias("uri"), F.lit(None).cast("long").alias("units")))


def _is_text(p: Column) -> Column:
    return ~F.coalesce(p["kind"].isin(*UNIT_TOKENS), F.lit(False))


def _visit(parts: Column) -> tuple[Column, Column]:
    """(attachments, content) of an array of parts."""
    files = F.filter(parts, lambda p: ~_is_text(p))
    tokens = lambda p: F.coalesce(p["units"], F.lit(1).cast("long")) * F.element_at(
        F.create_map(*[F.lit(x).cast("long") if isinstance(x, int) else F.lit(x) for kv in UNIT_TOKENS.items() for x in kv]), p["kind"])
    attachments = F.transform(files, lambda p, i: F.struct(i.cast("long").alias("index"), p["kind"].alias("kind"), p["uri"].alias("uri"), tokens(p).alias("tokens")))
    write = lambda p, i: F.when(_is_text(p), escape(F.coalesce(p["text"], F.lit("")))).otherwise(
        F.concat(F.lit("<|"), p["kind"], F.lit(":"), F.size(F.filter(F.slice(parts, 1, i), lambda q: ~_is_text(q))).cast("string"), F.lit("|>")))
    return attachments, F.array_join(F.transform(parts, write), "")


def format_chats(rows: DataFrame, parts: str | None = None, loss_role: str = "assistant") -> DataFrame:
    """Format conversations of rows (conv_id, turn, role, text), or with the array
    column ``parts`` in place of text."""
    content = F.col(parts).cast(f"array<{PART}>") if parts else text_part(F.col("text").cast("string"))
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                       F.coalesce(content, F.array().cast(f"array<{PART}>")).alias("parts"))
    files, text = _visit(F.col("parts"))
    head = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n"))
    rows = (rows.withColumn("content", text).withColumn("files", files).drop("parts").withColumn("head", head)
            .withColumn("piece", F.concat("head", "content", F.lit(CLOSE))))
    order = Window.partitionBy("conv_id").orderBy(*(F.col(c).asc_nulls_first() for c in ("turn", "role", "content")))
    rows = (rows.withColumn("k", F.row_number().over(order) - 1)
            .withColumn("at", F.sum(F.length("piece").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1))))
    start = F.coalesce("at", F.lit(0)) + F.length("head")
    loss = F.when(F.col("role") == loss_role, F.struct(F.col("k").alias("turn"), start.alias("start"), F.length("content").cast("long").alias("length")))
    tagged = F.transform("files", lambda f: F.struct(F.col("k").alias("turn"), f["index"].alias("index"), f["kind"].alias("kind"), f["uri"].alias("uri"), f["tokens"].alias("tokens")))
    out = rows.withColumn("loss", loss).withColumn("files", tagged).groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"), F.sort_array(F.collect_list(F.struct("k", F.coalesce("at", F.lit(0)).alias("at"), "piece"))).alias("pieces"),
        F.sort_array(F.collect_list("loss")).alias("loss_spans"), F.flatten(F.sort_array(F.collect_list("files"))).alias("attachments"))
    return out.select("conv_id", "n_turns", F.array_join(F.col("pieces.piece"), "").alias("formatted"), F.col("pieces.at").alias("turn_starts"), "loss_spans", "attachments",
                      F.aggregate("attachments", F.lit(0).cast("long"), lambda a, x: a + x["tokens"]).alias("extra_tokens"))


def read_back(chats: DataFrame) -> DataFrame:
    """Parse formatted text conversations: conv_id, n_turns, turns (role, text),
    loss_text (the unescaped text under the mask, in order)."""
    pieces = F.split("formatted", r"<\|end\|>\n", -1)
    # the explode keeps the optimiser from splitting the text anew inside each lambda below
    chats = chats.withColumn("cut", F.explode(F.array(F.struct(F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0))).alias("pieces")))))
    pieces = F.col("cut.pieces")
    turns = F.transform(pieces, lambda p: F.struct(
        unescape_role(F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), "\n", 1)).alias("role"),
        unescape(F.substr(p, F.instr(p, "\n") + 1)).alias("text")))
    # spans are absolute; each is cut from its own piece, so long conversations stay linear
    span = lambda s: unescape(F.substr(F.get(pieces, s["turn"]), (s["start"] - F.get("turn_starts", s["turn"]) + 1).cast("int"), s["length"].cast("int")))
    return chats.select("conv_id", F.size(pieces).cast("long").alias("n_turns"), turns.alias("turns"), F.array_join(F.transform("loss_spans", span), "").alias("loss_text"),
                        F.length("formatted").cast("long").alias("formatted_chars"), F.size("attachments").cast("long").alias("n_attachments"), "extra_tokens")
