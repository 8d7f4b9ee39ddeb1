"""Chat formatting from an event log, by DataFrame functions only.

Events are (conv_id, seq, kind, message_id, role, text). Kinds:

* ``message`` opens a message with a role and its first text;
* ``delta`` appends streamed text to a message;
* ``edit`` replaces what a message holds so far (and its role, if the event has one);
* ``regenerate`` empties a message and discards all messages opened after it, up to this event.

The log is partitioned by conversation and sorted by sequence; running values over it find each message's opening,
its last reset and the later regenerations, and aggregates fold what is left into final messages. A ``message`` event
without an id is a whole message of its own. Other events for a message that was never opened open it.

The template is ``<turn role=ROLE>TEXT</turn>`` and a line break per message. In texts and roles ``\\`` becomes ``\\b``
and ``<`` becomes ``\\l`` (``>`` in roles ``\\g``), so no text holds a control string, and the escapes can be undone.
The loss mask has the text of every assistant message: turn, offset in the turn, and start and length in the whole, all
in code points of the formatted text.

Nulls, ties, repeats: null texts and roles are empty, null conversation ids are one conversation, events of unknown kinds
are ignored, and null sequence numbers come first. Ties in the sequence are ordered by kind (opening first), message id,
role and text. Repeated rows without a message id are repeated messages. A conversation is one row of the result, since
its digest needs its whole text; nothing larger is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

KINDS = {"message": 0, "edit": 1, "regenerate": 2, "delta": 3}
OPEN, MIDDLE, CLOSE = "<turn role=", ">", "</turn>\n"
LOSS_ROLE = "assistant"


def escape(text: Column, role: bool = False) -> Column:
    """No ``<`` (in roles also no ``>``) is left, and every backslash begins an escape."""
    escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))
    return F.replace(escaped, F.lit(">"), F.lit("\\g")) if role else escaped


def unescape(text: Column) -> Column:
    plain = F.replace(F.replace(text, F.lit("\\g"), F.lit(">")), F.lit("\\l"), F.lit("<"))
    return F.replace(plain, F.lit("\\b"), F.lit("\\"))


def messages(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, turn, role, text) of the event log; ``turn`` counts from 0."""
    kind = F.create_map(*[F.lit(x) for item in KINDS.items() for x in item])[F.col("kind")]
    log = events.select(
        "conv_id",
        F.col("seq").cast("long").alias("seq"),
        kind.alias("kind"),
        F.col("message_id").cast("string").alias("message_id"),
        F.col("role").cast("string").alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).filter(F.col("kind").isNotNull())
    sorted_log = W.partitionBy("conv_id").orderBy("seq", "kind", "message_id", "role", "text")
    log = log.withColumn("at", F.row_number().over(sorted_log))
    # Rows of a message share (message_id, alone); alone tells messages without an id apart.
    log = log.withColumn("alone", F.when(F.col("message_id").isNull(), F.col("at")).otherwise(F.lit(0)))
    message = W.partitionBy("conv_id", "message_id", "alone")
    log = log.withColumn("opened", F.min("at").over(message))
    # A message goes if a later regeneration is of a message that was opened before it.
    emptied = F.when(F.col("kind") == KINDS["regenerate"], F.col("opened"))
    after = W.partitionBy("conv_id").orderBy(F.col("at").desc()).rowsBetween(W.unboundedPreceding, W.currentRow)
    log = log.withColumn("redone", F.min(emptied).over(after))
    # An event goes if its message is emptied or replaced by a later one, or discarded.
    reset = F.max(F.when(F.col("kind").isin(KINDS["edit"], KINDS["regenerate"]), F.col("at"))).over(message)
    log = log.withColumn("reset", F.coalesce(reset, F.lit(0)))
    discarded = F.max(F.when(F.col("at") == F.col("opened"), F.col("redone") < F.col("opened"))).over(message)
    alive = log.withColumn("discarded", F.coalesce(discarded, F.lit(False))).filter(~F.col("discarded"))
    holds_text = (F.col("at") >= F.col("reset")) & (F.col("kind") != KINDS["regenerate"])
    part = F.when(holds_text, F.struct("at", "text"))
    role = F.max_by("role", F.when(F.col("role").isNotNull(), F.col("at")))
    folded = alive.groupBy("conv_id", "opened").agg(F.sort_array(F.collect_list(part)).alias("parts"), role.alias("role"))
    text = F.array_join(F.transform("parts", lambda p: p["text"]), "")
    order = W.partitionBy("conv_id").orderBy("opened")
    return folded.select(
        "conv_id", (F.row_number().over(order) - 1).alias("turn"), F.coalesce("role", F.lit("")).alias("role"), text.alias("text")
    )


def render(final: DataFrame) -> DataFrame:
    """(conv_id, n_turns, formatted, loss_spans) of final messages."""
    header = F.concat(F.lit(OPEN), escape(F.col("role"), True), F.lit(MIDDLE))
    body = escape(F.col("text"))
    pieces = final.select("conv_id", "turn", "role", F.concat(header, body, F.lit(CLOSE)).alias("piece"), F.length(header).alias("offset"), F.length(body).alias("size"))
    before = W.partitionBy("conv_id").orderBy("turn").rowsBetween(W.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("piece").cast("long")).over(before), F.lit(0)) + F.col("offset")
    span = F.when(
        F.col("role") == LOSS_ROLE,
        F.struct("turn", "offset", start.alias("start"), F.col("size").alias("length")),
    )
    pieces = pieces.withColumn("span", span)
    return pieces.groupBy("conv_id").agg(
        F.count("*").alias("n_turns"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", "piece"))), lambda p: p["piece"]), "").alias("formatted"),
        F.sort_array(F.collect_list("span")).alias("loss_spans"),
    )


def parse(formatted: DataFrame) -> DataFrame:
    """Roles and texts read back from the formatted text, and the text under the loss mask, unescaped; other columns stay."""
    split = F.split("formatted", CLOSE)
    pieces = F.slice(split, 1, F.greatest(F.size(split) - 1, F.lit(0)))
    read = formatted.withColumn("pieces", pieces)

    def turn(piece: Column) -> Column:
        header = F.substring_index(piece, MIDDLE, 1)
        return F.struct(
            unescape(F.substring(header, len(OPEN) + 1, 1 << 30)).alias("role"),
            unescape(piece.substr(F.length(header) + len(MIDDLE) + 1, F.length(piece))).alias("text"),
        )

    def masked(span: Column) -> Column:
        return unescape(F.get("pieces", span["turn"]).substr(span["offset"] + 1, span["length"]))

    return read.withColumn("turns", F.transform("pieces", turn)).withColumn("loss_text", F.array_join(F.transform("loss_spans", masked), "")).drop("pieces")


def from_turns(conversations: DataFrame) -> DataFrame:
    """Rows by turn as an event log: each row opens a whole message."""
    return conversations.select(
        "conv_id",
        F.col("turn").alias("seq"),
        F.lit("message").alias("kind"),
        F.lit(None).cast("string").alias("message_id"),
        "role",
        "text",
    )
