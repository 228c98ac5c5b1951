"""Chat formatting from an event log, with DataFrame functions only.

Events (conv_id, turn, seq, kind, role, text) of one turn are sorted by sequence and folded into its final messages:

* ``message``    a new message (role, text)
* ``delta``      streamed text, added to the turn's last message
* ``edit``       replaces the last message's text
* ``regenerate`` empties the last message's text; the deltas that follow build it anew
* ``delete``     removes the last message

A delta, edit or regeneration before any message starts one with the event's role. Messages are rendered as
``<|turn|>role<|text|>text<|end|>``. Inside roles and texts ``\\`` becomes ``\\\\`` and ``<|`` becomes ``<\\|``, so the
marks occur nowhere else and both steps can be undone. The loss mask lists the byte ranges (UTF-8) of the assistant
texts in the output.

The work is linear in a turn's events and in a conversation's messages: a run of deltas is joined in one step, turns
of messages only need no fold, messages are range-sorted and rendered in blocks of at most ``BLOCK``, and offsets are
running sums over blocks. So one very long conversation, also in a single turn, is spread over many tasks until its one
output row is put together from blocks. Only a turn that streams, edits or deletes is folded in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import let
from ledgerline.operators.joins import fits

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
ASSISTANT = "assistant"
#: Folding turns (two longs and a flag each) up to which they are broadcast.
MAX_BROADCAST_TURNS = 200_000
#: Messages that are rendered together.
BLOCK = 128
LAST = 2**63 - 1
_MESSAGE = "array<struct<role:string,text:string>>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def before(lengths: Column, i: Column) -> Column:
    """Sum of the elements before index ``i`` of an array that is as long as a block at most."""
    return F.aggregate(F.slice(lengths, 1, i), F.lit(0).cast("long"), lambda a, n: a + n)


def fold(steps: Column) -> Column:
    """Final messages of one turn from its steps in order. A step is an event that is no delta (kind null: none), and
    the joined deltas after it (``tail`` null: none) with the role of the first of them."""

    def step(done: Column, e: Column) -> Column:
        n = F.size(done)
        has, last = n > 0, F.get(done, n - 1)
        head = F.slice(done, 1, F.greatest(n - 1, F.lit(0)))
        put = lambda role, text: F.concat(head, F.array(F.struct(role.alias("role"), text.alias("text"))))
        role = F.when(has, last["role"]).otherwise(e["role"])
        return (
            F.when(e["kind"] == "message", F.concat(done, F.array(F.struct(e["role"].alias("role"), e["text"].alias("text")))))
            .when(e["kind"] == "edit", put(role, e["text"]))
            .when(e["kind"] == "regenerate", put(role, F.lit("")))
            .when(e["kind"] == "delete", head)
            .otherwise(done)
        )

    def grown(done: Column, e: Column) -> Column:
        n = F.size(done)
        has, last = n > 0, F.get(done, n - 1)
        now = F.struct(F.when(has, last["role"]).otherwise(e["tail_role"]).alias("role"), F.concat(F.when(has, last["text"]).otherwise(""), e["tail"]).alias("text"))
        return F.when(e["tail"].isNull(), done).otherwise(F.concat(F.slice(done, 1, F.greatest(n - 1, F.lit(0))), F.array(now)))

    return F.aggregate(steps, F.array().cast(_MESSAGE), lambda done, e: let(step(done, e), lambda d: grown(d, e)))


def messages_of(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, seq, role, text): the final messages of each turn, from its events (conv_id, turn, seq, kind, role,
    text without nulls). Turns that hold messages only need no fold and are never gathered."""
    folding = rows.groupBy("conv_id", "turn").agg(F.max(F.col("kind") != "message").alias("folds")).where("folds")
    turn = [F.col(c).eqNullSafe(F.col(f"f_{c}")) for c in ("conv_id", "turn")]
    # few turns: broadcast behind a count, so that no text is shuffled for them; else a shuffle join, where shiftright by
    # 0 gives both sides an exchange of their own, so that AQE can split a very long turn
    marks = folding.select(F.shiftright("conv_id", 0).alias("f_conv_id"), F.shiftright("turn", 0).alias("f_turn"), "folds")
    marks = F.broadcast(marks) if fits(marks, MAX_BROADCAST_TURNS) else marks.hint("merge")
    marked = rows.join(marks, turn[0] & turn[1], "left").select(*rows.columns, "folds")
    plain = marked.where("folds is null").select("conv_id", "turn", "seq", "role", "text")
    is_delta = F.col("kind") == "delta"
    order = Window.partitionBy("conv_id", "turn").orderBy("seq", "kind", "role", "text")
    ordered = marked.where("folds").select("*", F.row_number().over(order).alias("pos"), F.count_if(~is_delta).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("run"))
    # a run: an event that is no delta, and the deltas up to the next such event
    deltas = F.sort_array(F.collect_list(F.when(is_delta, F.struct("pos", "role", "text"))))
    runs = ordered.groupBy("conv_id", "turn", "run").agg(F.max(F.when(~is_delta, F.struct("kind", "role", "text"))).alias("e"), deltas.alias("deltas"))
    tail = F.when(F.size("deltas") > 0, F.array_join(F.transform("deltas", lambda d: d["text"]), ""))
    step = F.struct("run", F.col("e.kind").alias("kind"), F.col("e.role").alias("role"), F.col("e.text").alias("text"), F.get("deltas", F.lit(0))["role"].alias("tail_role"), tail.alias("tail"))
    folded = runs.groupBy("conv_id", "turn").agg(fold(F.sort_array(F.collect_list(step))).alias("messages"))
    made = folded.select("conv_id", "turn", F.posexplode("messages").alias("at", "m"))
    return plain.unionByName(made.select("conv_id", "turn", F.col("at").cast("long").alias("seq"), "m.role", "m.text"))


def format_chats(events: DataFrame) -> DataFrame:
    """One row per conversation that has a message left: conv_id, n_turns, formatted, loss_spans (start, length in
    bytes of ``formatted``).

    Null texts and roles are empty, a null kind is ``message``; other unknown kinds do nothing. Null turns come last,
    null sequence numbers last inside their turn. Events equal in (turn, seq) apply in the order kind, role, text, so a
    repeated message row gives a repeated message. Null conversation ids form one conversation. An empty table gives an
    empty result. ``conv_id`` is a long.
    """
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = events.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce(F.col("turn").cast("long"), F.lit(LAST)).alias("turn"),
        F.coalesce(F.col("seq").cast("long"), F.lit(LAST)).alias("seq"),
        F.coalesce(F.col("kind"), F.lit("message")).alias("kind"),
        blank("role").alias("role"),
        blank("text").alias("text"),
    )
    # ranges of the messages' order: a conversation of any length is cut across tasks, and numbers ascend in that order
    in_order = ["conv_id", "turn", "seq", "role", "text"]
    sorted_messages = messages_of(rows).repartitionByRange(*in_order).sortWithinPartitions(*in_order)
    numbered = sorted_messages.select("conv_id", F.monotonically_increasing_id().alias("number"), "role", "text")

    def rendered(m: Column) -> Column:
        head = F.concat(F.lit(TURN), escape(m["role"]), F.lit(TEXT))
        body = escape(m["text"])
        whole = F.concat(head, body, F.lit(END))
        size = lambda c: F.octet_length(c).cast("long")
        return F.struct(whole.alias("whole"), size(whole).alias("bytes"), size(head).alias("at"), size(body).alias("length"), (m["role"] == ASSISTANT).alias("loss"))

    def joined(parts: Column) -> Column:
        """Rendered messages as one text with the loss spans relative to its start."""
        sizes = F.transform(parts, lambda p: p["bytes"])
        spans = F.transform(
            parts, lambda p, i: F.struct((before(sizes, i) + p["at"]).alias("start"), p["length"].alias("length"), p["loss"].alias("loss"))
        )
        kept = F.transform(F.filter(spans, lambda s: s["loss"]), lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length")))
        text = F.array_join(F.transform(parts, lambda p: p["whole"]), "")
        return F.struct(F.size(parts).cast("long").alias("n"), text.alias("text"), F.octet_length(text).cast("long").alias("bytes"), kept.alias("spans"))

    block = F.floor(F.col("number") / F.lit(BLOCK)).alias("block")
    listed = numbered.groupBy("conv_id", block).agg(F.sort_array(F.collect_list(F.struct("number", "role", "text"))).alias("messages"))
    blocks = listed.select("conv_id", "block", let(F.transform("messages", rendered), joined).alias("part")).select("conv_id", "block", "part.*")
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.withColumn("at", F.coalesce(F.sum("bytes").over(earlier), F.lit(0).cast("long")))
    moved = F.transform("spans", lambda s: F.struct((s["start"] + F.col("at")).alias("start"), s["length"].alias("length")))
    chats = placed.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sort_array(F.collect_list(F.struct("block", "text", moved.alias("spans")))).alias("blocks"))
    return chats.select(
        "conv_id",
        "n_turns",
        F.array_join(F.transform("blocks", lambda b: b["text"]), "").alias("formatted"),
        F.flatten(F.transform("blocks", lambda b: b["spans"])).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted conversation."""
    parts = F.filter(F.split(formatted, r"<\|turn\|>"), lambda p: p != "")
    return F.transform(
        parts,
        lambda p: F.struct(
            unescape(F.substring_index(p, TEXT, 1)).alias("role"),
            unescape(F.substring_index(F.substring_index(p, TEXT, -1), END, 1)).alias("text"),
        ),
    )


def read_loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order, with nothing between."""
    cut = lambda raw: F.transform(
        spans, lambda s: unescape(F.substring(raw, (s["start"] + 1).cast("int"), s["length"].cast("int")).cast("string"))
    )
    return F.array_join(let(formatted.cast("binary"), cut), "")


def message_events(conversations: DataFrame) -> DataFrame:
    """A table of finished messages (conv_id, turn, role, text) as an event log: one ``message`` event per row."""
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("turn").cast("long").alias("seq"),
        F.lit("message").alias("kind"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
    )
