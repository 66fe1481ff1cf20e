"""Chat transcripts from an event log.

Events of a conversation are ordered by sequence and folded into its final
messages: a message or an edit sets a message's text, deltas are streamed onto it, a
regeneration starts it again and removes every message begun after it.  Spark's
windows mark the events that survive; they are then rendered as a stream sorted by conversation, so
a task holds one event at a time however long a conversation is.

Template: ``<|im_start|>role`` newline text ``<|im_end|>`` newline.  Inside texts and roles
every backslash is doubled and every bar becomes backslash-p (in roles also
newline backslash-n), so no control string can occur in them, and the way back
is exact.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*)<\|im_end\|>\n", re.S)
_BACK = {"\\\\": "\\", "\\p": "|", "\\n": "\n"}


def escape(text: str | None, role: bool = False) -> str:
    out = (text or "").replace("\\", "\\\\").replace("|", "\\p")
    return out.replace("\n", "\\n") if role else out


def unescape(text: str) -> str:
    return re.sub(r"\\[\\pn]", lambda m: _BACK[m[0]], text)


def final_events(events: DataFrame) -> DataFrame:
    """The events that make up the final messages, with ``start`` (order of the message) and ``pos`` (order of the event).

    ``events``: conv_id, seq, event (message, delta, edit, regenerate), message
    (id in its conversation), role, text.  Equal sequence numbers are ordered by the other
    columns, nulls first; exact repeats are repeated events.  An unknown or null event is a delta.  A message keeps the first
    role that is given for it.
    """
    conv = Window.partitionBy("conv_id")
    message = Window.partitionBy("conv_id", "message")
    event = F.coalesce(F.col("event"), F.lit("delta"))
    sets = event.isin("message", "edit", "regenerate")
    out = events.select("conv_id", "seq", event.alias("event"), "message", "role", "text")
    out = out.withColumn("pos", F.row_number().over(conv.orderBy("seq", "event", "message", "role", "text")))
    out = out.withColumns({
        "start": F.min("pos").over(message),
        "reset": F.coalesce(F.max(F.when(sets, F.col("pos"))).over(message), F.lit(0)),
        "said_by": F.first("role", ignorenulls=True).over(message.orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    })
    # From the end, where the minimum runs along; a frame that ends unbounded is computed anew for every row.
    later = conv.orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, -1)
    cut = F.coalesce(F.min(F.when(F.col("event") == "regenerate", F.col("start"))).over(later) < F.col("start"), F.lit(False))
    out = out.withColumn("cut", cut & (F.col("pos") == F.col("start")))
    out = out.withColumn("gone", F.max("cut").over(message))
    return out.where(~F.col("gone") & (F.col("pos") >= F.col("reset"))).select(
        "conv_id", "start", "pos", F.col("said_by").alias("role"), "text")


def render(events: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """Rows (conv_id, turn, part, text, trained): the parts of every formatted conversation, in order.

    ``trained`` marks the text under the loss mask.  Rows of a conversation stay together and sorted in their partition.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, turn, part, trained = None, 0, 0, False
        out: list[tuple] = []

        def put(text: str, mask: bool = False):
            nonlocal part
            out.append((at[0], turn, part, text, mask))
            part += 1

        def flush() -> pa.RecordBatch:
            cols = list(zip(*out)) or [()] * 5
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=list(names))

        for batch in batches:
            for conv, start, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "start", "role", "text"))):
                if at != (conv, start):
                    if at is not None:
                        put(f"{END}\n")
                    turn, part = (turn + 1, part) if at is not None and at[0] == conv else (0, 0)
                    at, trained = (conv, start), role == trained_role
                    put(f"{START}{escape(role, role=True)}\n")
                put(escape(text), trained)
                if len(out) >= 4000:
                    yield flush()
        if at is not None:
            put(f"{END}\n")
        yield flush()

    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
    names = ("conv_id", "turn", "part", "text", "trained")
    live = final_events(events).withColumn("conv_id", F.col("conv_id").cast("long"))
    return live.sortWithinPartitions("conv_id", "start", "pos").mapInArrow(
        run, "conv_id long, turn long, part long, text string, trained boolean")


def read_back(parts: DataFrame) -> DataFrame:
    """Digest of each conversation, read from its formatted parts (as ``render`` leaves them).

    Every turn's formatted text is parsed and unescaped again; a text that does not parse raises.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, turn, shown, lost = None, None, [], []
        whole, loss, counts = hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
        out: list[tuple] = []

        def end_turn():
            text = "".join(shown)
            found = _TURN.fullmatch(text)
            if found is None:
                raise ValueError(f"conversation {conv}: turn {turn} is not in the template")
            role, said = unescape(found[1]), unescape(found[2])
            whole.update(f"{role}\n{said}\n".encode())
            masked = unescape("".join(lost))
            loss.update(masked.encode())
            counts[:] = counts[0] + 1, counts[1] + len(masked), counts[2] + len(text)
            shown.clear()
            lost.clear()

        def end_conversation():
            out.append((conv, counts[0], whole.hexdigest(), counts[1], loss.hexdigest(), counts[2]))

        def flush() -> pa.RecordBatch:
            cols = list(zip(*out)) or [()] * 6
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

        for batch in batches:
            for c, t, text, trained in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "turn", "text", "trained"))):
                if turn is not None and (c, t) != (conv, turn):
                    end_turn()
                    if c != conv:
                        end_conversation()
                        whole, loss, counts = hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
                conv, turn = c, t
                shown.append(text)
                if trained:
                    lost.append(text)
            if len(out) >= 1000:
                yield flush()
        if turn is not None:
            end_turn()
            end_conversation()
        yield flush()

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return parts.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def turn_events(conversations: DataFrame) -> DataFrame:
    """Each row of a conversations table as one whole message.

    Rows are told apart by all their columns and a count of repeats, so equal turns are messages of their own.
    """
    same = Window.partitionBy("conv_id", "turn", "role", "text").orderBy(F.lit(0))
    message = F.to_json(F.struct("turn", "role", F.sha2(F.col("text"), 256).alias("t"), F.row_number().over(same).alias("n")))
    # Dealt by conversation first, which serves every later window as well.
    return conversations.repartition("conv_id").select("conv_id", F.col("turn").alias("seq"), F.lit("message").alias("event"), message.alias("message"), "role", "text")


def text_of(parts: DataFrame, conv: Column | None = None) -> DataFrame:
    """(conv_id, formatted) with each conversation as one string; for conversations that fit in memory."""
    return parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "part", "text"))).alias("p")).select(
        "conv_id", F.array_join(F.transform("p", lambda p: p["text"]), "").alias("formatted"))
