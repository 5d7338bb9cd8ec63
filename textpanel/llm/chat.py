"""Chat formatting from event logs: each conversation's events, folded in order into final messages, then rendered.

A log has rows (conversation, message, seq, kind, role, text). Kinds:

- `open` begins a message with its role; it has no text of its own;
- `delta` adds its text to the end of its message;
- `edit` replaces what the message says with its text; later deltas add to that;
- `regenerate` empties the message, whose text is streamed anew, and takes back every message opened after it so far;
- `retract` takes the message back, whatever else is said of it.

Folding goes in two steps, so that neither holds a conversation in memory: events of one message are put in order and
folded into its text (one shuffle by conversation and message, which deals a hot conversation's messages out), and
messages of a conversation are put in order and those taken back dropped, by running windows over small numbers.

Rendering writes one row per turn, a segment of the conversation's formatted text with the span of its loss mask in
characters of the whole; a formatted conversation is its segments in order, and is never put together in memory. Marks
are told from texts by an escape: a text that holds a mark gets a backslash behind the mark's first character, before
the backslashes that stand there already. `turns` reads a formatted conversation back, from the text and mask alone.

Edge cases: a null text adds nothing; a null role is written as none and read back as null; any other role than system,
user and assistant is written by name. A message without `open` has a null role and begins with its first event. Events
of one message with equal `seq` are taken in the order open, edit, regenerate, delta, retract, then by text; messages
with equal beginnings in order of their ids. Repeated rows of a log are repeated events; repeated rows of a table of
turns are repeated turns. Null conversations are one conversation, null messages of it one message. A conversation all of
whose messages are taken back has no rows; an empty log gives an empty table; other columns are ignored. Texts of any
length are whole: a turn's text is one value, as it is in the table.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import unquote_plus

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textpanel.llm.common import small_batches, stored, table

KINDS = ("open", "edit", "regenerate", "delta", "retract")
#: By role: what stands before and behind a turn's text. Other roles are written by name.
MARKS = {"system": ("[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"), "assistant": ("<s>", "</s>")}
OTHER = ("[ROLE", "] ", " [/ROLE]")
#: The first character of a mark inside a text, with the backslashes that may stand behind it; Java and Python read it alike.
CONTROL = r"(?:<(?=\\*/?s>)|\[(?=\\*/?(?:INST\]|SYS\]|ROLE[\]:])))"
ESCAPED = re.compile(r"<\\(?=\\*/?s>)|\[\\(?=\\*/?(?:INST\]|SYS\]|ROLE[\]:]))")


def events_of(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A table of turns as the log of their streaming: each row opens a message, and its lines follow as deltas.

    Rows are in order of their turn, then of role and of their texts' md5; equal rows are turns of their own.
    """
    src = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    src = src.withColumns({"message": F.monotonically_increasing_id(), "sign": F.unhex(F.md5("text"))})
    lines = F.transform(F.split("text", "(?<=\n)"), lambda x, i: F.struct((i + 1).alias("seq"), F.lit("delta").alias("kind"), F.lit(None).cast("string").alias("role"), x.alias("text")))
    opening = F.struct(F.lit(0).alias("seq"), F.lit("open").alias("kind"), "role", F.lit(None).cast("string").alias("text"))
    events = src.select("conv_id", "message", "turn", F.col("role").alias("by"), "sign", F.inline(F.concat(F.array(opening), lines)))
    return events.select("conv_id", "message", F.struct("turn", "by", "sign", "message", "seq").alias("seq"), "kind", "role", "text")


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, turn from 0, role, text): the messages that stand when the log ends."""
    rank = F.lit(len(KINDS))
    for i, kind in enumerate(KINDS):
        rank = F.when(F.col("kind") == kind, i).otherwise(rank)
    at = F.struct("seq", rank.alias("rank"), "text")
    when = lambda *kinds: F.max(F.when(F.col("kind").isin(*kinds), at))
    message = Window.partitionBy("conv_id", "message")
    kept = events.select("conv_id", "message", "seq", "kind", "role", F.coalesce("text", F.lit("")).alias("text"))
    # Of the texts only those go further that are part of the final one: what follows the last reset, and an edit's own.
    kept = kept.withColumn("reset", F.max(F.when(F.col("kind").isin("edit", "regenerate"), at)).over(message)).withColumn("at", at)
    said = (F.col("kind") == "delta") & (F.col("reset").isNull() | (F.col("at") > F.col("reset"))) | (F.col("kind") == "edit") & (F.col("at") == F.col("reset"))
    first = F.min(F.when(F.col("kind") == "open", F.struct("at", "role")))
    messages = kept.groupBy("conv_id", "message").agg(
        F.coalesce(first["at"]["seq"], F.min("seq")).alias("begin"),
        first["role"].alias("role"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(said, F.col("at")))), lambda x: x["text"]), "").alias("text"),
        when("regenerate")["seq"].alias("again"),
        F.bool_or(F.col("kind") == "retract").alias("gone"),
    )
    order = Window.partitionBy("conv_id").orderBy("begin", "message")
    back = F.max("again").over(order.rowsBetween(Window.unboundedPreceding, -1))
    stand = messages.withColumn("back", back).where(~F.col("gone") & (F.col("back").isNull() | (F.col("begin") >= F.col("back"))))
    return stand.select("conv_id", (F.row_number().over(order) - 1).cast("long").alias("turn"), "role", "text")


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, f"({CONTROL})", r"$1\\")


def unescaped(text: str) -> str:
    return ESCAPED.sub(lambda m: m[0][0], text)


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, formatted, loss_start, loss_end): a segment per turn; the loss mask covers assistants' texts, in characters of the whole conversation."""
    before = F.concat(F.lit(OTHER[0]), F.coalesce(F.concat(F.lit(":"), F.url_encode("role")), F.lit("")), F.lit(OTHER[1]))
    behind = F.lit(OTHER[2])
    for role, (a, b) in MARKS.items():
        before = F.when(F.col("role") == role, a).otherwise(before)
        behind = F.when(F.col("role") == role, b).otherwise(behind)
    df = messages.select("conv_id", "turn", "role", before.alias("before"), escaped(F.col("text")).alias("body"), behind.alias("behind"))
    df = df.withColumn("formatted", F.concat("before", "body", "behind"))
    start = F.coalesce(F.sum(F.length("formatted")).over(Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.length("before")
    loss = F.col("role") == "assistant"
    return df.select("conv_id", "turn", "formatted", F.when(loss, start).alias("loss_start"), F.when(loss, start + F.length("body")).alias("loss_end"))


class Reader:
    """Reads a formatted conversation, piece by piece; a piece may end anywhere. It knows the text and the mask only."""

    #: A whole turn at the beginning of what is left: its mark, the text up to the closing mark of the same kind, that mark.
    TURN = re.compile(r"(?:\[SYS\] (?P<system>.*?) \[/SYS\]|\[INST\] (?P<user>.*?) \[/INST\]|<s>(?P<assistant>.*?)</s>|\[ROLE(?P<name>:[^\]]*)?\] (?P<other>.*?) \[/ROLE\])", re.S)

    def __init__(self) -> None:
        self.left, self.n_turns, self.chars, self.loss_chars = "", 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def feed(self, formatted: str, masks: list[tuple[int, int]]) -> None:
        """`masks`: spans of the loss mask that lie in this piece, in characters of the conversation."""
        for start, end in masks:
            text = unescaped(formatted[start - self.chars : end - self.chars])
            self.loss_chars += len(text)
            self.loss.update(text.encode())
        self.chars += len(formatted)
        self.left += formatted
        at = 0
        while m := self.TURN.match(self.left, at):
            at = m.end()
            role = m.lastgroup if m.lastgroup in MARKS else unquote_plus((m["name"] or ":")[1:])
            text = next(m[k] for k in (*MARKS, "other") if m[k] is not None)
            self.n_turns += 1
            self.turns.update(f"{role}\n{unescaped(text)}\n".encode())
        self.left = self.left[at:]

    def result(self) -> tuple[int, str, int, str, int]:
        if self.left:
            raise ValueError("a formatted conversation ends inside a turn")
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def turns(formatted: DataFrame) -> DataFrame:
    """Per conversation what its formatted text and mask say: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Digests run over a conversation from its first turn to its last; its segments stream through one task, one at a time.
    """
    small_batches(formatted.sparkSession)
    kind = formatted.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, reader, id_type = None, None, None
        done: list[tuple] = []

        def made() -> pa.RecordBatch:
            columns = [pa.array([r[0] for r in done], id_type), *[pa.array([r[i + 1] for r in done], t) for i, t in enumerate(types)]]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            id_type = batch.schema.field(0).type
            for key, segment, start, end in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                if reader is None or key != conv:
                    if reader is not None:
                        done.append((conv, *reader.result()))
                    conv, reader = key, Reader()
                reader.feed(segment, [] if start is None else [(start, end)])
            if len(done) >= 1000:
                yield made()
        if reader is not None:
            done.append((conv, *reader.result()))
            yield made()

    dealt = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn").select("conv_id", "formatted", "loss_start", "loss_end")
    return dealt.mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


#: A conversation whose texts are the template's own marks.
MARKED = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op11_query(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    rows = rows.select("conv_id", "turn", "role", "text").unionByName(spark.createDataFrame(MARKED, "conv_id long, turn long, role string, text string"))
    return turns(stored(render(fold(events_of(rows))), "chat"))


_ADDED = r"len(regexp_extract_all(coalesce(text, ''), '<\\*/?s>|\[\\*/?(INST\]|SYS\]|ROLE[\]:])'))"
ORACLE = f"""
WITH told AS (SELECT conv_id, turn, role, text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
r AS (SELECT conv_id, turn, coalesce(role, '') AS role, md5(coalesce(text, '')) AS sign, coalesce(text, '') AS text,
    length(coalesce(text, '')) + {_ADDED} + CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'assistant' THEN 7 ELSE 15 + coalesce(1 + length(url_encode(role)), 0) END AS chars FROM told)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, sign)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, sign) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id
"""
