"""Chat formatting from event logs (operator 1).

A log holds events (conv_id, turn, seq, kind, role, text). Sorted by sequence, the events of a turn fold into its
final messages:

    message     opens a message with this text
    delta       appends to the open message (streamed text)
    edit        replaces the text of the open message
    regenerate  empties the open message; deltas that follow build it anew

An event other than `message` opens a message by itself if none is open; a role that is given with it replaces the
open message's role. Each message is rendered as a segment

    [INST]role[/INST]text</s>

and a conversation is `<s>` and its segments, in the order of turn, then sequence. The loss mask covers the texts of
assistants. A control string inside a role or text gets a backslash after its first character, and so does one that
already has backslashes there, which makes `unescape` exact.

Turns of one conversation are folded and rendered apart, so a conversation with a third of all events is spread over
the cluster. Reading it back streams its segments in order and holds one at a time.

A table of finished turns becomes such a log by `as_log`, which says each row in one of four ways: at once, streamed in
pieces, drafted and edited, or started wrongly and regenerated. Which one depends on the row alone; folding the log gives the
rows again. A very long text is one message of one segment: it is held by one task as a row is, and never joined with others.

Null text or role is empty. A null turn or sequence sorts first; rows with a null conv_id form one conversation with
that id. Ties in the sequence go by kind, role and text; every row is an event of its own, repeated or not. Unknown
kinds stop the job. No event: no conversation. Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from shelfline.llm.common import table

BEGIN, OPEN, CLOSE, END = "<s>", "[INST]", "[/INST]", "</s>"
ASSISTANT = "assistant"
KINDS = ("message", "delta", "edit", "regenerate")
EVENTS = "conv_id bigint, turn bigint, seq bigint, kind string, role string, text string"
MESSAGES = "conv_id bigint, turn bigint, part bigint, segment string, loss_start bigint, loss_end bigint"
DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
)
BATCH_CHARS = 4 << 20

_CONTROL = r"(?=s>|/s>|INST\]|/INST\])"
_ESCAPE = re.compile(r"([<\[]\\*)" + _CONTROL)
_UNESCAPE = re.compile(r"([<\[]\\*)\\" + _CONTROL)
_SEGMENT = re.compile(r"\[INST\](.*?)\[/INST\](.*?)</s>", re.DOTALL)


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int | None, int | None]:
    """The segment of a message, and the characters of it under the loss mask."""
    head, body = f"{OPEN}{escape(role)}{CLOSE}", escape(text)
    span = (len(head), len(head) + len(body)) if role == ASSISTANT else (None, None)
    return f"{head}{body}{END}", *span


def parse(segment: str) -> tuple[str, str]:
    """Role and text of a rendered message."""
    found = _SEGMENT.fullmatch(segment)
    if not found:
        raise ValueError(f"no rendered message: {segment[:100]!r}")
    return unescape(found[1]), unescape(found[2])


def fold(events: Iterable[tuple[str, str | None, str | None]]) -> list[tuple[str, str]]:
    """The final messages (role, text) of a turn's events (kind, role, text), given in order."""
    messages: list[tuple[str, list[str]]] = []
    for kind, role, text in events:
        if kind not in KINDS:
            raise ValueError(f"unknown kind of event: {kind!r}")
        text = text or ""
        if kind == "message" or not messages:
            messages.append((role or "", [] if kind == "regenerate" else [text]))
            continue
        said, parts = messages[-1]
        if kind == "delta":
            parts.append(text)
        else:
            parts[:] = [text] if kind == "edit" else []
        messages[-1] = (said if role is None else role, parts)
    return [(role, "".join(parts)) for role, parts in messages]


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """The events of each (conv_id, turn) of a sorted partition; a turn may lie in several batches."""
    key, events = None, []
    for batch in batches:
        for conv, turn, *event in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "kind", "role", "text"))):
            if (conv, turn) != key:
                if events:
                    yield key, events
                key, events = (conv, turn), []
            events.append(event)
    if events:
        yield key, events


def _rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in MESSAGES.split(", ")]
    kinds = [pa.string() if n == "segment" else pa.int64() for n in names]
    rows: list[tuple] = []
    size = 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    for (conv, turn), events in _turns(batches):
        for part, (role, text) in enumerate(fold(events)):
            rows.append((conv, turn, part, *render(role, text)))
            size += len(text)
            if size > BATCH_CHARS:
                yield batch()
                rows, size = [], 0
    if rows:
        yield batch()


def format_messages(events: DataFrame) -> DataFrame:
    """One row per final message: its segment and the part of it (in characters) under the loss mask."""
    events = events.select(*(F.col(f.split()[0]).cast(f.split()[1]) for f in EVENTS.split(", ")))
    spread = events.repartition("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "seq", "kind", "role", "text")
    return spread.mapInArrow(_rendered, MESSAGES)


def conversations(messages: DataFrame) -> DataFrame:
    """One row per conversation: its text, and the spans of it under the loss mask. For conversations that fit a row."""
    segments = F.sort_array(F.collect_list(F.struct("turn", "part", "segment", "loss_start", "loss_end")))
    spans = F.transform(
        F.filter(
            F.transform(
                F.sequence(F.lit(0), F.size("segments") - 1),
                lambda i: F.struct(F.get("segments", i).alias("s"), _start(i).alias("at")),
            ),
            lambda x: x["s"]["loss_start"].isNotNull(),
        ),
        lambda x: F.struct(
            (x["at"] + x["s"]["loss_start"]).alias("start"), (x["at"] + x["s"]["loss_end"]).alias("end")
        ),
    )
    text = F.concat(F.lit(BEGIN), F.array_join(F.transform("segments", lambda s: s["segment"]), ""))
    return messages.groupBy("conv_id").agg(segments.alias("segments")).select("conv_id", text.alias("text"), spans.alias("loss_spans"))


def _start(i: Column) -> Column:
    """Where segment i of a conversation starts in its text."""
    before = F.slice("segments", F.lit(1), i)
    return F.aggregate(before, F.lit(len(BEGIN)).cast("bigint"), lambda n, s: n + F.length(s["segment"]))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in DIGESTS.split(", ")]
    kinds = [pa.string() if f.endswith(" string") else pa.int64() for f in DIGESTS.split(", ")]
    open_ = False
    conv = None

    def row() -> tuple:
        return conv, turns, whole.hexdigest(), loss, masked.hexdigest(), chars

    for batch in batches:
        rows = []
        for this, segment, start, end in zip(
            *(batch.column(c).to_pylist() for c in ("conv_id", "segment", "loss_start", "loss_end"))
        ):
            if not open_ or this != conv:
                if open_:
                    rows.append(row())
                open_, conv = True, this
                turns, loss, chars, whole, masked = 0, 0, len(BEGIN), hashlib.sha256(), hashlib.sha256()
            role, text = parse(segment)
            turns += 1
            chars += len(segment)
            whole.update(f"{role}\n{text}\n".encode())
            if start is not None:
                under = unescape(segment[start:end])
                loss += len(under)
                masked.update(under.encode())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
    if open_:
        yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(row(), kinds)], names)


def read_back(messages: DataFrame) -> DataFrame:
    """Per conversation, what its segments say when they are parsed again: digests of the turns and of the masked text."""
    ordered = messages.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "part")
    return ordered.mapInArrow(_digests, DIGESTS)


def as_events(rows: DataFrame) -> DataFrame:
    """A table of finished turns as a log: one `message` per row, its turn being the sequence too."""
    return rows.select(
        "conv_id", "turn", F.col("turn").alias("seq"), F.lit("message").alias("kind"), "role", "text"
    )


#: Pieces that `as_log` streams a text in: few, so that cutting a very long one takes time in proportion.
PIECES = 4


def as_log(rows: DataFrame) -> DataFrame:
    """A table of finished turns (conv_id, turn, role, text) as a log whose fold has a message per row, in the same order.

    Rows of one turn are numbered by role and text, ties in any order as such rows are equal, and each takes a range of
    sequence numbers. Events come in the sequence's order only after sorting: a log has no order of its own.
    """
    order = Window.partitionBy("conv_id", "turn").orderBy(F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")))
    said = rows.select("conv_id", "turn", F.col("role").cast("string"), F.col("text").cast("string"))
    said = said.withColumn("row", F.row_number().over(order).cast("bigint"))
    text, role = F.coalesce("text", F.lit("")), F.col("role")
    none, half = F.lit(None).cast("string"), F.ceil(F.length(text) / 2).cast("int")
    step = F.ceil(F.length(text) / PIECES).cast("int")
    pieces = [("delta", none, F.substring(text, step * i + 1, step)) for i in range(PIECES)]
    first, rest = F.substring(text, F.lit(1), half), F.substring(text, half + 1, F.length(text))
    ways = [
        [("message", role, F.col("text"))],
        [("message", role, none), *pieces],
        [("message", none, F.concat(F.lit("draft: "), rest)), ("edit", role, first), ("delta", none, rest)],
        [("message", role, first), ("delta", none, F.lit(" no")), ("regenerate", none, none), *pieces],
    ]

    def events(way: list[tuple[str, Column, Column]]) -> Column:
        seq = F.col("row") * (2 * PIECES)
        return F.array(
            *(
                F.struct((seq + i).alias("seq"), F.lit(kind).alias("kind"), who.alias("role"), what.alias("text"))
                for i, (kind, who, what) in enumerate(way)
            )
        )

    way = F.pmod(F.xxhash64("conv_id", "turn", "row"), F.lit(len(ways)))
    chosen = F.when(way == 0, events(ways[0])).when(way == 1, events(ways[1])).when(way == 2, events(ways[2]))
    return said.select("conv_id", "turn", F.inline(chosen.otherwise(events(ways[3]))))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, ASSISTANT, said)], "conv_id bigint, turn bigint, role string, text string"
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    return read_back(format_messages(as_log(rows)))


ORACLE = r"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), escaped AS (
    SELECT *,
        length(regexp_replace(role, '([<\[]\\*)(s>|/s>|INST\]|/INST\])', '\1\\\2', 'g'))
        + length(regexp_replace(text, '([<\[]\\*)(s>|/s>|INST\]|/INST\])', '\1\\\2', 'g')) AS chars
    FROM said
)
SELECT conv_id,
    count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    (3 + sum(17 + chars))::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
"""
