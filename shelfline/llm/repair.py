"""Conversation structure repair by a rank-convergent parallel Viterbi search (operator 11).

The rows of a conversation, in order of turn, are edited into roles `(s?(ua)+)?` (their initials: an optional system message,
then user and assistant in turn, or nothing) at the least cost:

    K  keep a row                                0
    R  give a row the role user or assistant     1
    D  delete a row                              2, required for a blank or duplicate one
    I  insert an empty message, user or assistant, anywhere   5
       a truncated row that isn't deleted        5 more

The letters of the edits in order are the audit; of all cheapest ones the least in ASCII order counts. A row's fault is the first
that holds: blank (nothing but ASCII white space), duplicate (role and text seen earlier in the conversation), truncated (the
last character that isn't white space is none of `.!?`).

1.  Rows are ordered by ranges of (conv_id, turn, role, text) and cut into chunks of at most `CHUNK` rows of one
    conversation, so a conversation with a third of all rows is spread over many tasks. The first row of each content comes from
    the least place per (conversation, digest), to which a chunk sends a content once.
2.  Backward costs: four numbers, the least cost to the end from each state (nothing yet, after s, u, a). Every chunk starts at its end
    from a speculative vector, that of the end of a conversation, and runs to its beginning.
3.  Fix-up passes: a chunk whose successor's vector differs from what it started from by more than a constant (vectors are kept apart
    from their constants) runs again. Rank convergence makes most chunks forget their end, so a pass or two settle all. Chunks
    that don't forget, such as ones of blank rows only, settle in logarithmically many passes: in each pass twice as many neighbours
    hand on their vectors in one run.
4.  Tracing: given the true vector at its end, a chunk finds its cheapest edits forwards, taking the least letter that keeps to the
    least cost, from each of the four states it may begin in. A state and a letter have one successor, so this is the least audit.
5.  Chunk by chunk, conversations are put together: the state at a chunk's end picks the next one's edits. This streams a
    conversation's rows through one task, as its result is one digest, and holds its audit and one batch of rows.

The total cost is the first chunk's vector and the constants of all chunks.

Null roles and texts count as one space, and so do nulls in the key of the damage. Null turns come first; a null conv_id is a
conversation. Rows with the same turn are in order of role, then text; equal rows are duplicates of the first. A
conversation without rows has no edits, cost 0 and an empty text. No rows at all: no conversation. Texts are never
looked at beyond their last characters but to form digests, so long ones cost what they weigh. Other columns of the
input are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from shelfline.llm.common import WHITE, slices, stored, table

CHUNK = 4096
BATCH_BYTES = 4 << 20
KEEP, RENAME, REMOVE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: What may follow each state, and the state that a missing message leads to.
FOLLOWS = {NOTHING: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
MISSING = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: Kinds of rows: twice the role (3: none of the three), one more if truncated; rows that have to go.
BLANK, DUPLICATE = 8, 9

Vector = tuple[int, int, int, int]

PLACED = "conv_id bigint, turn bigint, role string, text string, kind tinyint, digest binary, place bigint, chunk bigint, first_here boolean"
VECTORS = "conv_id bigint, chunk bigint, finish array<int>, start array<int>, shift bigint"
TRACED = "conv_id bigint, chunk bigint, kinds array<tinyint>, start array<int>, shift bigint, audits array<string>, ends array<int>"
REPAIRED = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string"
)
_LONG = (1 << 63) - 1


# The search ---------------------------------------------------------------------------------------------


def with_inserts(costs: tuple[int | float, ...]) -> Vector:
    """Least costs from each state where messages may be inserted before what follows."""
    nothing, system, user, assistant = costs
    user, assistant = min(user, INSERT + assistant), min(assistant, INSERT + user)
    return min(nothing, INSERT + user), min(system, INSERT + user), user, assistant


#: At the end of a conversation nothing or an assistant's message has to be last.
FINAL = with_inserts((0, float("inf"), float("inf"), 0))


def edits(kind: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of what can be done with a row, in order of the letters."""
    found = [("D", REMOVE, state)]
    if kind < BLANK:
        role, more = kind // 2 + SYSTEM, CUT_OFF * (kind % 2)
        if role in FOLLOWS[state]:
            found.append(("K", KEEP + more, role))
        found.append(("R", RENAME + more, MISSING[state]))
    return found


@cache
def back(kind: int, after: Vector) -> tuple[Vector, int]:
    """The vector before a row, less its least cost, and that constant."""
    before = with_inserts(tuple(min(cost + after[to] for _, cost, to in edits(kind, state)) for state in range(4)))
    least = min(before)
    return tuple(c - least for c in before), least


def backward(kinds: list[int], finish: Vector) -> tuple[list[Vector], int]:
    """The vectors before each row and after the last, and the sum of the constants."""
    vectors, shift = [finish], 0
    for kind in reversed(kinds):
        before, more = back(kind, vectors[-1])
        vectors.append(before)
        shift += more
    return vectors[::-1], shift


@cache
def step(kind: int, state: int, before: Vector, after: Vector, least: int) -> tuple[str, int]:
    """The least letters that take a row on a cheapest way from a state, and the state behind it."""
    letters = ""
    while True:
        for letter, cost, to in edits(kind, state):
            if letter > "I" and before[state] == INSERT + before[MISSING[state]]:
                break
            if before[state] + least == cost + after[to]:
                return letters + letter, to
        # An insert leads to another state before the same row.
        letters, state = letters + "I", MISSING[state]


def trailing(state: int) -> tuple[str, int]:
    """The inserts after the last row."""
    letters = ""
    while state not in (NOTHING, ASSISTANT):
        letters, state = letters + "I", MISSING[state]
    return letters, state


def traced(kinds: list[int], vectors: list[Vector], last: bool) -> tuple[list[str], list[int]]:
    """The least audit from each state that the rows may begin in, and the states they end in."""
    audits, ends = [], []
    for state in range(4):
        letters = []
        for kind, before, after in zip(kinds, vectors, vectors[1:]):
            more, state = step(kind, state, before, after, back(kind, after)[1])
            letters.append(more)
        if last:
            more, state = trailing(state)
            letters.append(more)
        audits.append("".join(letters))
        ends.append(state)
    return audits, ends


# Rows, chunks and their vectors -------------------------------------------------------------------------


def kind_of_row() -> Column:
    """The kind of a row by itself, without what came before it."""
    text, initial = F.rtrim("text", F.lit(WHITE)), F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    truncated = (~F.right(text, F.lit(1)).isin(".", "!", "?")).cast("int")
    return F.when(text == "", F.lit(BLANK)).otherwise(2 * role + truncated).cast("tinyint")


def placed(rows: DataFrame, chunk: int) -> DataFrame:
    """Rows (conv_id, turn, role, text; no nulls in the texts) with their place in the order, their chunk (the place
    of its first row), and whether their content is new in it."""
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    rows = rows.select("conv_id", "turn", "role", "text", kind_of_row().alias("kind"), digest.alias("digest"))
    # Equal rows may be many, so a number of their own decides in which range they lie.
    order = ["conv_id", "turn", "role", "text", "_row"]
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = (TaskContext.get().partitionId() << 40) - 1
        conversation, begin, seen = object(), 0, set()
        for batch in batches:
            chunks, first = [], []
            for conv_id, digest in zip(batch.column(0).to_pylist(), batch.column(5).to_pylist()):
                place += 1
                if conv_id != conversation or place - begin >= chunk:
                    conversation, begin, seen = conv_id, place, set()
                chunks.append(begin)
                first.append(digest not in seen)
                seen.add(digest)
            n = batch.num_rows
            columns = [pa.array(range(place - n + 1, place + 1), pa.int64()), pa.array(chunks, pa.int64()), pa.array(first, pa.bool_())]
            names = [*batch.schema.names, "place", "chunk", "first_here"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names)

    return stored(ranged.mapInArrow(run, PLACED), "rows")


def chunks_of(rows: DataFrame) -> DataFrame:
    """(conv_id, chunk, kinds), stored: the kinds of a chunk's rows in order, now that duplicates are known."""
    new = rows.filter("first_here").groupBy("conv_id", "digest").agg(F.min("place").alias("_place"))
    known = rows.join(new.select("_place"), F.col("place") == F.col("_place"), "left")
    kind = F.when((F.col("kind") < BLANK) & F.col("_place").isNull(), F.lit(DUPLICATE)).otherwise(F.col("kind")).cast("tinyint")
    known = known.select("conv_id", "chunk", F.struct("place", kind.alias("kind")).alias("row"))
    kinds = F.transform(F.sort_array(F.collect_list("row")), lambda r: r["kind"])
    return stored(known.groupBy("conv_id", "chunk").agg(kinds.alias("kinds")), "chunks")


def speculative(chunks: DataFrame) -> DataFrame:
    """Every chunk's vector at its beginning if a conversation ended with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [backward(kinds, FINAL) for kinds in batch.column(2).to_pylist()]
            columns = [[FINAL] * len(found), [v[0] for v, _ in found], [s for _, s in found]]
            yield batch_of([batch.column(0), batch.column(1), *columns], VECTORS)

    return chunks.select("conv_id", "chunk", "kinds").mapInArrow(run, VECTORS)


def batch_of(columns: list, schema: str) -> pa.RecordBatch:
    """A batch of the schema's first columns from Arrow arrays or Python values."""
    kinds = {"bigint": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}
    fields = [f.split(" ") for f in schema.split(", ")]
    made = [c if isinstance(c, pa.Array) else pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields)]
    return pa.RecordBatch.from_arrays(made, [name for name, _ in fields])


def wanted(vectors: DataFrame) -> DataFrame:
    """Vectors with what their successor says they should have started from."""
    order = Window.partitionBy("conv_id").orderBy("chunk")
    final = F.array(*[F.lit(c) for c in FINAL])
    return vectors.withColumn("wanted", F.coalesce(F.lead("start").over(order), final))


def fixed(chunks: DataFrame, vectors: DataFrame, together: int) -> DataFrame:
    """One pass: chunks that started from a wrong vector run again, `together` neighbours handing on their vectors."""
    order = Window.partitionBy("conv_id").orderBy(F.desc("chunk"))
    lot = F.floor((F.row_number().over(order) - 1) / F.lit(together))
    asked = wanted(vectors).withColumn("lot", lot).join(chunks.select("chunk", "kinds"), "chunk")
    asked = asked.select("conv_id", "chunk", "finish", "start", "shift", "wanted", "lot", "kinds")
    asked = asked.repartition("conv_id", "lot").sortWithinPartitions("conv_id", "lot", F.desc("chunk"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, handed = None, None
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                name = row["conv_id"], row["lot"]
                end = tuple(row["wanted"]) if name != of else handed
                start, shift = tuple(row["start"]), row["shift"]
                if end != tuple(row["finish"]):
                    found, shift = backward(row["kinds"], end)
                    start = found[0]
                out.append((row["conv_id"], row["chunk"], end, start, shift))
                of, handed = name, start
            if out:
                yield batch_of(list(zip(*out)), VECTORS)

    return asked.mapInArrow(run, VECTORS)


def settled(chunks: DataFrame) -> tuple[DataFrame, int]:
    """The true vectors of all chunks, and the number of passes that it took."""
    first = stored(speculative(chunks), "vectors")
    several = F.count(F.lit(1)).over(Window.partitionBy("conv_id")) > 1
    split = first.withColumn("several", several)
    done, open_ = split.filter("NOT several").drop("several"), stored(split.filter("several").drop("several"), "vectors")
    passes = 0
    while not wanted(open_).filter("wanted <> finish").isEmpty():
        open_ = stored(fixed(chunks, open_, 1 << passes), "vectors")
        passes += 1
    return done.unionByName(open_), passes


def traces(chunks: DataFrame, vectors: DataFrame) -> DataFrame:
    last = F.max("chunk").over(Window.partitionBy("conv_id")) == F.col("chunk")
    asked = vectors.withColumn("last", last).join(chunks.select("chunk", "kinds"), "chunk")
    asked = asked.select("conv_id", "chunk", "kinds", "start", "shift", "finish", "last")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            audits, ends = [], []
            for row in batch.select(["kinds", "finish", "last"]).to_pylist():
                found, _ = backward(row["kinds"], tuple(row["finish"]))
                letters, states = traced(row["kinds"], found, row["last"])
                audits.append(letters)
                ends.append(states)
            yield batch_of([*batch.columns[:5], audits, ends], TRACED)

    return asked.mapInArrow(run, TRACED)


# Putting conversations together -------------------------------------------------------------------------


class Conversation:
    """What is known of a conversation while its rows pass by."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.state, self.cost, self.chunks = conv_id, NOTHING, 0, 0
        self.turn = self.least = None
        self.turns = self.illegal = self.messages = 0
        self.faults = [0, 0, 0]
        self.initial: str | None = None
        self.audit: list[str] = []
        self.letters: Iterator[str] = iter("")
        self.to = NOTHING
        self.text = hashlib.sha256()

    def say(self, role: str, text: str) -> None:
        self.text.update(f"{chr(10) if self.messages else ''}{role}:{text}".encode())
        self.messages += 1

    def inserts(self) -> str:
        """The next letter that isn't an insert ("" at the end); inserts before it are written."""
        for letter in self.letters:
            if letter != "I":
                return letter
            self.state = MISSING[self.state]
            self.say(NAMES[self.state], "")
        return ""

    def begin(self, row: dict) -> None:
        """A chunk begins: the state that the last one ended in picks its edits."""
        self.inserts()
        audit = row["audits"][self.state]
        self.letters = iter(audit)
        self.audit.append(audit)
        self.cost += row["shift"] + (0 if self.chunks else row["start"][NOTHING])
        self.chunks += 1
        kinds = row["kinds"]
        for i, found in enumerate((kinds.count(BLANK), kinds.count(DUPLICATE), sum(k % 2 for k in kinds if k < BLANK))):
            self.faults[i] += found

    def add(self, turn: int | None, role: str, text: str | None) -> None:
        if turn is not None and turn != self.turn:
            self.least = turn if self.least is None else self.least
            self.turn, self.turns = turn, self.turns + 1
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        letter = self.inserts()
        if letter == "K":
            self.state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[initial]
            self.say(role, text or "")
        elif letter == "R":
            self.state = MISSING[self.state]
            self.say(NAMES[self.state], text or "")

    def result(self) -> tuple:
        self.inserts()
        gaps = self.turn - self.least + 1 - self.turns if self.turns else 0
        return (self.conv_id, min(gaps, _LONG), *self.faults, self.illegal, self.cost, "".join(self.audit), self.text.hexdigest())


def together(conversations: DataFrame, rows: DataFrame, found: DataFrame) -> DataFrame:
    """One row per conversation, from its rows and the edits of its chunks, in order."""
    names = conversations.select("conv_id").distinct()
    decided = found.withColumnsRenamed({"chunk": "place"}).withColumn("part", F.lit(1))
    # A blank row is always deleted, whatever it is.
    text = F.when(F.col("kind") < BLANK, F.col("text")).alias("text")
    told = rows.select("conv_id", "place", "turn", "role", text).withColumn("part", F.lit(2))
    all_ = names.withColumns({"place": F.lit(-1).cast("bigint"), "part": F.lit(0)})
    for more in (decided, told):
        all_ = all_.unionByName(more, allowMissingColumns=True)
    fields = ["conv_id", "text", "part", "turn", "role", "kinds", "start", "shift", "audits"]
    ordered = all_.repartition("conv_id").sortWithinPartitions("conv_id", "place", "part").select(*fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, out = None, []

        for batch in batches:
            for part in slices(batch, 1, BATCH_BYTES):
                for row in part.to_pylist():
                    if row["part"] == 0:
                        if current is not None:
                            out.append(current.result())
                        current = Conversation(row["conv_id"])
                    elif row["part"] == 1:
                        current.begin(row)
                    else:
                        current.add(row["turn"], row["role"], row["text"])
            if out:
                yield batch_of(list(zip(*out)), REPAIRED)
                out = []
        if current is not None:
            yield batch_of([[value] for value in current.result()], REPAIRED)

    return ordered.mapInArrow(run, REPAIRED)


def repaired(conversations: DataFrame, rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Repair the rows (conv_id, turn, role, text) of all conversations that occur in the first table."""
    rows = rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")],
    )
    rows = placed(rows, chunk)
    chunks = chunks_of(rows)
    vectors, _ = settled(chunks)
    return together(conversations.select(F.col("conv_id").cast("bigint").alias("conv_id")), rows, traces(chunks, vectors))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after a damage that the CRC-32 of `conv_id:turn` decides."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fate = F.crc32(F.concat(named[0], F.lit(":"), named[1])) % 20
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), fate.alias("fate")).filter("fate <> 0")
    text = F.when(F.col("fate") == 1, F.lit("")).when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.when(F.col("fate") == 3, F.lit(2)).otherwise(F.lit(1))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), copies)).alias("_copy"))
    return rows.drop("_copy")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repaired(conversations, damaged(conversations))


# A forward search over all states, row by row, as a recursion that keeps the cheapest and then least audit of each state.
ORACLE = r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS codes
  FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256))),
fated AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(4294967295, list_reduce(
           [4294967295] || list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ascii(c) AS BIGINT)),
           lambda c, b: xor(c >> 8, codes[CAST((xor(c, b) & 255) + 1 AS BIGINT)]))) % 20 AS fate
  FROM conversations, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) FROM fated)),
ordered AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed
  FROM damaged),
judged AS MATERIALIZED (
  SELECT *, CASE WHEN trimmed = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
                 WHEN right(trimmed, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(role[1]) OVER (PARTITION BY conv_id ORDER BY n) || role[1] NOT IN ('su', 'ua', 'au') AS off
  FROM ordered),
follows (state, role) AS (VALUES ('', 's'), ('', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')),
missing (state, role) AS (VALUES ('', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')),
inserts (state, letters, cost, ends) AS (
  VALUES ('', '', 0, ''), ('s', '', 0, 's'), ('u', '', 0, 'u'), ('a', '', 0, 'a'), ('', 'I', 5, 'u'), ('', 'II', 10, 'a'),
         ('s', 'I', 5, 'u'), ('s', 'II', 10, 'a'), ('u', 'I', 5, 'a'), ('a', 'I', 5, 'u')),
moves AS MATERIALIZED (
  SELECT conv_id, n, s.state, 'D' AS letter, 2 AS cost, s.state AS next FROM judged, missing AS s
  UNION ALL
  SELECT j.conv_id, j.n, f.state, 'K', CASE j.fault WHEN 'truncated' THEN 5 ELSE 0 END, f.role
  FROM judged AS j JOIN follows AS f ON f.role = j.role[1] WHERE j.fault NOT IN ('blank', 'duplicate')
  UNION ALL
  SELECT j.conv_id, j.n, m.state, 'R', CASE j.fault WHEN 'truncated' THEN 6 ELSE 1 END, m.role
  FROM judged AS j, missing AS m WHERE j.fault NOT IN ('blank', 'duplicate')),
paths AS (
  SELECT c.conv_id, CAST(0 AS BIGINT) AS n, i.ends AS state, CAST(i.cost AS BIGINT) AS cost, i.letters AS audit
  FROM (SELECT DISTINCT conv_id FROM conversations) AS c, inserts AS i WHERE i.state = ''
  UNION ALL
  SELECT * FROM (
    SELECT p.conv_id, m.n, i.ends AS state, p.cost + m.cost + i.cost AS cost, p.audit || m.letter || i.letters AS audit
    FROM paths AS p JOIN moves AS m ON m.conv_id IS NOT DISTINCT FROM p.conv_id AND m.n = p.n + 1 AND m.state = p.state
    JOIN inserts AS i ON i.state = m.next)
  QUALIFY row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) = 1),
audits AS MATERIALIZED (
  SELECT conv_id, cost, audit FROM paths WHERE state IN ('', 'a')
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY n DESC, cost, audit) = 1),
letters AS (
  SELECT conv_id, letter, i, count(*) FILTER (letter <> 'I') OVER told AS n, count(*) FILTER (letter <> 'D') OVER told AS message
  FROM (SELECT conv_id, unnest(string_split(audit, '')) AS letter, unnest(range(length(audit))) AS i FROM audits WHERE audit <> '')
  WINDOW told AS (PARTITION BY conv_id ORDER BY i)),
written AS (
  SELECT l.conv_id, l.message, l.letter, j.role, j.text, bool_or(l.letter = 'K' AND l.message = 1 AND j.role[1] = 's') OVER (PARTITION BY l.conv_id) AS headed
  FROM letters AS l LEFT JOIN judged AS j ON j.conv_id IS NOT DISTINCT FROM l.conv_id AND j.n = l.n WHERE l.letter <> 'D'),
texts AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (message - CAST(headed AS INTEGER)) % 2 = 1 THEN 'user' ELSE 'assistant' END
                             || ':' || CASE letter WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY message) AS repaired
  FROM written GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (off) AS illegal
  FROM judged GROUP BY conv_id)
SELECT a.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
       coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, a.cost, a.audit,
       sha256(coalesce(t.repaired, '')) AS repaired_sha256
FROM audits AS a LEFT JOIN counts AS c ON c.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN texts AS t ON t.conv_id IS NOT DISTINCT FROM a.conv_id"""
