"""Language-model scores by Brown class-based bigrams (operator 7).

p(text) = product over its tokens of p(class | state) * p(token | class). Tokens are words and one end per text.

1.  Texts are tokenised once, into blocks of bounded size: local word numbers, the distinct words, and how often each
    occurs in training texts (those whose crc32(doc_id as text) mod 5 isn't 1).
2.  Words are counted over all blocks. The `START` most frequent ones are dealt to `CLASSES` classes by exchange
    clustering: each in turn moves to the class that raises the likelihood of the class bigrams most, until few move. That
    needs one pass over the corpus, for the bigram counts of those words: a matrix of fixed size per task, summed on
    the cluster. It gives the kinds of neighbours: those classes, all other words, ends.
3.  Each word's neighbours are counted by kind and side, in each block, then in each task, then over all of them: one row
    per word. From these sums every word seen twice or more, frequent or not, is exchanged in `EXCHANGES` sweeps: it goes to the
    class whose words have the neighbours that explain its own best, and what the classes' words have is summed anew.
4.  Counts and classes go back to the blocks, which know their own words, by a join on the word. A word that stands
    everywhere has one row per block in it, which Spark splits. No vocabulary is broadcast or collected.
5.  Words seen at most once are the class of unknown words. A state is the class of the token before, or, if that was
    unknown, the last known one before it and that fact. Transitions are counted over all training texts (a small table).

Probabilities: transitions add 1/2 to each count. In a class of known words p(token) is its share of the class. Among the unknown
ones, with count c of 0 or 1, it is (c + 1/2) / (n + 1/2 (v + 1)) for n tokens and v words, so that the unseen share one
half. They sum to one over all texts.

All sums are of whole numbers and log chances are rounded before they are weighed, so classes, and with them scores, don't
depend on how the input is dealt.

The base score is that of single tokens with 1/2 added, (c + 1/2) / (N + 1/2 (V + 1)).

Null text is empty: one token, its end. A null doc_id has no remainder: such a document is held out. Repeated rows are
documents of their own and counted each time. A text longer than a block is a block by itself. Without training texts
all words are unknown. No documents: no rows. Other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfline.llm.common import slices, stored, table, texts

CLASSES, START, SWEEPS, EXCHANGES = 32, 1024, 15, 3
BLOCK_BYTES = 4 << 20
FOLDS, HELD = 5, 1
UNKNOWN, END = CLASSES, CLASSES + 1
KINDS, STATES = CLASSES + 2, 2 * (CLASSES + 2)
#: A word's neighbours: counts of each kind before it, then after it.
SIDES = 2 * KINDS
#: Log chances are weighed as whole numbers of this part of a bit.
GRAIN = 1 << 20

BLOCKS = (
    "block bigint, docs array<bigint>, held array<boolean>, lengths array<int>, tokens binary,"
    " words array<binary>, counts array<int>"
)
NEIGHBOURS = "word binary, c bigint, near binary"
CLASSED = "word binary, c bigint, class int"
MARKED = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, own double, classes binary"
)
SCORED = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double,"
    " score double"
)


def held_out(doc_id: int | None) -> bool:
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % FOLDS == HELD


def tokenised(docs: DataFrame) -> DataFrame:
    """Blocks of texts: see BLOCKS. Word 0 of each block is the end of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 24
        for whole in batches:
            for batch in slices(whole, 1, BLOCK_BYTES):
                ids = batch.column(0).to_pylist()
                held = [held_out(i) for i in ids]
                local: dict[bytes, int] = {b"": 0}
                numbered = []
                for text in texts(batch.column(1)):
                    words = text.encode().lower().split()  # bytes: only A-Z, and only ASCII white space
                    numbered.append(np.array([*(local.setdefault(w, len(local)) for w in words), 0], np.int32))
                lengths = np.array([len(t) for t in numbered])
                tokens = np.concatenate(numbered)
                learnt = tokens[np.repeat(~np.array(held), lengths)]
                counts = np.bincount(learnt, minlength=len(local)).astype(np.int32)
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": pa.array([block], pa.int64()),
                        "docs": pa.array([ids], pa.list_(pa.int64())),
                        "held": pa.array([held], pa.list_(pa.bool_())),
                        "lengths": pa.array([lengths.tolist()], pa.list_(pa.int32())),
                        "tokens": pa.array([planes(tokens)], pa.binary()),
                        "words": pa.array([list(local)], pa.list_(pa.binary())),
                        "counts": pa.array([counts], pa.list_(pa.int32())),
                    }
                )
                block += 1

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, BLOCKS)


def planes(tokens: np.ndarray) -> bytes:
    """Local word numbers as bytes: the lowest byte of each, then the next ones, which are mostly 0 and so compress well."""
    return tokens.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def numbers(data: bytes) -> np.ndarray:
    """The numbers that `planes` has laid out."""
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<i4").ravel()


def learnt_tokens(batch: pa.RecordBatch, i: int) -> np.ndarray:
    """The local numbers of block i's training texts, end to end, after the end that precedes the first."""
    held, lengths = (np.array(batch.column(c)[i].as_py(), t) for c, t in (("held", bool), ("lengths", np.int64)))
    tokens = numbers(batch.column("tokens")[i].as_py())
    return np.r_[np.int32(0), tokens[np.repeat(~held, lengths)]]


# Exchange clustering ---------------------------------------------------------------------------------------


def most_frequent(blocks: DataFrame, top: int = START) -> list[bytes]:
    """The most frequent words of training texts."""
    each = blocks.select(F.inline(F.arrays_zip("words", "counts"))).toDF("word", "n")
    sums = each.filter((F.col("n") > 0) & (F.length("word") > 0)).groupBy("word").agg(F.sum("n").alias("n"))
    return [bytes(r["word"]) for r in sums.orderBy(F.desc("n"), "word").limit(top).collect()]


def bigrams(blocks: DataFrame, top: list[bytes]) -> np.ndarray:
    """Counts of pairs of neighbours among the top words, all other words (one kind) and ends (another)."""
    size = len(top) + 2
    number = {w: i for i, w in enumerate(top)} | {b"": size - 1}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size * size, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                kinds = np.array([number.get(w, size - 2) for w in batch.column("words")[i].as_py()])
                seen = kinds[learnt_tokens(batch, i)]
                sums += np.bincount(seen[:-1] * size + seen[1:], minlength=size * size)
        rows = [r.tobytes() for r in sums.reshape(size, size)]
        task = np.full(size, TaskContext.get().partitionId())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(task), pa.array(rows, pa.binary())], ["row", "task", "sums"])

    def add(part: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(s, np.int64) for s in part["sums"]], axis=0)
        return pd.DataFrame({"row": part["row"][:1], "task": part["task"][:1], "sums": [total.tobytes()]})

    schema = "row bigint, task bigint, sums binary"
    found = blocks.select("held", "lengths", "tokens", "words").mapInArrow(run, schema)
    some = found.groupBy("row", F.floor(F.col("task") / 512)).applyInPandas(add, schema)
    out = np.zeros((size, size), np.int64)
    for r in some.groupBy("row").applyInPandas(add, schema).collect():
        out[r["row"]] = np.frombuffer(r["sums"], np.int64)
    return out


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(pairs: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """A class for each top word, other words and ends keeping kinds of their own (`classes` and the one after).

    Words move one at a time, each to the class with the largest likelihood of all class bigrams.
    """
    words = len(pairs) - 2
    of = np.r_[np.arange(words) % classes, classes, classes + 1]
    kinds = classes + 2
    member = np.eye(kinds, dtype=np.int64)[of]
    joint = member.T @ pairs @ member
    every = np.arange(classes)
    for _ in range(sweeps):
        moved = 0
        for w in range(words):
            out = np.bincount(of, pairs[w], kinds).astype(np.int64)
            into = np.bincount(of, pairs[:, w], kinds).astype(np.int64)
            own, old = pairs[w, w], of[w]
            out[old] -= own
            into[old] -= own
            joint[old] -= out
            joint[:, old] -= into
            joint[old, old] -= own
            rows, columns = joint.sum(axis=1), joint.sum(axis=0)
            gain = (_xlogx(joint[:classes] + out) - _xlogx(joint[:classes])).sum(axis=1)
            gain += (_xlogx(joint[:, :classes].T + into) - _xlogx(joint[:, :classes].T)).sum(axis=1)
            diagonal = joint[every, every]
            gain += _xlogx(diagonal + out[:classes] + into[:classes] + own) + _xlogx(diagonal)
            gain -= _xlogx(diagonal + out[:classes]) + _xlogx(diagonal + into[:classes])
            gain -= _xlogx(rows[:classes] + out.sum() + own) - _xlogx(rows[:classes])
            gain -= _xlogx(columns[:classes] + into.sum() + own) - _xlogx(columns[:classes])
            new = int(np.argmax(gain))
            if gain[new] <= gain[old] + 1e-9:
                new = int(old)
            of[w] = new
            joint[new] += out
            joint[:, new] += into
            joint[new, new] += own
            moved += new != old
        if moved <= words // 200:
            break
    return of


def packed(row: np.ndarray, column: np.ndarray, counts: np.ndarray, size: int) -> pa.Array:
    """`size` rows of counts by column as bytes: two for each hexadecimal digit that isn't 0, of column (7 bits), digit (4)
    and its place (5)."""
    left, rows, records, place = counts.astype(np.int64), [], [], 0
    while len(left):
        digit = left & 15
        some = digit > 0
        rows.append(row[some])
        records.append(column[some] | digit[some] << 7 | place << 11)
        left >>= 4
        more = left > 0
        row, column, left, place = row[more], column[more], left[more], place + 1
    rows, records = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, records))
    data = records[np.argsort(rows, kind="stable")].astype("<u2").tobytes()
    ends = 2 * np.cumsum(np.r_[0, np.bincount(rows, minlength=size)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), size, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data)])


def unpacked(column: pa.Array, row: np.ndarray, rows: int) -> np.ndarray:
    """The counts of packed values, those of the same `row` summed; whole numbers, as floats."""
    values = column.to_pylist()
    at = np.repeat(row, np.fromiter(map(len, values), np.int64, len(values)) // 2)
    records = np.frombuffer(b"".join(values), "<u2").astype(np.int64)
    n = (records >> 7 & 15) << 4 * (records >> 11)
    return np.bincount(at * SIDES + (records & 127), n, rows * SIDES).reshape(rows, SIDES)


def neighbours(blocks: DataFrame, top: list[bytes], of: np.ndarray) -> DataFrame:
    """See NEIGHBOURS: each word of training texts, its count, and how often which kind is next to it on either side."""
    number = {w: int(of[i]) for i, w in enumerate(top)} | {b"": END}

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words = batch.column("words")[i].values.cast(pa.binary())
                fixed = np.array([number.get(w, CLASSES) for w in words.to_pylist()])
                learnt = learnt_tokens(batch, i)
                kinds = fixed[learnt]
                at = learnt.astype(np.int64) * SIDES
                cells, n = np.unique(np.r_[at[1:] + kinds[:-1], at[:-1] + KINDS + kinds[1:]], return_counts=True)
                row, column = np.divmod(cells, SIDES)
                before = column < KINDS
                count = np.bincount(row[before], n[before], len(fixed)).astype(np.int64)
                near = packed(row, column, n, len(fixed))
                some = pa.array(np.flatnonzero(count))
                yield pa.RecordBatch.from_arrays(
                    [words.take(some), pa.array(count).take(some), near.take(some)], ["word", "c", "near"]
                )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows are sorted by word: the last word of a batch may go on in the next one.
        last, held = None, None
        for batch in batches:
            words = batch.column(0).to_pylist()
            if not words:
                continue
            new = np.array([True, *(a != b for a, b in zip(words, words[1:]))])
            row = np.cumsum(new) - 1
            sums = unpacked(batch.column(2), row, int(row[-1]) + 1).astype(np.int64)
            names = [words[i] for i in np.flatnonzero(new).tolist()]
            if last == names[0]:
                sums[0] += held
            elif last is not None:
                names, sums = [last, *names], np.vstack([held, sums])
            last, held = names[-1], sums[-1].copy()
            yield whole(names[:-1], sums[:-1])
        if last is not None:
            yield whole([last], held[None])

    def whole(names: list[bytes], sums: np.ndarray) -> pa.RecordBatch:
        count = pa.array(sums[:, :KINDS].sum(axis=1), pa.int64())
        row, column = np.nonzero(sums)
        near = packed(row, column, sums[row, column], len(sums))
        return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), count, near], ["word", "c", "near"])

    found = blocks.select("held", "lengths", "tokens", "words").mapInArrow(look, NEIGHBOURS)
    by_task = found.sortWithinPartitions("word").mapInArrow(add, NEIGHBOURS)
    return by_task.repartition("word").sortWithinPartitions("word").mapInArrow(add, NEIGHBOURS)


def chances(sums: np.ndarray) -> np.ndarray:
    """log2 of the chance of each kind on either side of a class's words, in whole grains."""
    smooth = (sums + 0.5).reshape(len(sums), 2, KINDS)
    return np.round(np.log2(smooth / smooth.sum(axis=2, keepdims=True)) * GRAIN).reshape(len(sums), SIDES)


def classed(words: DataFrame, pairs: np.ndarray, of: np.ndarray, exchanges: int = EXCHANGES) -> DataFrame:
    """See CLASSED: every word's class after some sweeps over NEIGHBOURS, which start from the classes of the first words."""
    member = np.eye(KINDS, dtype=np.int64)[of]
    joint = member.T @ pairs @ member
    sums = np.hstack([joint[:, :CLASSES].T, joint[:CLASSES]])
    clustered = words.filter((F.col("c") > 1) & (F.length("word") > 0))
    for _ in range(exchanges - 1):
        weights = chances(sums)

        def gather(batches: Iterator[pa.RecordBatch], weights: np.ndarray = weights) -> Iterator[pa.RecordBatch]:
            total = np.zeros((CLASSES, SIDES))
            for batch in batches:
                near = unpacked(batch.column(0), np.arange(batch.num_rows), batch.num_rows)
                total += np.eye(CLASSES)[np.argmax(near @ weights.T, axis=1)].T @ near
            cells = np.flatnonzero(total)
            n = total.ravel()[cells].astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(n)], ["cell", "n"])

        parts = clustered.select("near").mapInArrow(gather, "cell bigint, n bigint")
        sums = np.zeros(CLASSES * SIDES, np.int64)
        for r in parts.groupBy("cell").agg(F.sum("n").alias("n")).collect():
            sums[r["cell"]] = r["n"]
        sums = sums.reshape(CLASSES, SIDES)
    weights = chances(sums)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = unpacked(batch.column(2), np.arange(batch.num_rows), batch.num_rows)
            best = pa.array(np.argmax(near @ weights.T, axis=1).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), best], ["word", "c", "class"])

    return words.mapInArrow(choose, CLASSED)


def known(blocks: DataFrame, classes: DataFrame) -> DataFrame:
    """Per block and word: its count in all training texts (c) and its class."""
    places = blocks.select("block", F.posexplode("words").alias("place", "word"))
    c = F.coalesce("c", F.lit(0).cast("bigint"))
    kind = F.when(F.length("word") == 0, END).when(c <= 1, UNKNOWN).otherwise(F.col("class"))
    return places.join(classes, "word", "left").select("block", "place", c.alias("c"), kind.cast("int").alias("class"))


# Scores ----------------------------------------------------------------------------------------------------


def marked(blocks: DataFrame, facts: DataFrame) -> DataFrame:
    """Per document: the classes of its tokens, and the parts of its scores that are sums over its tokens."""
    # Lists of plain numbers: beside them, structs take three times the bytes in an exchange. None of the three is null, so they go together.
    facts = facts.withColumn("class", F.col("class").cast("tinyint"))
    listed = facts.groupBy("block").agg(*(F.collect_list(c).alias(c) for c in ("place", "c", "class")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                place, c, kind = (batch.column(f)[i].values.to_numpy(zero_copy_only=False) for f in ("place", "c", "class"))
                counts, kinds = np.zeros(len(place), np.int64), np.zeros(len(place), np.uint8)
                counts[place], kinds[place] = c, kind
                tokens = numbers(batch.column("tokens")[i].as_py())
                lengths = np.array(batch.column("lengths")[i].as_py())
                starts = np.cumsum(lengths) - lengths
                base = np.log10(counts + 0.5)
                own = np.where(kinds == UNKNOWN, base, np.where(kinds == END, 0.0, np.log10(np.maximum(counts, 1))))
                classes = kinds[tokens].tobytes()
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("docs")[i].values,
                        "held_out": batch.column("held")[i].values,
                        "n_tokens": pa.array(lengths.astype(np.int64)),
                        "n_known": pa.array(np.add.reduceat((counts > 0)[tokens].astype(np.int64), starts)),
                        "base": pa.array(np.add.reduceat(base[tokens], starts)),
                        "own": pa.array(np.add.reduceat(own[tokens], starts)),
                        "classes": pa.array([classes[a : a + n] for a, n in zip(starts, lengths)], pa.binary()),
                    }
                )

    rows = blocks.select("block", "docs", "held", "lengths", "tokens").join(listed, "block")
    return rows.mapInArrow(run, MARKED)


def steps(classes: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(state, class) of each token of a text."""
    seen = np.frombuffer(classes, np.uint8).astype(np.int64)
    before = np.r_[END, seen[:-1]]
    last = np.maximum.accumulate(np.where(before != UNKNOWN, np.arange(len(before)), 0))
    return 2 * before[last] + (before == UNKNOWN), seen


def transitions(rows: DataFrame) -> np.ndarray:
    """How often each class follows each state in training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(STATES * KINDS, np.int64)
        for batch in batches:
            for classes in batch.column(0).to_pylist():
                state, seen = steps(classes)
                sums += np.bincount(state * KINDS + seen, minlength=len(sums))
        cells = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(sums[cells])], ["cell", "n"])

    found = rows.filter(~F.col("held_out")).select("classes").mapInArrow(run, "cell bigint, n bigint")
    out = np.zeros(STATES * KINDS, np.int64)
    for r in found.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[r["cell"]] = r["n"]
    return out.reshape(STATES, KINDS)


@dataclass(frozen=True)
class Model:
    """log10 of transitions, log10 of what each class divides its tokens' counts by, and of the base's divisor."""

    follows: np.ndarray
    shares: np.ndarray
    base: float
    train_tokens: int

    @staticmethod
    def of(moves: np.ndarray, tokens: int, words: int) -> Model:
        smooth = moves + 0.5
        totals = np.maximum(moves.sum(axis=0), 1).astype(float)
        once = moves[:, UNKNOWN].sum()  # words seen once: as many tokens as words
        totals[UNKNOWN], totals[END] = once + 0.5 * (once + 1), 1.0
        follows = np.log10(smooth / smooth.sum(axis=1, keepdims=True))
        return Model(follows, np.log10(totals), float(np.log10(tokens + 0.5 * (words + 1))), tokens)

    def score(self, classes: bytes, own: float) -> float:
        state, seen = steps(classes)
        return own + float((self.follows[state, seen] - self.shares[seen]).sum())


def scores(docs: DataFrame) -> DataFrame:
    """Per document its base score and class-based score (log10), see SCORED."""
    blocks = stored(tokenised(docs), "blocks")
    top = most_frequent(blocks)
    pairs = bigrams(blocks, top)
    of = exchange(pairs)
    words = stored(neighbours(blocks, top, of), "words")
    tokens, different = words.agg(F.sum("c"), F.count(F.lit(1))).first()
    rows = stored(marked(blocks, known(blocks, classed(words, pairs, of))), "marked")
    model = Model.of(transitions(rows), tokens or 0, different)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, base, own = (batch.column(c).to_numpy() for c in ("n_tokens", "base", "own"))
            found = [model.score(k, o) for k, o in zip(batch.column("classes").to_pylist(), own)]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc_id", "held_out", "n_tokens", "n_known")),
                    pa.array(np.full(len(n), model.train_tokens)),
                    pa.array(base - n * model.base),
                    pa.array(found, pa.float64()),
                ],
                [f.split()[0] for f in SCORED.split(", ")],
            )

    return rows.mapInArrow(run, SCORED)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents"))
