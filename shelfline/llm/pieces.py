"""SentencePiece encoding and decoding of merge-type vocabularies (operator 8).

A text is cut where a mark of white space follows another character. No piece of a vocabulary trained with
`split_by_whitespace` holds such a pair (checked when it is loaded), so no merge crosses a cut and the parts can
be encoded apart. Each distinct part runs through an agenda once per memo generation: of all adjacent pairs of
symbols whose joint string is a piece, the one of the best score (then the leftmost) is merged, its new neighbours
join the agenda, and so on. The many short parts of a batch keep their agendas in arrays and take their steps
together; a long part keeps a heap, whose stale entries are skipped. What no piece covers becomes bytes.

The parts that an Arrow batch adds to the memo are also encoded by the sentencepiece library, together; a
difference stops the job. Whole texts are compared in the tests.

Null text counts as empty; an empty text has the begin and end id only. Texts may be of any length: memory holds
one batch and the memo. Repeated rows give repeated rows; other columns of the input are not read.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfline.llm.common import Memo, slices, table, texts

MARK = "▁"
MEMO_ENTRIES = 200_000
BATCH_BYTES = 2 << 20
#: Characters of a part whose agenda is kept in arrays beside others.
SHORT = 24
#: Above every place of a pair.
NEVER = 1 << 24

ENCODED = "doc_id bigint, ids binary, n_tokens bigint"
_PARTS = re.compile(" +[^ ]*")


class PieceCodec:
    """Agenda encoder and decoder over the pieces of one model file. Only merge-type models are accepted."""

    def __init__(self, path: str, memo_entries: int = MEMO_ENTRIES) -> None:
        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [lib.id_to_piece(i) for i in range(lib.get_piece_size())]
        plain = [i for i in range(len(names)) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i))]
        self.size = len(names)
        self.ids = {names[i]: i for i in plain}
        if any(MARK in n.lstrip(MARK) for n in self.ids):
            raise ValueError("a piece holds white space after another character: parts can't be encoded apart")
        place = {s: r for r, s in enumerate(sorted({-lib.get_score(i) for i in plain}))}
        #: (left symbol, right symbol) in one key: place of the joint piece by falling score, and its id.
        self.merges = {}
        for name, i in self.ids.items():
            for cut in range(1, len(name)):
                halves = name[:cut], name[cut:]
                if all(len(h) == 1 or h in self.ids for h in halves):
                    a, b = (self.symbol(h) if len(h) == 1 else self.ids[h] for h in halves)
                    self.merges[a << 32 | b] = place[-lib.get_score(i)], i
        self.pair_keys = np.array(sorted(self.merges), np.int64)
        self.pair_ranks, self.pair_joints = np.array([self.merges[k] for k in self.pair_keys.tolist()], np.int64).T
        self.byte = {int(names[i][3:5], 16): i for i in range(len(names)) if lib.is_byte(i)}
        self.begin, self.end, self.unknown = lib.bos_id(), lib.eos_id(), lib.unk_id()
        self.surface = [b"" if lib.is_control(i) else n.replace(MARK, " ").encode() for i, n in enumerate(names)]
        for value, i in self.byte.items():
            self.surface[i] = bytes([value])
        self.surface[self.unknown] = " ⁇ ".encode()
        self.memo = Memo(memo_entries)

    def agenda(self, part: str) -> list[int]:
        """The symbols of one part, marks included, by a heap of its pairs: for parts of any length."""
        symbols = [self.symbol(c) for c in part]
        n = len(symbols)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        merges = self.merges
        heap = []
        for i in range(n - 1):
            if found := merges.get(symbols[i] << 32 | symbols[i + 1]):
                heap.append((found[0], i, i + 1, symbols[i], symbols[i + 1], found[1]))
        heapq.heapify(heap)
        while heap:
            _, a, b, first, second, joint = heapq.heappop(heap)
            if symbols[a] != first or symbols[b] != second or right[a] != b:
                continue
            symbols[a], symbols[b] = joint, -1
            right[a] = after = right[b]
            if after < n:
                left[after] = a
            for x, y in ((left[a], a), (a, after)):
                if x >= 0 and y < n and (found := merges.get(symbols[x] << 32 | symbols[y])):
                    heapq.heappush(heap, (found[0], x, y, symbols[x], symbols[y], found[1]))
        return [s for s in symbols if s >= 0]

    def agendas(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of many short parts, end to end, and how many each has.

        Each round takes one merge of every part, until none has a pair that merges.
        """
        count = len(parts)
        points = np.frombuffer("".join(parts).encode("utf-32-le"), "<u4")
        alphabet, at = np.unique(points, return_inverse=True)
        symbols = np.array([self.symbol(chr(p)) for p in alphabet], np.int64)[at]
        owner = np.repeat(np.arange(count), np.fromiter(map(len, parts), np.int64, count))
        rank = np.full(len(symbols), NEVER)  # of the pair that starts here
        joint = np.zeros(len(symbols), np.int64)

        def propose(i: np.ndarray) -> None:
            rank[i] = NEVER
            i = i[(i >= 0) & (i + 1 < len(symbols))]
            i = i[owner[i] == owner[i + 1]]
            keys = symbols[i] << 32 | symbols[i + 1]
            slot = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            known = self.pair_keys[slot] == keys
            rank[i[known]] = self.pair_ranks[slot[known]]
            joint[i[known]] = self.pair_joints[slot[known]]

        propose(np.arange(len(symbols)))
        done_owner, done_symbols = [], []
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            best = np.minimum.reduceat(rank << 32 | np.arange(len(symbols)), starts)
            lengths = np.diff(np.r_[starts, len(symbols)])
            ended = np.repeat(best >= NEVER << 32, lengths)
            done_owner.append(owner[ended])
            done_symbols.append(symbols[ended])
            first = best[best < NEVER << 32] & 0xFFFFFFFF
            symbols[first] = joint[first]
            keep = ~ended
            keep[first + 1] = False
            moved = np.cumsum(keep) - 1
            symbols, owner, rank, joint = symbols[keep], owner[keep], rank[keep], joint[keep]
            first = moved[first]
            propose(np.concatenate([first[first > 0] - 1, first]))
        owner, symbols = np.concatenate(done_owner), np.concatenate(done_symbols)
        symbols = symbols[np.argsort(owner, kind="stable")]
        return symbols, np.bincount(owner, minlength=count)

    def symbol(self, char: str) -> int:
        """The id of a character's piece; one without a piece has a symbol above all ids."""
        found = self.ids.get(char)
        return self.size + ord(char) if found is None else found

    def spelt(self, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number per part: symbols without a piece become bytes, or the unknown id."""
        strange = symbols >= self.size
        if not strange.any():
            return symbols, counts
        chars, which = np.unique(symbols[strange], return_inverse=True)
        ids = [[self.byte[x] for x in chr(c - self.size).encode()] if self.byte else [self.unknown] for c in chars]
        lengths = np.ones(len(symbols), np.int64)
        lengths[strange] = np.array([len(i) for i in ids])[which]
        out = np.repeat(symbols, lengths)
        out[np.repeat(strange, lengths)] = [x for w in which.tolist() for x in ids[w]]
        owner = np.repeat(np.arange(len(counts)), counts)
        return out, np.bincount(np.repeat(owner, lengths), minlength=len(counts))

    def parts(self, text: str) -> list[str]:
        """The parts of a text, each with its leading marks, of which the first one is the encoder's own."""
        text = text.replace(MARK, " ")
        if not text:
            return []
        if "  " in text or text[0] == " ":
            return [p[1:] for p in _PARTS.findall(" " + text)]
        return text.split(" ")  # one space before each, so it goes without saying

    def learn(self, parts: set[str]) -> None:
        """Encode the parts that the memo lacks, and hold them against the library's ids."""
        absent = self.memo.missing(parts)
        if not absent:
            return
        for parts, agenda in (
            ([p for p in absent if len(p) < SHORT], self.agendas),
            ([p for p in absent if len(p) >= SHORT], self.long_agendas),
        ):
            if not parts:
                continue
            ids, counts = self.spelt(*agenda([MARK + p.replace(" ", MARK) for p in parts]))
            self.compare(parts, ids, counts)
            flat, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
            self.memo.update(zip(parts, (flat[a:b] for a, b in zip([0, *ends], ends))))

    def compare(self, parts: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        """Stop unless the library has the same ids. It puts its own mark before each text that isn't empty."""
        theirs = self.library.encode([p for p in parts if p], num_threads=1)
        bare = "" in parts  # the mark alone
        if bare:
            theirs.insert(parts.index(""), ids[(at := int(counts[: parts.index("")].sum())) : at + 1].tolist())
        if np.array_equal(np.fromiter(chain.from_iterable(theirs), np.int64), ids):
            if np.array_equal(np.fromiter(map(len, theirs), np.int64), counts):
                return
        ends = np.cumsum(counts)
        for part, end, n, other in zip(parts, ends, counts, theirs):
            if (own := ids[end - n : end].tolist()) != other:
                raise ValueError(f"{part[:100]!r}: ids {own[:50]}, the sentencepiece library has {other[:50]}")

    def long_agendas(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        symbols = [self.agenda(p) for p in parts]
        return np.array([x for s in symbols for x in s], np.int64), np.array([len(s) for s in symbols])

    def encode_batch(self, batch: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text, between the begin and the end id."""
        split = [self.parts(t) for t in batch]
        self.learn(set().union(*split) if split else set())
        begin, end = (np.array([i], "<u4").tobytes() for i in (self.begin, self.end))
        look = self.memo.__getitem__
        return [begin + b"".join(map(look, p)) + end for p in split]

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 of what the ids spell; the encoder's own mark of white space is taken off again."""
        found = np.frombuffer(ids, "<u4").tolist()
        spelt = b"".join(map(self.surface.__getitem__, found))
        return spelt.removeprefix(b" ").decode("utf-8", "replace").encode()


@lru_cache(maxsize=2)
def codec(path: str) -> PieceCodec:
    """One codec for each worker process and model file."""
    return PieceCodec(path)


def encode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit, with begin and end id), n_tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for whole in batches:
            for batch in slices(whole, 1, BATCH_BYTES):
                ids = own.encode_batch(texts(batch.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(ids, pa.binary()), pa.array([len(i) // 4 for i in ids], pa.int64())],
                    ["doc_id", "ids", "n_tokens"],
                )

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """The encoded rows with a column `decoded`, the text that the ids spell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            spelt = [None if ids is None else own.decode(ids).decode() for ids in batch.column("ids").to_pylist()]
            columns = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(spelt, pa.string())], [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, f"{ENCODED}, decoded string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    coded = decode(encode(table(spark, sf_dir, "documents"), model), model)
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
