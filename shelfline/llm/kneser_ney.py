"""Quality classifier: interpolated modified Kneser-Ney n-grams of characters (operator 2).

A model is trained on trusted text: documents labelled of good quality and not toxic. Each language with at least
`LEAST_OWN` of them has its own, and one more is trained on all of those for texts of other languages. The units are characters, so a word that was never
seen costs little if it is spelt like the language and much if it isn't. A character is its code point's remainder by `CODES`:
every script below U+0FFD has a code per character, and those of a larger one (Han, Hangul) are spread over all codes, some
five on each, so no alphabet is chosen and none is rare.

1.  All trusted documents are used: four fifths of them train the model, the others give the limits (5). A caller may bound
    them per language (`most`, those of the smallest hash of doc_id); the queries don't.
2.  n-grams are counted in each task, then summed. Continuation counts of each lower order, discounts and back-off
    weights are aggregations and joins of those counts.
3.  The result is sharded by language and order, and each shard into files of some `PART` n-grams in the shared folder
    (spark.checkpoint.dir), which tasks write: sorted keys, log probabilities and the log back-off weights of their contexts.
    The driver gets the names of the files only, and an order may have any number of n-grams.
4.  Each task maps the files that its texts need into memory and looks their n-grams up, sorted, in the shard of their
    language, highest order first, what isn't found going down an order with the back-off weight of its context. That
    gives a text's perplexity; no text is moved. Mapped files belong to the machine's cache, not to the worker; from a folder
    that isn't mounted (hdfs, s3 and what else pyarrow opens) they are read, and a task holds those it has read.
5.  A text is kept up to the perplexity that `QUANTILE` of the trusted documents of its language stay below, times `SLACK`.
    Only documents that the model wasn't trained on count for that: the fifth that is kept out (with `most`, those beyond it). A language with few trusted documents isn't trained on and has a limit of its own as well.

Null and empty texts have no perplexity and aren't kept. A null or unknown language uses the model of all. Without
trusted documents, or with a single trusted text, there is nothing to go by, and every text with characters is kept. Repeated rows are decided alike.
Labels may repeat: a document is trusted if all of its labels say so. Texts may be of any length: they are scored
in pieces. No documents: no rows. Other columns of the input are passed on (`keep_fluent`) or not read (`perplexities`).
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from shelfline.llm.common import scratch, slices, stored, table

ORDER = 5
#: Fewest trusted documents of a language that has a model of its own.
LEAST_OWN = 30
#: One part in so many of the sample gives limits and isn't trained on.
HELD_OUT = 5
#: n-grams in a file of the model, about.
PART = 1 << 18
#: A prime. Codes of characters are 1 to CODES; five of them, and the edge, fit in the 60 bits of a key.
CODES = 4093
BITS = 12
LANGUAGES = 200
QUANTILE, SLACK = 0.99, 1.25
BATCH_BYTES = 4 << 20
PIECE = 1 << 18

#: The model of all languages.
ANY = ""
EDGE = 0
#: The chance of each code before anything is counted, the edge included.
EVEN = 1 / (CODES + 1)


def coded(text: str) -> np.ndarray:
    """A text as small numbers, between edges: ORDER - 1 before it, one after it."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.pad((points % CODES + 1).astype(np.uint16), (ORDER - 1, 1), constant_values=EDGE)


def grams(symbols: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The n-gram that ends at each symbol from the ORDER-th one on, `BITS` per symbol, the last one lowest."""
    out = np.zeros(len(symbols) - ORDER + 1, np.int64)
    for i in range(ORDER - order, ORDER):
        out = out << BITS | symbols[i : len(symbols) - ORDER + 1 + i]
    return out


# Training ------------------------------------------------------------------------------------------------


def trusted(labels: DataFrame) -> DataFrame:
    """The doc_ids whose labels all say good and not toxic."""
    good = labels.groupBy("doc_id").agg(F.min((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good"))
    return good.filter("good").select("doc_id")


def sample(docs: DataFrame, good: DataFrame, most: int | None = None) -> DataFrame:
    """(doc_id, named, lang, text) of the trusted documents, or of at most `most` per language, and once more for the model of all.

    With `most` they are chosen by a hash of their ids, before any text moves. Only the `LANGUAGES` most frequent languages
    are told apart (`named`), so the ids that are broadcast then are at most `most` for each of those and the rest. Those
    with fewer than `LEAST_OWN` trusted documents are in the model of all only.
    """
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(ANY))
    named = docs.filter(F.length(F.col("text").cast("string")) > 0).select("doc_id", lang.alias("lang"))
    known = named.join(good, "doc_id").groupBy("doc_id").agg(F.min("lang").alias("lang"))
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    found = {r["lang"]: r["n"] for r in counts.collect()}
    own = [lang for lang, n in found.items() if n >= LEAST_OWN and lang != ANY]
    known = known.select("doc_id", F.when(F.col("lang").isin(list(found)), F.col("lang")).otherwise(ANY).alias("named"))
    order = Window.partitionBy("named").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = known
    if most is not None:
        ids = F.broadcast(known.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= most).select("doc_id", "named"))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter("text <> ''")
    chosen = texts.join(ids, "doc_id").groupBy("doc_id", "named").agg(F.min("text").alias("text"))
    chosen = stored(chosen, "sample")
    alone = chosen.filter(F.col("named").isin(own)).withColumn("lang", F.col("named"))
    return alone.unionByName(chosen.withColumn("lang", F.lit(ANY)))


def counted(texts: DataFrame) -> DataFrame:
    """(lang, gram, c): how often each n-gram of the highest order occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1, BATCH_BYTES):
                by: dict[str, list[np.ndarray]] = {}
                for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    by.setdefault(lang, []).append(grams(coded(text)))
                for lang, parts in by.items():
                    found, n = np.unique(np.concatenate(parts), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(found), pa.string()), pa.array(found), pa.array(n.astype(np.int64))],
                        ["lang", "gram", "c"],
                    )

    found = texts.select("lang", "text").mapInArrow(run, "lang string, gram bigint, c bigint")
    return found.groupBy("lang", "gram").agg(F.sum("c").alias("c"))


def weighed(counts: DataFrame) -> DataFrame:
    """Counts of one order with the totals, discounts and back-off weight of their contexts."""
    of = [F.sum(F.when(F.col("c") == k, 1).otherwise(0)).cast("double").alias(f"n{k}") for k in (1, 2, 3, 4)]
    n1, n2, n3, n4 = (F.col(f"n{k}") for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)

    def discount(k: int, this, following):
        # Without such counts there is nothing to estimate from; three quarters is what texts tend to give.
        held = F.when((this > 0) & (n1 > 0), k - (k + 1) * y * following / F.when(this > 0, this)).otherwise(0.75)
        return F.least(F.greatest(held, F.lit(0.1)), F.lit(k - 0.05))

    discounts = counts.groupBy("lang").agg(*of).select(
        "lang", discount(1, n1, n2).alias("d1"), discount(2, n2, n3).alias("d2"), discount(3, n3, n4).alias("d3")
    )
    d = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
    rows = counts.join(discounts, "lang").withColumns({"d": d, "context": F.shiftright("gram", BITS)})
    contexts = rows.groupBy("lang", "context").agg(F.sum("c").alias("total"), F.sum("d").alias("held"))
    return rows.join(contexts, ["lang", "context"]).select(
        "lang",
        "gram",
        "context",
        ((F.col("c") - F.col("d")) / F.col("total")).alias("own"),
        (F.col("held") / F.col("total")).alias("backoff"),
    )


def estimated(counts: DataFrame) -> list[DataFrame]:
    """Per order from 1: (lang, gram, p, backoff), interpolated down to equal chances for all symbols."""
    orders = [counts]
    for order in range(ORDER - 1, 0, -1):
        shorter = F.col("gram").bitwiseAND(F.lit((1 << BITS * order) - 1).cast("bigint")).alias("gram")
        orders.append(orders[-1].select("lang", shorter).groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("c")))
    out: list[DataFrame] = []
    for order, found in enumerate(reversed(orders), 1):
        rows = weighed(found)
        if not out:
            lower = F.lit(EVEN)
        else:
            below = out[-1].select("lang", F.col("gram").alias("shorter"), F.col("p").alias("lower"))
            mask = F.lit((1 << BITS * (order - 1)) - 1).cast("bigint")
            rows = rows.withColumn("shorter", F.col("gram").bitwiseAND(mask)).join(below, ["lang", "shorter"])
            lower = F.col("lower")
        p = F.col("own") + F.col("backoff") * lower
        rows = rows.select("lang", "gram", "backoff", p.alias("p"))
        out.append(stored(rows, f"order-{order}") if order < ORDER else rows)
    return out


#: A file of a shard: the context of its first n-gram, where it is, and how many n-grams it has.
Part = tuple[int, str, int]


def written(rows: DataFrame, n: int, name: str) -> dict[str, list[Part]]:
    """Per language the files of one order's n-grams, about `n` in all; a context's n-grams are in one file."""
    folder = scratch(rows.sparkSession, name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[pa.RecordBatch]] = {}
        for batch in batches:
            lang = batch.column(0).dictionary_encode()
            which = lang.indices.to_numpy()
            for i, one in enumerate(lang.dictionary.to_pylist()):
                first, last = np.flatnonzero(which == i)[[0, -1]]
                held.setdefault(one, []).append(batch.slice(first, last - first + 1))
        for one, parts in held.items():
            gram, p, backoff = (np.concatenate([part.column(c).to_numpy() for part in parts]) for c in ("gram", "p", "backoff"))
            store, path = fs.FileSystem.from_uri(folder)
            store.create_dir(path, recursive=True)
            file = f"{uuid.uuid4().hex}.bin"  # a task that runs again writes another one
            with store.open_output_stream(f"{path}/{file}") as out:
                for column in (gram.astype("<i8"), np.log10(p).astype("<f8"), np.log10(backoff).astype("<f8")):
                    out.write(column.tobytes())
            yield pa.RecordBatch.from_pylist([{"lang": one, "first": int(gram[0]) >> BITS, "path": f"{folder}/{file}", "n": len(gram)}])

    dealt = rows.repartitionByRange(math.ceil(n / PART), "lang", F.shiftright("gram", BITS)).sortWithinPartitions("lang", "gram")
    files = dealt.select("lang", "gram", "p", "backoff").mapInArrow(run, "lang string, first bigint, path string, n bigint")
    out: dict[str, list[Part]] = {}
    for r in files.collect():
        out.setdefault(r["lang"], []).append((r["first"], r["path"], r["n"]))
    return {lang: sorted(parts) for lang, parts in out.items()}


@dataclass(frozen=True)
class Model:
    """The files of each (language, order), by the contexts they start with. They are opened where they are needed."""

    shards: dict[tuple[str, int], list[Part]]
    opened: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict, repr=False, compare=False)

    def __getstate__(self) -> dict:
        return {"shards": self.shards, "opened": {}}

    def own(self, lang: str | None) -> str:
        """The language whose model judges texts of this one."""
        return lang if (lang, ORDER) in self.shards else ANY

    def log10(self, lang: str | None, text: str) -> tuple[float, int]:
        """log10 probability of a text, and how many symbols that covers (its end is one)."""
        return self.log10s(lang, [text])[0]

    def log10s(self, lang: str | None, texts: list[str]) -> list[tuple[float, int]]:
        """`log10` of several texts of one language. A text's figure doesn't depend on the others."""
        lang, totals, sizes = self.own(lang), [0.0] * len(texts), [0] * len(texts)
        held: list[tuple[int, np.ndarray]] = []

        def add() -> None:
            sums = np.split(self._logs(lang, np.concatenate([g for _, g in held])), np.cumsum([len(g) for _, g in held])[:-1])
            for (i, _), logs in zip(held, sums):
                totals[i] += float(logs.sum())
            held.clear()

        room = PIECE
        for i, text in enumerate(texts):
            symbols = coded(text)
            sizes[i] = len(symbols) - ORDER + 1
            for at in range(0, sizes[i], PIECE):
                held.append((i, grams(symbols[at : at + PIECE + ORDER - 1])))
                room -= len(held[-1][1])
                if room <= 0:
                    add()
                    room = PIECE
        if held:
            add()
        return list(zip(totals, sizes))

    def _logs(self, lang: str, full: np.ndarray) -> np.ndarray:
        """log10 of the chance of each n-gram's last symbol after the others."""
        out, left = np.zeros(len(full)), np.arange(len(full))
        for order in range(ORDER, 0, -1):
            wanted = full[left] & ((1 << BITS * order) - 1)
            by = np.argsort(wanted)
            left = left[by]
            found, logs = self._find(lang, order, wanted[by])
            out[left] += logs
            left = left[~found]
            if not len(left):
                return out
        out[left] += np.log10(EVEN)
        return out

    def _find(self, lang: str, order: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether the shard has each n-gram (sorted), and its log probability or else the log weight of its context."""
        parts, context = self.shards[lang, order], wanted >> BITS
        found, logs = np.zeros(len(wanted), bool), np.zeros(len(wanted))
        cuts = [0, *np.searchsorted(context, [first for first, _, _ in parts[1:]]).tolist(), len(wanted)]
        for (_, path, n), a, b in zip(parts, cuts, cuts[1:]):
            if a == b:
                continue
            keys, p, backoff = self._open(path, n)
            # n-grams of a context are neighbours, so where one would stand there is another before or after it.
            after = np.searchsorted(keys, wanted[a:b])
            before, after = np.maximum(after - 1, 0), np.minimum(after, n - 1)
            found[a:b] = hit = keys[after] == wanted[a:b]
            weight = np.where(keys[before] >> BITS == context[a:b], backoff[before], 0.0)
            weight = np.where(keys[after] >> BITS == context[a:b], backoff[after], weight)
            logs[a:b] = np.where(hit, p[after], weight)
        return found, logs

    def _open(self, path: str, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if path not in self.opened:
            store, at = fs.FileSystem.from_uri(path)
            if isinstance(store, fs.LocalFileSystem):
                data = np.memmap(at, np.uint8, "r")
            else:
                with store.open_input_stream(at) as file:
                    data = np.frombuffer(file.read(), np.uint8)
            keys, p, backoff = np.split(np.asarray(data), 3)
            self.opened[path] = keys.view("<i8"), p.view("<f8"), backoff.view("<f8")
        return self.opened[path]


def train(texts: DataFrame) -> Model | None:
    """The model of sampled texts (lang, text); None if there are none."""
    if texts.isEmpty():
        return None
    shards = {}
    counts = stored(counted(texts), "counts")
    for order, rows in enumerate(estimated(counts), 1):
        n = (counts if order == ORDER else rows).count()
        shards |= {(lang, order): parts for lang, parts in written(rows, n, f"model-{order}").items()}
    return Model(shards)


# Scoring -------------------------------------------------------------------------------------------------


def scored(docs: DataFrame, model: Model | None, into: str = "perplexity") -> DataFrame:
    """The rows with their perplexity, null for texts without characters."""
    if model is None:
        return docs.withColumn(into, F.lit(None).cast("double"))
    rows = docs.withColumn("text", F.col("text").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, whole.schema.get_field_index("text"), BATCH_BYTES):
                out: list[float | None] = [None] * batch.num_rows
                texts, by = batch.column("text").to_pylist(), {}
                for i, lang in enumerate(batch.column("lang").to_pylist()):
                    if texts[i]:
                        by.setdefault(model.own(lang), []).append(i)
                for lang, rows_of in by.items():
                    for i, (total, n) in zip(rows_of, model.log10s(lang, [texts[i] for i in rows_of])):
                        out[i] = 10 ** (-total / n)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], [*batch.schema.names, into])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(into, T.DoubleType())]))


def divided(texts: DataFrame, parts: int = HELD_OUT) -> tuple[DataFrame, DataFrame]:
    """The sampled texts that the model is trained on, and those it isn't, which give the limits.

    One part in `parts` is kept out, by a hash of the text, so equal texts are on the same side. Where some languages have
    models of their own, the few texts of the others are kept out as well: the model of all judges them unseen.
    """
    own = [r["lang"] for r in texts.select("lang").distinct().collect() if r["lang"] != ANY]
    out = F.pmod(F.xxhash64("text"), F.lit(parts)) == 0
    if own:
        out = out | ~F.col("named").isin(own)
    return texts.filter(~out), texts.filter(out)


def limits(
    seen: DataFrame,
    good: DataFrame,
    texts: DataFrame,
    unseen: DataFrame,
    model: Model,
    quantile: float = QUANTILE,
    slack: float = SLACK,
) -> dict[str, float]:
    """Per language the highest perplexity that is kept, from (doc_id, lang, perplexity) of all documents, the sample, and
    its part that the model wasn't trained on.

    It is a quantile of perplexities of trusted documents that the model hasn't seen, times a slack: of those
    beyond the sample if they are many enough, otherwise of the part of the sample that was kept out. Where a
    language has too few for a model of its own, a quantile of them says little: their median under the model of all
    is taken as well, with the widest spread between median and quantile that other languages have.
    """
    own = sorted({k for k, _ in model.shards} - {ANY})
    many = [F.count(F.lit(1)).alias("n"), F.percentile_approx("perplexity", [quantile, 0.5], 10_000).alias("p")]
    kept_out = scored(unseen.select("lang", "named", "text"), model).select("lang", "named", "perplexity")
    kept_out = stored(kept_out, "kept-out")
    fresh = seen.filter(F.col("lang").isin(own)).join(good, "doc_id")
    fresh = fresh.join(texts.select("doc_id").distinct(), "doc_id", "left_anti")
    by = {r["lang"]: r["p"] for r in kept_out.groupBy("lang").agg(*many).collect()}
    by |= {r["lang"]: r["p"] for r in fresh.groupBy("lang").agg(*many).collect() if r["n"] >= LEAST_OWN}
    if ANY not in by:
        return {}
    spread = max(by[k][0] / by[k][1] for k in ([k for k in own if k in by] or [ANY]))
    few = kept_out.filter((F.col("lang") == ANY) & ~F.col("named").isin([ANY, *own])).groupBy("named").agg(*many).collect()
    by |= {r["named"]: [max(r["p"][0], r["p"][1] * spread, by[ANY][0])] for r in few}
    return {k: p[0] * slack for k, p in by.items()}


def fit(docs: DataFrame, labels: DataFrame, most: int | None = None) -> tuple[Model | None, DataFrame, dict[str, float]]:
    """The model, the perplexity of every document under it, and the limits that follow."""
    good = trusted(labels)
    texts = sample(docs, good, most)
    learnt, unseen = divided(texts)
    model = train(learnt)
    rows = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    seen = stored(scored(rows, model).select("doc_id", "lang", "perplexity", (F.length("text") > 0).alias("any")), "perplexity")
    return model, seen, {} if model is None else limits(seen, good, texts, unseen, model)


def _kept(limit: dict[str, float], perplexity: str, any_text: Column) -> Column:
    if not limit:
        return F.coalesce(any_text, F.lit(False))
    bound = F.lit(limit[ANY])
    for one, most in sorted(limit.items()):
        bound = F.when(F.col("lang") == one, most).otherwise(bound)
    return F.coalesce(F.col(perplexity) <= bound, F.lit(False))


def perplexities(docs: DataFrame, labels: DataFrame, most: int | None = None) -> DataFrame:
    """doc_id, lang, perplexity and kept."""
    _, seen, limit = fit(docs, labels, most)
    return seen.select("doc_id", "lang", "perplexity", _kept(limit, "perplexity", F.col("any")).alias("kept"))


def keep_fluent(docs: DataFrame, labels: DataFrame, most: int | None = None) -> DataFrame:
    """The rows of documents that are kept, with all their columns and nothing else. Texts are scored twice, not moved."""
    model, _, limit = fit(docs, labels, most)
    mark = "_perplexity_of_text"
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    seen = scored(docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").alias("text"), whole), model, mark)
    return seen.filter(_kept(limit, mark, F.length("text") > 0)).select(*(F.col("row")[c].alias(c) for c in docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexities(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
