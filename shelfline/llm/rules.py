"""Quality rules by weak supervision (operator 5), in DataFrame functions only.

Each rule looks at a text and votes good (1) or bad (-1), or abstains (0). Nobody says how far a rule can be trusted:
expectation-maximisation finds, from how often the votes agree, how accurate each rule is on good and on bad texts, and
the share of good texts. The votes of a text, weighted by the log odds that those rates give, make the posterior
probability that it is good; the text is kept from `KEEP` on, unless the base checks failed.

What EM needs is the number of texts per vote pattern: at most 3 ** len(RULES) rows, whatever the input. They are
counted over all documents in one aggregation, and are all that reaches the driver.

Null text: no words, base_failed. Texts without words as well. A repeated row is a document of its own, decided
alike. Texts may be of any length: a row's arrays are the largest thing in memory. No documents: no rows, and EM keeps
its start values. Other columns of the input are passed on (`keep_good`) or not read (`judge`).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfline.llm.common import WHITE, stored, table

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # per cent of the words
KEEP = 0.5
ROUNDS = 200
#: Start of EM: share of good texts; how good and bad ones are voted on (abstention, good, bad); weight of all this in texts.
START_PRIOR, START_RATES, SMOOTH = 0.9, ((0.5, 0.48, 0.02), (0.5, 0.1, 0.4)), 2.0
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Frequent function words of the four languages of the corpus.
FUNCTION_WORDS = (
    "the of and to a in is that it for was with as be by this are "
    "der die und das den von zu mit ist nicht ein eine für auf des im "
    "le la les de des et en que un une est pour dans par qui du "
    "el los las y se por con para una del al es no"
).split()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once: lambda functions that name it don't compute it again."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))


def _windows(words: Column) -> Column:
    """A hash of each run of `WINDOW` words."""
    n = F.size(words)
    starts = F.when(n > WINDOW, F.sequence(F.lit(1), n - (WINDOW - 1))).otherwise(F.array().cast("array<int>"))
    return let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda hashes: F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i, WINDOW))),
    )


def _covered(windows: Column) -> Column:
    """How many words lie in windows that occur twice or more."""

    def repeated(pairs: Column) -> Column:
        same = lambda p, k: (F.get(pairs, k)["h"] == p["h"])
        marked = F.transform(
            pairs,
            lambda p, k: F.when(F.coalesce(same(p, k - 1), F.lit(False)) | F.coalesce(same(p, k + 1), F.lit(False)), p["i"]),
        )
        return F.sort_array(F.filter(marked, lambda i: i.isNotNull()))

    def reach(starts: Column) -> Column:
        each = F.transform(starts, lambda s, k: F.coalesce(F.least(F.get(starts, k + 1) - s, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(each, F.lit(0).cast("bigint"), lambda n, x: n + x)

    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return let(let(pairs, repeated), reach)


def _counts(text: Column) -> Column:
    """Everything that the rules look at, as one struct."""

    def of(words: Column) -> Column:
        windows = let(
            _windows(words),
            lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), _covered(w)).otherwise(F.lit(0).cast("bigint")),
        )
        lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")
        dup = let(lines, lambda x: F.struct(F.size(x).alias("lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.length(_without(text, WHITE)).cast("bigint").alias("word_chars"),
            (F.length(text) - F.length(_without(text, SYMBOLS))).cast("bigint").alias("n_symbols"),
            dup.alias("lines"),
            windows.alias("n_repeat_words"),
            (F.length(text) - F.length(_without(text, UPPER))).cast("bigint").alias("n_upper"),
            F.size(F.array_intersect(words, F.array(*map(F.lit, FUNCTION_WORDS)))).cast("bigint").alias("n_function"),
            F.size(F.array_distinct(words)).cast("bigint").alias("n_distinct"),
        )

    return let(_words(text), of)


def measured(docs: DataFrame, into: str = "_m") -> DataFrame:
    """The documents with a struct column of their counts."""
    return docs.withColumn(into, _counts(F.coalesce(F.col("text").cast("string"), F.lit(""))))


def _vote(bad: Column, good: Column | None) -> Column:
    vote = F.when(bad, -1)
    return (vote if good is None else vote.when(good, 1)).otherwise(0).cast("tinyint")


#: Rule name: (votes bad, votes good), of the struct of counts. In neither case it abstains; most only ever find faults.
RULES: dict[str, Callable[[Column], tuple[Column, Column | None]]] = {
    "length": lambda m: (m["n_words"] < LEAST_WORDS, m["n_words"] >= LEAST_WORDS),
    "symbols": lambda m: (10 * m["n_symbols"] > m["n_words"], None),
    "lines": lambda m: ((m["lines"]["dup"] > 2) & (10 * m["lines"]["dup"] > 3 * m["lines"]["lines"]), None),
    "repeats": lambda m: (5 * m["n_repeat_words"] > m["n_words"], None),
    "capitals": lambda m: (10 * m["n_upper"] > 3 * m["word_chars"], None),
    "function_words": lambda m: (
        (m["n_words"] >= LEAST_WORDS) & (m["n_function"] < 2),
        (m["n_function"] >= 4) | ((m["n_words"] < 60) & (m["n_function"] >= 2)),
    ),
    "variety": lambda m: ((m["n_words"] >= LEAST_WORDS) & (5 * m["n_distinct"] < m["n_words"]), None),
    "word_length": lambda m: (
        (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 12 * m["n_words"]),
        (m["word_chars"] >= 3 * m["n_words"]) & (m["word_chars"] <= 9 * m["n_words"]),
    ),
}


def votes(m: Column) -> list[Column]:
    return [_vote(*rule(m)).alias(name) for name, rule in RULES.items()]


#: Per rule, for good and for bad texts: how often it abstains, votes good, votes bad (the place of a vote v is v).
Rates = list[list[float]]


def fit(patterns: Sequence[tuple[Sequence[int], int]], rounds: int = ROUNDS) -> tuple[float, list[Rates]]:
    """Share of good texts and the accuracy of each rule, by EM over vote patterns and their counts.

    Good and bad texts have rates of their own: nearly all texts are good, so a rule that hardly ever cries wolf
    says much when it does. Every sum starts with `SMOOTH` texts that vote as the start values say.
    """
    total = sum(n for _, n in patterns)
    prior, rates = START_PRIOR, [[list(r) for r in START_RATES] for _ in RULES]
    for _ in range(rounds):
        good = SMOOTH * START_PRIOR
        sums = [[[SMOOTH * x for x in r] for r in START_RATES] for _ in RULES]
        for pattern, n in patterns:
            p = posterior(pattern, prior, rates)
            good += n * p
            for j, v in enumerate(pattern):
                sums[j][0][v] += n * p
                sums[j][1][v] += n * (1 - p)
        last, prior = prior, good / (total + SMOOTH)
        rates = [[[x / sum(r) for x in r] for r in pair] for pair in sums]
        if abs(prior - last) < 1e-10:
            break
    return prior, rates


def weights(rates: Rates) -> list[float]:
    """What abstention, a good and a bad vote add to the log odds that a text is good."""
    return [math.log(g / b) for g, b in zip(*rates)]


def posterior(pattern: Sequence[int], prior: float, rates: Sequence[Rates]) -> float:
    odds = math.log(prior / (1 - prior)) + sum(weights(r)[v] for v, r in zip(pattern, rates))
    return 1 / (1 + math.exp(-odds))


def fit_votes(voted: DataFrame) -> tuple[float, list[Rates]]:
    """EM over the vote columns of all rows: their patterns are counted on the cluster."""
    found = voted.groupBy(*RULES).agg(F.count(F.lit(1)).alias("n")).collect()
    return fit(sorted((tuple(r[name] for name in RULES), r["n"]) for r in found))


def _base_failed(m: Column) -> Column:
    return (m["n_words"] < LEAST_WORDS) | (100 * m["n_repeat_words"] > MOST_REPEATED * m["n_words"])


def _posterior(m: Sequence[Column], prior: float, rates: Sequence[Rates]) -> Column:
    def added(vote: Column, r: Rates) -> Column:
        none, good, bad = weights(r)
        return F.when(vote > 0, good).when(vote < 0, bad).otherwise(none)

    odds = reduce(lambda x, y: x + y, (added(v, r) for v, r in zip(m, rates)), F.lit(math.log(prior / (1 - prior))))
    return 1 / (1 + F.exp(-odds))


def judge(docs: DataFrame) -> DataFrame:
    """Counts, votes, posterior and verdict of each document."""
    seen = measured(docs.select(F.col("doc_id").cast("bigint"), "text")).select("doc_id", "_m")
    seen = stored(seen.select("doc_id", "_m", *votes(F.col("_m"))), "votes")
    prior, rates = fit_votes(seen)
    m, good = F.col("_m"), _posterior([F.col(name) for name in RULES], prior, rates)
    return seen.select(
        "doc_id",
        m["n_words"].alias("n_words"),
        m["word_chars"].alias("word_chars"),
        m["n_symbols"].alias("n_symbols"),
        m["lines"]["dup"].cast("bigint").alias("n_dup_lines"),
        m["n_repeat_words"].alias("n_repeat_words"),
        _base_failed(m).alias("base_failed"),
        (~_base_failed(m) & (good >= KEEP)).alias("kept"),
        good.alias("posterior"),
        *RULES,
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of good documents, with all their columns and nothing else. Reads the documents twice, moves none."""
    prior, rates = fit_votes(measured(docs.select("text")).select(*votes(F.col("_m"))))
    seen = measured(docs, "_verdict_of_rules")
    m = F.col("_verdict_of_rules")
    good = ~_base_failed(m) & (_posterior(votes(m), prior, rates) >= KEEP)
    return seen.filter(good).select(*(F.col(f"`{c}`") for c in docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))
