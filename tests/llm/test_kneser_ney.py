"""Operator 2: probabilities against a plain recursive version, verdicts against labels."""

from __future__ import annotations

import math
import pickle
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from shelfline.llm import kneser_ney as kn
from tests.conftest import SF_DIR


def brute(texts: list[str]):
    """p(symbol | context) as the recursion says, over tuples of characters ("" stands for the edge)."""
    count = [Counter() for _ in range(kn.ORDER + 1)]
    for t in texts:
        s = [""] * (kn.ORDER - 1) + list(t) + [""]
        count[kn.ORDER].update(tuple(s[i - kn.ORDER + 1 : i + 1]) for i in range(kn.ORDER - 1, len(s)))
    for k in range(kn.ORDER - 1, 0, -1):
        count[k].update(g[1:] for g in count[k + 1])
    discounts, totals = [None], [None]
    for k in range(1, kn.ORDER + 1):
        n = Counter(count[k].values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
        ds = []
        for i in (1, 2, 3):
            d = i - (i + 1) * y * n[i + 1] / n[i] if n[i] and n[1] else 0.75
            ds.append(min(max(d, 0.1), i - 0.05))
        discounts.append(ds)
        total = defaultdict(lambda: [0, 0.0])
        for g, c in count[k].items():
            total[g[:-1]][0] += c
            total[g[:-1]][1] += ds[min(c, 3) - 1]
        totals.append(total)

    def p(gram: tuple) -> float:
        k = len(gram)
        if not k:
            return 1 / (kn.CODES + 1)
        lower = p(gram[1:])
        if gram[:-1] not in totals[k]:
            return lower
        total, held = totals[k][gram[:-1]]
        c = count[k][gram]
        return (c - discounts[k][min(c, 3) - 1] if c else 0) / total + held / total * lower

    return p


def test_probabilities(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcab é") for _ in range(rng.randrange(1, 60))) for _ in range(80)]
    rows = [("xx", t) for t in texts[:50]] + [("yy", t) for t in texts[50:]]
    both = rows + [(kn.ANY, t) for t in texts]
    model = kn.train(spark.createDataFrame(both, "lang string, text string"))
    for lang, known in (("xx", texts[:50]), ("yy", texts[50:]), ("??", texts), (None, texts)):
        p = brute(known)
        for t in ["abca", "", "é é", "zzz", "bbbbbbb", *known[:5]]:
            s = [""] * (kn.ORDER - 1) + list(t) + [""]
            expected = sum(math.log10(p(tuple(s[i - kn.ORDER + 1 : i + 1]))) for i in range(kn.ORDER - 1, len(s)))
            total, n = model.log10(lang, t)
            assert n == len(t) + 1 and total == pytest.approx(expected)


def test_long_texts_are_scored_in_pieces(spark, monkeypatch):
    model = kn.train(spark.createDataFrame([(kn.ANY, "abracadabra " * 20)], "lang string, text string"))
    text = "abra cadabra " * 300
    whole = model.log10(kn.ANY, text)
    monkeypatch.setattr(kn, "PIECE", 7)
    assert model.log10(kn.ANY, text) == (pytest.approx(whole[0]), whole[1])


def test_nulls_repeats_empty_tables_and_clashing_columns(spark):
    rng = random.Random(6)
    good = [(i, " ".join(rng.choice("the cat sat on a mat and ran to hats".split()) for _ in range(20)), "en") for i in range(30)]
    rows = good + [(100, None, "en"), (101, "", None)] + [(102, "the cat sat on a mat and ran to hats", None)] * 2
    rows += [(103, "#### %%%% @@@@ ^^^^", "en"), (None, "the cat ran on a mat and sat", "xx")]
    docs = spark.createDataFrame([(*r, 1.5, "x") for r in rows], "doc_id bigint, text string, lang string, perplexity double, row string")
    labels = spark.createDataFrame(
        [(i, 1, 0) for i in range(30)] + [(103, 1, 0), (103, 0, 0), (None, 1, 0), (5, None, 0)], "doc_id bigint, quality int, toxic int"
    )
    got = kn.keep_fluent(docs, labels)
    assert got.columns == docs.columns
    kept = Counter(r.doc_id for r in got.collect())
    assert kept[102] == 2 and kept[None] == 1 and not kept[100] and not kept[101] and not kept[103]
    assert all(kept[i] == 1 for i in range(30))
    shown = kn.perplexities(docs, labels)
    assert Counter(r.doc_id for r in shown.filter("kept").collect()) == kept and shown.count() == len(rows)
    assert kn.keep_fluent(docs.limit(0), labels).count() == 0
    assert Counter(r.doc_id for r in kn.keep_fluent(docs, labels.limit(0)).collect())[103] == 1


def test_sample_is_bounded_per_language(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    good = kn.trusted(spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    n = {r.lang: r["count"] for r in kn.sample(docs.union(docs), good, 7).groupBy("lang").count().collect()}
    assert n == {"en": 7, "de": 7, "fr": 7, "es": 7, kn.ANY: 28}


def test_verdicts_follow_the_labels(spark):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").toPandas().set_index("doc_id")
    got = kn.query(spark, SF_DIR).toPandas().set_index("doc_id")
    assert len(got) == 1000
    both = got.join(labels, how="inner")
    assert both[both.quality == 1].kept.mean() >= 0.985
    assert both[both.quality == 0].kept.mean() <= 0.25
    assert np.isfinite(got.perplexity.dropna()).all()


@pytest.mark.parametrize("n", [1, 5, 20, 40])
def test_clean_texts_of_small_languages_are_kept(spark, n):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("lang IN ('de', 'en')")
    good = kn.trusted(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"))
    clean = docs.join(good, "doc_id").filter("length(text) BETWEEN 200 AND 5000").orderBy("lang", "doc_id").toPandas()
    de, en = clean[clean.lang == "de"], clean[clean.lang == "en"][:100]
    rng = random.Random(n)
    salad = [(-i, "de", "".join(rng.choices("abcdefghijklmnopqrstuvwxyzäöü .,;#%", k=400))) for i in range(1, 11)]
    known, held = [*de[:n].doc_id, *en.doc_id], de[100:200]
    rows = [(r.doc_id, r.lang, r.text) for part in (de[:n], en, held) for r in part.itertuples()] + salad
    frame = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    labels = spark.createDataFrame([(int(i), 1, 0) for i in known], "doc_id bigint, quality int, toxic int")
    kept = {r.doc_id for r in kn.perplexities(frame, labels).filter("kept").collect()}
    assert len(held) == 100 and len(kept & set(held.doc_id)) >= 90
    assert not kept & {i for i, *_ in salad}


def test_a_salad_of_rare_characters_is_rejected(spark):
    """2,500 Han characters, so none is frequent: words of two of them are fluent, single ones in any order are not."""
    rng = random.Random(3)
    chars = [chr(0x4E00 + 7 * i) for i in range(2500)]
    words = ["".join(rng.sample(chars, 2)) for _ in range(800)]
    weights = [1 / (i + 1) for i in range(800)]
    fluent = ["".join(rng.choices(words, weights, k=120)) for _ in range(140)]
    salad = ["".join(rng.choices(chars, k=240)) for _ in range(50)]
    rows = [(i, "zh", t) for i, t in enumerate(fluent)] + [(1000 + i, "zh", t) for i, t in enumerate(salad)]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(90)], "doc_id bigint, quality int, toxic int")
    kept = {r.doc_id for r in kn.perplexities(docs, labels).filter("kept").collect()}
    assert not {i for i in kept if i >= 1000}
    assert len(kept & set(range(90, 140))) >= 45


def test_codes_tell_the_characters_of_a_script_apart():
    for first, last in ((0x20, 0x24F), (0x370, 0x5FF), (0x600, 0xDFF), (0x4E00, 0x4E00 + kn.CODES - 1)):
        codes = kn.coded("".join(map(chr, range(first, last + 1))))[kn.ORDER - 1 : -1]
        assert len(set(codes.tolist())) == last - first + 1 and kn.EDGE not in codes
    assert int(kn.grams(np.full(kn.ORDER, kn.CODES, np.uint16))[0]) < 1 << 60


def test_every_trusted_document_is_used(spark):
    docs = spark.range(1500).selectExpr("id AS doc_id", "concat('text ', id) AS text", "'en' AS lang")
    texts = kn.sample(docs, docs.select("doc_id"))
    assert texts.filter("lang = 'en'").count() == 1500
    learnt, unseen = kn.divided(texts)
    assert learnt.count() + unseen.count() == 3000


def test_the_model_stays_out_of_the_driver(spark, monkeypatch):
    """Any number of n-grams in files of the shared folder; what the driver and the tasks' closures hold are their names."""
    monkeypatch.setattr(kn, "MAX_ENTRIES", 1000, raising=False)
    monkeypatch.setattr(kn, "PART", 2000, raising=False)
    rng = random.Random(4)
    texts = ["".join(rng.choices("abcdefgh é", k=200)) for _ in range(100)]
    rows = [("xx", t) for t in texts] + [(kn.ANY, t) for t in texts]
    model = kn.train(spark.createDataFrame(rows, "lang string, text string"))
    p, unseen = brute(texts), ["abca", "hhhh é", "zzz abc", "".join(rng.choices("abcdefgh é", k=300))]
    for lang in ("xx", "??"):
        assert sum(n for _, _, n in model.shards[model.own(lang), kn.ORDER]) > 10_000 and len(model.shards[model.own(lang), kn.ORDER]) > 3
        for t in [*unseen, *texts[:3]]:
            s = [""] * (kn.ORDER - 1) + list(t) + [""]
            expected = sum(math.log10(p(tuple(s[i - kn.ORDER + 1 : i + 1]))) for i in range(kn.ORDER - 1, len(s)))
            assert model.log10(lang, t) == (pytest.approx(expected), len(t) + 1)
    assert model.log10s("xx", [*unseen, *texts]) == [model.log10("xx", t) for t in [*unseen, *texts]]
    assert len(pickle.dumps(model)) < 10_000
