"""Operator 11 against brute force and SQL: damage, faults, least audits, chunks of any size, passes, odd rows."""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from pyspark.sql import functions as F

from shelfline.llm import repair
from tests.conftest import SF_DIR
from tests.parity import differences, oracle_connection

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
LEGAL = re.compile(r"(s?(ua)+)?$")


def faults(rows: list[tuple[str, str]]) -> list[str]:
    out, seen = [], set()
    for role, text in rows:
        left = text.encode().strip(b" \t\n\x0b\x0c\r")
        out.append("blank" if not left else "duplicate" if (role, text) in seen else "truncated" if left[-1:] not in b".!?" else "")
        seen.add((role, text))
    return out


def solved(rows: list[tuple[str, str]]) -> tuple[int, str, str]:
    """(cost, audit, repaired): all rows at once, from the last state of each prefix; whole audits are compared."""
    best = {"": (0, "", ())}

    def grown(ways: dict) -> dict:
        """With up to two messages inserted: more only lead back to the same states."""
        for _ in range(2):
            for state, (cost, audit, said) in list(ways.items()):
                role = "assistant" if state == "u" else "user"
                offered = (cost + 5, audit + "I", (*said, f"{role}:"))
                ways[role[0]] = min(ways.get(role[0], offered), offered, key=lambda w: w[:2])
        return ways

    best = grown(best)
    for (role, text), fault in zip(rows, faults(rows)):
        following: dict = {}

        def offer(state, way):
            following[state] = min(following.get(state, way), way, key=lambda w: w[:2])

        for state, (cost, audit, said) in best.items():
            offer(state, (cost + 2, audit + "D", said))
            if fault in ("blank", "duplicate"):
                continue
            cost += 5 * (fault == "truncated")
            for letter, given_role in (("K", role), ("R", "user"), ("R", "assistant")):
                if given_role and state + given_role[0] in ("s", "u", "su", "ua", "au"):
                    offer(given_role[0], (cost + (letter == "R"), audit + letter, (*said, f"{given_role}:{text}")))
        best = grown(following)
    cost, audit, said = min((best[s] for s in ("", "a") if s in best), key=lambda w: w[:2])
    return cost, audit, "\n".join(said)


def brute(conversations: list, rows: list[tuple]) -> dict:
    groups = defaultdict(list)
    for conv_id, turn, role, text in rows:
        groups[conv_id].append((turn is not None, turn or 0, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv_id in conversations:
        mine = sorted(groups[conv_id], key=lambda r: (*r[:2], r[2].encode(), r[3].encode()))
        said, turns = [r[2:] for r in mine], {r[1] for r in mine if r[0]}
        found = faults(said)
        pairs = [a[:1] + b[:1] for (a, _), (b, _) in itertools.pairwise(said)]
        cost, audit, text = solved(said)
        counts = [found.count(f) for f in ("blank", "duplicate", "truncated")]
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        out[conv_id] = (gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def run(spark, rows, chunk: int = 3, others: tuple = ()) -> dict:
    frame = spark.createDataFrame(rows, SCHEMA)
    found = repair.repaired(frame.select("conv_id").unionAll(spark.createDataFrame([(c,) for c in others], "conv_id bigint")), frame, chunk)
    got = [tuple(r) for r in found.collect()]
    assert len({r[0] for r in got}) == len(got)
    return {r[0]: r[1:] for r in got}


def talk(seed: int, n: int, conversations: int = 1) -> list[tuple]:
    rng = np.random.default_rng(seed)
    roles = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "s", ""], n)
    texts = rng.choice(["Yes.", "no", " ", "", "Why?\n", "so", "a b!", *map(str, range(n // 3))], n)
    return [(int(c), int(t), str(r), str(x)) for t, (c, r, x) in enumerate(zip(rng.integers(conversations, size=n), roles, texts))]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", ""]), st.sampled_from(["a.", "b", "", "c!", "d?", "e.", "f"])), max_size=9))
def test_search_alone_against_brute_force(rows):
    kinds = []
    for (role, _), fault in zip(rows, faults(rows)):
        initial = {"s": 0, "u": 1, "a": 2}.get(role[:1], 3)
        kinds.append({"blank": 8, "duplicate": 9}.get(fault, 2 * initial + (fault == "truncated")))
    vectors, shift = repair.backward(kinds, repair.FINAL)
    audits, _ = repair.traced(kinds, vectors, True)
    cost, audit, text = solved(rows)
    assert (shift + vectors[0][repair.NOTHING], audits[repair.NOTHING]) == (cost, audit)
    assert LEGAL.match("".join(line[0] for line in text.split("\n") if line)) or not text
    assert all(0 <= c <= 12 for v in vectors for c in v)


def test_cheapest_edits_of_all_edits():
    """The brute force itself, against every sequence of edits of short conversations."""
    for rows in itertools.product([("user", "a."), ("assistant", "b"), ("system", "c."), ("user", "")], repeat=3):
        found = []
        for letters in itertools.product(["", "I", "II"], ["K", "u", "a", "D"], ["", "I", "II"], ["K", "u", "a", "D"], ["", "I"], ["K", "u", "a", "D"], ["", "I", "II"]):
            said, audit, cost = "", "", 0
            for place, letter in enumerate(letters):
                if place % 2 == 0:
                    for _ in letter:
                        said += "a" if said.endswith("u") else "u"
                    audit, cost = audit + letter, cost + 5 * len(letter)
                    continue
                (role, _), fault = rows[place // 2], faults(list(rows))[place // 2]
                if letter != "D" and fault in ("blank", "duplicate"):
                    break
                audit += letter if letter in "KD" else "R"
                said += "" if letter == "D" else role[0] if letter == "K" else letter
                cost += 2 if letter == "D" else 5 * (fault == "truncated") + (letter != "K")
            else:
                if LEGAL.match(said):
                    found.append((cost, audit))
        assert solved(list(rows))[:2] == min(found)


@pytest.mark.parametrize("chunk", [1, 2, 7, 4096])
def test_against_brute_force_with_chunks_of_any_size(spark, chunk):
    rows = talk(chunk, 220, 9) + [(100, t, "user" if t % 2 else "assistant", f"x{t}.") for t in range(60)]
    assert run(spark, rows, chunk) == brute(sorted({r[0] for r in rows}), rows)


def test_chunks_that_never_forget_settle_in_logarithmically_many_passes(spark):
    """Blank rows hand every vector on as it is: the truth has to pass through all of 150 chunks."""
    rows = [(1, t, "tool", "") for t in range(450)] + [(1, 450, "user", "Why?"), (1, 451, "tool", "x")]
    placed = repair.placed(spark.createDataFrame(rows, SCHEMA), 3)
    chunks = repair.chunks_of(placed)
    _, passes = repair.settled(chunks)
    assert chunks.count() >= 150 and 2 <= passes <= 9
    assert run(spark, rows) == brute([1], rows)


def test_ordinary_chunks_settle_at_once(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"Word {t}.") for t in range(400)]
    chunks = repair.chunks_of(repair.placed(spark.createDataFrame(rows, SCHEMA), 20))
    assert repair.settled(chunks)[1] <= 2


def test_nulls_ties_repeated_rows_and_empty_conversations(spark):
    rows = [
        (None, None, None, None), (None, 3, "user", "a."), (None, 3, "assistant", "b."), (None, None, "user", "c"),
        (1, None, "user", "x."), (1, None, "assistant", "y."), (1, None, "user", "x."),
        (2, -(1 << 62), "user", "x."), (2, 1 << 62, "assistant", "y."), (2, 1 << 62, "assistant", "y!"),
        (3, 5, "", ""), (4, 5, "system", "s."), (5, 1, "ü", "z."),
    ] + [(6, 1, "user", "same.")] * 40
    found = run(spark, rows, others=(7, None, 1))
    assert found == brute([None, 1, 2, 3, 4, 5, 6, 7], rows)
    assert found[7] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert found[4][5:7] == (2, "D") and found[2][0] == (1 << 63) - 1


def test_a_very_long_text_and_no_rows(spark):
    long = "Ein Wort. " * 500_000
    rows = [(1, 0, "user", long), (1, 1, "assistant", long + "\n"), (1, 2, "user", " " * 1_000_000)]
    assert run(spark, rows, 4096) == brute([1], rows)
    assert run(spark, []) == {}


def test_damage_follows_the_checksum(spark):
    rows = [(c, t, r, x) for c in (None, 0, 7, -3) for t in (None, *range(60)) for r, x in [("assistant", "A b. C? d!")]]
    rows += [(9, t, None, None) for t in range(40)]
    expected = []
    for c, t, r, x in rows:
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        row = (c, t, "user" if fate == 4 else r, "" if fate == 1 else re.sub("[.!?]", "", x) if fate == 2 else x)
        expected += [row] * {0: 0, 3: 2}.get(fate, 1)
    got = [tuple(r) for r in repair.damaged(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert {3, 4, 0, 1, 2} <= {zlib.crc32(f"{c}:{t}".encode()) % 20 for c, t, _, _ in rows}


def test_other_columns_are_not_read(spark, tmp_path):
    names = ["kind", "chunk", "place", "digest", "fate", "_row", "part", "first_here", "audit", "start", "_copy"]
    plain = spark.createDataFrame(talk(5, 60, 6), SCHEMA)
    plain.write.parquet(str(tmp_path / "a" / "conversations.parquet"))
    plain.withColumns({n: F.lit("x") for n in names}).write.parquet(str(tmp_path / "b" / "conversations.parquet"))
    first, second = (sorted(map(tuple, repair.query(spark, str(tmp_path / d)).collect())) for d in "ab")
    assert first == second and len(first) == 6


def test_query_against_sql(spark):
    assert differences(repair.query(spark, SF_DIR), oracle_connection(SF_DIR), repair.ORACLE) == []
