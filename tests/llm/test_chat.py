"""Operator 1: folds, exact round trips, and the query against SQL."""

from __future__ import annotations

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from shelfline.llm import chat
from tests.conftest import SF_DIR
from tests.parity import differences, oracle_connection

SPOKEN = st.text(alphabet=st.sampled_from("<>[]/\\sINTa é\n"), max_size=30)


@settings(max_examples=400, deadline=None)
@given(SPOKEN, SPOKEN)
def test_round_trip(role, text):
    segment, start, end = chat.render(role, text)
    assert chat.parse(segment) == (role, text)
    assert chat.unescape(chat.escape(text)) == text
    assert segment.count(chat.OPEN) == segment.count(chat.CLOSE) == segment.count(chat.END) == 1
    segment, start, end = chat.render("assistant", text)
    assert chat.unescape(segment[start:end]) == text


def test_fold():
    log = [("message", "user", "ab"), ("delta", None, "c"), ("edit", None, "x"), ("delta", None, None), ("delta", None, "y")]
    assert chat.fold(log) == [("user", "xy")]
    again = [("delta", "assistant", "no"), ("regenerate", None, None), ("delta", None, "yes"), ("delta", "assistant", "!")]
    assert chat.fold(again) == [("assistant", "yes!")]
    assert chat.fold([("message", None, None), ("message", "user", "b")]) == [("", ""), ("user", "b")]
    assert chat.fold([("regenerate", "assistant", "dropped")]) == [("assistant", "")]
    with pytest.raises(ValueError):
        chat.fold([("poke", "user", "x")])


def test_log_in_any_order_with_nulls_ties_and_clashing_columns(spark):
    log = [
        (1, 1, 12, "delta", None, "lo"), (1, 1, 10, "message", "assistant", ""), (1, 1, 11, "delta", None, "hel"),
        (1, 0, 1, "message", "user", "</s>"), (1, 0, 20, "edit", None, "[INST]"), (1, None, None, "message", None, None),
        (1, 2, 30, "message", "user", "same"), (1, 2, 30, "message", "user", "same"),
        (None, 0, 0, "message", "assistant", "x" * 200_000),
    ]
    events = spark.createDataFrame([(*r, "z", 0) for r in log], chat.EVENTS + ", segment string, part int")
    messages = chat.format_messages(events)
    got = {r.conv_id: r for r in chat.conversations(messages).collect()}
    assert got[1].text == (
        "<s>[INST][/INST]</s>[INST]user[/INST][\\INST]</s>[INST]assistant[/INST]hello</s>"
        "[INST]user[/INST]same</s>[INST]user[/INST]same</s>"
    )
    assert [got[1].text[a:b] for a, b in got[1].loss_spans] == ["hello"]
    assert [got[None].text[a:b] for a, b in got[None].loss_spans] == ["x" * 200_000]
    digests = {r.conv_id: r for r in chat.read_back(messages).collect()}
    assert (digests[1].n_turns, digests[1].loss_chars, digests[1].formatted_chars) == (5, 5, len(got[1].text))
    assert digests[None].loss_chars == 200_000
    assert chat.read_back(chat.format_messages(events.limit(0))).count() == 0


def test_one_long_conversation_is_spread(spark):
    rows = spark.range(4000).selectExpr("7 conv_id", "id turn", "'user' role", "'word' text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        messages = chat.format_messages(chat.as_events(rows))
        assert messages.select(F.spark_partition_id()).distinct().count() == 8
        (row,) = chat.read_back(messages).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert row.n_turns == 4000


def test_a_log_of_turns_folds_into_the_turns(spark):
    said = ["", "a", "é😀", "</s>[INST]", "words of some length, " * 9, None]
    rows = [(c, t, role, said[(c + 3 * t) % 6]) for c in range(40) for t in range(3) for role in ("user", "assistant", None)]
    rows += [(None, None, "assistant", "x"), (None, None, "assistant", "x"), (50, 0, "assistant", "long 😀" * 400_000)]
    table = spark.createDataFrame([(*r, 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, seq int")
    log = chat.as_log(table)
    assert f"{log.schema.simpleString()[7:-1]}".replace(":", " ").replace(",", ", ") == chat.EVENTS
    kinds = {r.kind: r["count"] for r in log.groupBy("kind").count().collect()}
    assert kinds["message"] == len(rows) and all(kinds[k] > 50 for k in ("delta", "edit", "regenerate"))
    shuffled = log.orderBy(F.rand(5))
    got = {}
    for m in chat.format_messages(shuffled).collect():
        got.setdefault((m.conv_id, m.turn), []).append((m.part, *chat.parse(m.segment)))
    expected = {}
    for conv, turn, role, text in rows:
        expected.setdefault((conv, turn), []).append((role or "", text or ""))
    assert {k: [m[1:] for m in sorted(v)] for k, v in got.items()} == {k: sorted(v) for k, v in expected.items()}
    assert chat.as_log(table.limit(0)).count() == 0


def test_the_query_folds_deltas_edits_and_regenerations_of_the_whole_table(spark):
    rows = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    log = chat.as_log(rows)
    kinds = {r.kind: r["count"] for r in log.groupBy("kind").count().collect()}
    n = rows.count()
    assert kinds["message"] == n
    assert kinds["edit"] > n / 5 and kinds["regenerate"] > n / 5 and kinds["delta"] > n


def test_query_against_sql(spark):
    assert differences(chat.query(spark, SF_DIR), oracle_connection(SF_DIR), chat.ORACLE) == []
