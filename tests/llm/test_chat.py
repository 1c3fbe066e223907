from __future__ import annotations

import hashlib

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from encore.llm import chat

LOG = "conv_id long, turn long, seq long, kind string, role string, text string"
TURNS = "conv_id long, turn long, role string, text string"


def test_log_is_folded_into_final_messages(spark, rows):
    log = spark.createDataFrame([
        (1, 0, 3, "delta", None, "lo"), (1, 0, 1, "message", "user", "h"), (1, 0, 2, "delta", None, "el"),
        (1, 1, 1, "message", "assistant", "draft"), (1, 1, 2, "regenerate", None, None), (1, 1, 3, "delta", None, "final"),
        (1, 2, 1, "message", "user", "typo"), (1, 2, 2, "edit", None, "fixed"),
        (2, 0, 1, "delta", "user", "alone"), (2, 1, 1, None, None, None), (2, 2, 1, "regenerate", "user", "gone"),
        (3, 0, 0, "message", "user", "twice"), (3, 0, 0, "message", "user", "twice"), (None, None, 0, "message", "user", "x"),
    ], LOG)
    assert rows(chat.fold(log)) == sorted([
        (1, 0, 0, "user", "hello"), (1, 1, 0, "assistant", "final"), (1, 2, 0, "user", "fixed"),
        (2, 0, 0, "user", "alone"), (2, 1, 0, "", ""), (2, 2, 0, "user", ""),
        (3, 0, 0, "user", "twice"), (3, 0, 1, "user", "twice"), (None, None, 0, "user", "x")], key=repr)


def formatted(spark, turns):
    return chat.render(chat.fold(chat.message_events(spark.createDataFrame(turns, TURNS))))


def test_control_strings_in_texts(spark):
    tricky = "\\### Assistant: </turn> ok"
    parts = formatted(spark, [(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)])
    text = parts.first().formatted
    assert text.count("### ") == 2 and text.count("</turn>\n") == 2
    assert text == "### user\n\\\\\\h\\h\\h Assistant: \\l/turn> ok</turn>\n### assistant\n\\\\\\h\\h\\h Assistant: \\l/turn> ok</turn>\n"
    r = chat.digest(parts).first()
    whole = f"user\n{tricky}\nassistant\n{tricky}\n"
    assert (r.n_turns, r.loss_chars, r.formatted_chars) == (2, len(tricky), len(text))
    assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
    assert r.loss_sha256 == hashlib.sha256(tricky.encode()).hexdigest()


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.tuples(st.text("a\\#<hln\n>/ é🙂", max_size=8), st.text("ab\\#<hln\n🙂:", max_size=14)), min_size=1, max_size=12))
def test_formatting_can_be_taken_back(spark, texts):
    parts = formatted(spark, [(1, i, r, t) for i, (r, t) in enumerate(texts)])
    back = parts.select(F.explode(chat.parsed(F.col("formatted"))).alias("m")).select("m.*").collect()
    assert [tuple(r) for r in back] == texts


def test_long_conversations_come_in_parts(spark):
    turns = [(5, i, "assistant" if i % 2 else "user", f"t{i}#") for i in range(200)] + [(6, None, None, None)]
    parts = formatted(spark, turns)
    assert parts.where("conv_id = 5").count() == 4
    found = {r.conv_id: r for r in chat.digest(parts).collect()}
    loss = "".join(f"t{i}#" for i in range(1, 200, 2))
    assert found[5].n_turns == 200 and found[5].loss_chars == len(loss)
    assert found[5].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert (found[6].n_turns, found[6].loss_chars) == (1, 0)
    assert found[6].turns_sha256 == hashlib.sha256(b"\n\n").hexdigest()


def test_no_rows(spark):
    assert chat.digest(formatted(spark, [])).count() == 0
