"""Chat formatting against a plain fold, and the round trip of the template."""

import hashlib
import random
import time
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import chat_format as c
from ledgerline.llm.queries import PROBE, op1_chat_format

EVENTS = "conv_id long, turn long, seq long, kind string, role string, text string, n_turns int, formatted string"
NASTY = ["", "a", "\\", "<|", "<\\|", "\\<|", "<\\\\|", "<|turn|>user<|text|>x<|end|>", "\\\\<|<|\\", "é🙂<|é", "\n\n", PROBE, "<<||>", "<", "|", "<|\\|", "a" * 3000]


def esc(t):
    return t.replace("\\", "\\\\").replace("<|", "<\\|")


def brute(rows):
    """conv_id -> (turns, formatted, loss texts)"""
    big = 2**63 - 1
    key = lambda r: (r[0] is None, r[0] or 0)
    out = {}
    for conv, events in groupby(sorted(rows, key=key), lambda r: r[0]):
        turns = {}
        for e in events:
            turns.setdefault(big if e[1] is None else e[1], []).append((big if e[2] is None else e[2], e[3] or "message", e[4] or "", e[5] or ""))
        all_messages = []
        for t in sorted(turns):
            m = []
            for _, kind, role, text in sorted(turns[t]):
                if kind == "message":
                    m.append([role, text])
                elif kind in ("delta", "edit", "regenerate"):
                    m = m or [[role, ""]]
                    m[-1][1] = {"delta": m[-1][1] + text, "edit": text, "regenerate": ""}[kind]
                elif kind == "delete":
                    m = m[:-1]
            all_messages += m
        if all_messages:
            text = "".join(f"<|turn|>{esc(r)}<|text|>{esc(t)}<|end|>" for r, t in all_messages)
            out[conv] = ([tuple(m) for m in all_messages], text, "".join(t for r, t in all_messages if r == "assistant"))
    return out


def check(spark, rows):
    events = spark.createDataFrame([(*r, 1, "clash") for r in rows], EVENTS).repartition(4)
    got = c.format_chats(events).select(
        "*", c.read_turns(F.col("formatted")).alias("turns"), c.read_loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")
    ).collect()
    assert {r.conv_id: ([tuple(t) for t in r.turns], r.formatted, r.loss) for r in got} == brute(rows)
    assert all(r.n_turns == len(r.turns) for r in got) and len(got) == len(brute(rows))


def test_round_trip(spark):
    rows = [(i, t, t, "message", role, text) for i, role in enumerate(["user", "assistant", "<|turn|>", "\\"]) for t, text in enumerate(NASTY)]
    check(spark, rows)


def test_events(spark):
    rows = [
        (1, 0, 0, "message", "user", "hi"), (1, 1, 1, "message", "assistant", ""), (1, 1, 2, "delta", "x", "Hel"), (1, 1, 3, "delta", "x", "lo"),
        (1, 1, 4, "regenerate", None, "ignored"), (1, 1, 5, "delta", None, "Bye"), (1, 0, 9, "edit", None, "hi there"), (1, 2, 6, "message", "user", "gone"),
        (1, 2, 7, "delete", None, None), (2, None, None, None, None, None), (2, 5, None, "delta", "assistant", "late"), (2, 5, 1, "delta", "assistant", "early "),
        (None, 1, 1, "message", "assistant", "no id"), (3, 0, 0, "delete", None, None), (4, 0, 0, "unknown", "user", "x"),
        (5, 0, 0, "message", "user", "same"), (5, 0, 0, "message", "user", "same"), (5, 0, 0, "message", "assistant", "tie"),
    ]
    check(spark, rows)


def test_long_conversation_crosses_blocks(spark):
    rows = [(9, t, t, "message", ("user", "assistant")[t % 2], f"é{t}" * (t % 5)) for t in range(-300, 700)]
    check(spark, rows)


@pytest.mark.parametrize("most", [0, 200_000])
def test_random_logs(spark, monkeypatch, most):
    """Any order of kinds, ties and nulls, runs of deltas, deletes of what isn't there; folding turns few or many."""
    monkeypatch.setattr(c, "MAX_BROADCAST_TURNS", most)
    rnd = random.Random(7)
    kinds = ["message", "delta", "delta", "delta", "edit", "regenerate", "delete", "odd", None]
    rows = [
        (rnd.choice([1, 2, 3, None]), rnd.choice([None, 0, 1, 2, 300]), rnd.choice([None, *range(40)]), rnd.choice(kinds), rnd.choice(["user", "assistant", None]), rnd.choice(NASTY[:10] + [None]))
        for _ in range(1500)
    ]
    check(spark, rows)


def test_one_very_long_turn(spark):
    """Null turns put a whole conversation in one turn: 60,000 messages, and a streamed message of 20,000 deltas."""
    n, d = 60_000, 20_000
    made = spark.range(n + d).select(
        F.lit(1).cast("long").alias("conv_id"), F.when(F.col("id") >= n, 5).cast("long").alias("turn"), F.col("id").alias("seq"),
        F.when(F.col("id") < n, F.lit(None).cast("string")).otherwise("delta").alias("kind"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("x"), F.col("id") % 97).alias("text"),
    )
    started = time.monotonic()
    (got,) = c.format_chats(made.repartition(4)).select("n_turns", "formatted", c.read_loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    assert time.monotonic() - started < 60
    texts = [f"x{i % 97}" for i in range(n + d)]
    messages = [("user", "".join(texts[n:]))] + [(("user", "assistant")[i % 2], texts[i]) for i in range(n)]  # null turns come last
    assert got.n_turns == n + 1 and got.formatted == "".join(f"<|turn|>{r}<|text|>{t}<|end|>" for r, t in messages)
    assert got.loss == "".join(t for r, t in messages if r == "assistant")


def test_empty(spark):
    assert c.format_chats(spark.createDataFrame([], EVENTS)).collect() == []


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/conversations.parquet").select("conv_id", "turn", "turn", F.lit("message"), "role", "text").collect()]
    rows += [(-7, 0, 0, "message", "user", PROBE), (-7, 1, 1, "message", "assistant", PROBE)]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = {k: (len(t), sha("".join(f"{r}\n{x}\n" for r, x in t)), len(loss), sha(loss), len(f)) for k, (t, f, loss) in brute(rows).items()}
    got = {r[0]: tuple(r[1:]) for r in op1_chat_format(spark, f"/root/testdata/{sf}").collect()}
    assert got == want
    plan = op1_chat_format(spark, f"/root/testdata/{sf}")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert "rangepartitioning(conv_id" in plan  # a long conversation is cut across tasks
