"""Chat examples: every reply once, contexts are prefixes, texts come back."""

from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F

from wardlens.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, target string, n int"
PARTS = ["###", "#", "</turn>", "\\", "/", "<", "turn>", "\n", ": ", "### Assistant: ", "é", "😀", "ok ", ""]


def _rows(n=120):
    rng = random.Random(12)
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, 9)):
            role = rng.choice(["system", "user", "assistant", "assistant", "tool: x", "User", "", None])
            text = None if rng.random() < 0.05 else "".join(rng.choice(PARTS)
                                                            for _ in range(rng.randrange(12)))
            rows.append((conv, turn, role, text, "x", 1))
    rows += [(500, t, "user" if t % 2 else "assistant", "w " * 40000, "x", 1) for t in range(3)]
    return rows


def _expected(rows):
    talks = {}
    for conv, turn, role, text, *_ in rows:
        talks.setdefault(conv, []).append((turn, role or "", text or ""))
    return {c: [(r, t) for _, r, t in sorted(x, key=lambda y: (y[0] is not None, y[0] or 0, *y[1:]))]
            for c, x in talks.items()}


def test_examples_hold_prefixes_and_one_reply(spark):
    rows = _rows()
    talks = _expected(rows)
    made = chat.format_examples(spark.createDataFrame(rows, SCHEMA)).withColumn(
        "turns", chat.parse_turns(F.col("text"))).withColumn(
        "loss", chat.trained_text(F.col("text"), F.col("loss_start"), F.col("loss_end"))).collect()
    seen = {}
    for r in made:
        turns = talks[r.conv_id]
        assert [(t.role, t.text) for t in r.turns] == turns[:r.target]
        reply = turns[r.target - 1][0] == "assistant"
        assert r.loss == (turns[r.target - 1][1] if reply else "")
        assert reply or r.target == len(turns)
        assert r.complete == (r.target == len(turns))
        # The span lies inside the last turn, and no mark stands inside it.
        inside = r.text[r.loss_start:r.loss_end]
        assert "###" not in inside and "</turn>" not in inside
        assert r.text.count(chat.END) == r.target
        seen.setdefault(r.conv_id, []).append(r.target)
    for conv, turns in talks.items():
        want = {i + 1 for i, (role, _) in enumerate(turns) if role == "assistant"} | {len(turns)}
        assert sorted(seen[conv]) == sorted(want)


def test_digests_equal_brute_force(spark):
    rows = _rows() + [(600, 1, "user", "same", "x", 1)] * 2 + [(None, None, "assistant", "a", "x", 1),
                                                              (None, 1, "user", "b", "x", 1)]
    frame = spark.createDataFrame(rows, SCHEMA)
    examples = chat.format_examples(frame)
    chars = {r.conv_id: r.n for r in examples.groupBy("conv_id").agg(
        F.sum(F.char_length("text")).alias("n")).collect()}
    got = {r.conv_id: r for r in chat.digests(examples).collect()}
    talks = _expected(rows)
    assert set(got) == set(talks)
    for conv, turns in talks.items():
        r, loss = got[conv], "".join(t for role, t in turns if role == "assistant")
        assert r.n_turns == len(turns) and r.loss_chars == len(loss)
        assert r.turns_sha256 == hashlib.sha256(
            "".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.formatted_chars == chars[conv]


def test_empty_table(spark):
    none = chat.format_examples(spark.createDataFrame([], SCHEMA))
    assert none.count() == 0 and chat.digests(none).count() == 0
