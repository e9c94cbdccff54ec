"""Chat formatting: exact round trips, the role machine, the loss mask."""

import hashlib
import random

from pyspark.sql import functions as F

from ledgerlark.llm.chat_format import INSTRUCT, chat_digests, escape, format_chats, unescape

ROWS = "conv_id long, turn long, role string, text string, open string, at int"
BITS = ["<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "<|other:", "|>", "<|end|>", "\\", "\\a", "\\b", "\\\\", "<", "[", "|", " ", "\n", "x", "é", "\r\n", "<</", "ok"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], ROWS)


def test_round_trip_of_control_strings(spark):
    rng, rows, expected = random.Random(3), [], {}
    for c in range(250):
        turns = []
        for t in range(rng.randrange(1, 8)):
            role = rng.choice(["system", "user", "assistant", "tool", None, "a|>b", "<s>"])
            text = None if rng.random() < 0.05 else "".join(rng.choice(BITS) for _ in range(rng.randrange(0, 10)))
            rows.append((c, t, role, text))
            turns.append((role or "", text or ""))
        expected[c] = turns
    rng.shuffle(rows)
    for r in chat_digests(frame(spark, rows)).collect():
        turns = expected[r.conv_id]
        learned = "".join(t for role, t in turns if role == "assistant")
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())


def test_escape_leaves_no_control_string(spark):
    rng = random.Random(5)
    df = spark.createDataFrame([("".join(rng.choice(BITS) for _ in range(12)),) for _ in range(300)], "t string")
    e = escape(F.col("t"), INSTRUCT)
    for r in df.select("t", e.alias("e"), unescape(e, INSTRUCT).alias("u")).collect():
        assert r.u == r.t and not any(c in r.e for c in INSTRUCT.controls)


def test_machine_and_segments(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (2, 0, "assistant", "a"), (3, 0, "user", "u"), (3, 1, "user", "v"),
            (4, 0, "user", "u"), (4, 1, "assistant", "a"), (4, 2, "system", "s"), (5, 0, "system", "only"), (6, None, "user", None), (None, 0, "user", "x"),
            (7, 0, "user", "same"), (7, 0, "user", "same")]
    out = {r.conv_id: r for r in format_chats(frame(spark, rows)).collect()}
    assert {c: (r.valid, r.error_turn) for c, r in out.items()} == {
        1: (True, None), 2: (False, 1), 3: (False, 2), 4: (False, 3), 5: (False, 1), 6: (True, None), 7: (False, 2)}
    assert out[1].formatted == "<<SYS>>\ns\n<</SYS>>\n[INST] u [/INST]<s> a </s>"
    assert "".join(s.text for s in out[1].segments) == out[1].formatted
    assert [s.text for s in out[1].segments if s.loss] == ["a"]
    assert out[7].n_turns == 2 and out[6].formatted == "[INST]  [/INST]"


def test_long_text_and_empty_table(spark):
    text = "long [INST] \\ " * 20_000
    r = chat_digests(frame(spark, [(1, 0, "user", text), (1, 1, "assistant", text)])).first()
    assert r.n_turns == 2 and r.loss_chars == len(text)
    assert chat_digests(frame(spark, [])).count() == 0
