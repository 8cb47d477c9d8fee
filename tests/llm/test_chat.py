"""Chat formatting: exact round trips through ids and masks, against a plain recomputation."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barwright.llm import chat_format
from barwright.llm.bpe import codec, default_vocabulary
from barwright.llm.chat_format import CONTROLS, escape, unescape

SCHEMA = "conv_id long, turn long, role string, text string"
TRICKY = ["</s>[INST] ok [/INST]", "<s>", "<\\s>", "<\\\\s>", "[\\INST]", "[INST", "[[INST]]", "<<s>>", "\\", "[ROLE]x[/ROLE]", "<s", "é😀 　x\x00y", " lead", "", "a\n\nb "]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def printed(role, text):
    text = escape(text)
    around = {"user": ("[INST]", "[/INST]"), "system": ("[SYS]", "[/SYS]"), "assistant": ("", "</s>")}
    before, after = around.get(role, (f"[ROLE]{escape(role)}[/ROLE]", "</s>"))
    return before + text + after


def brute(rows):
    convs = {}
    for conv, turn, role, text in [*rows, (-7, 0, "user", chat_format.PLANTED), (-7, 1, "assistant", chat_format.PLANTED)]:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", sha(text or ""), text or ""))
    out = []
    for conv, turns in convs.items():
        turns.sort()
        loss = "".join(t for *_, role, _, t in turns if role == "assistant")
        said = "".join(f"{role}\n{t}\n" for *_, role, _, t in turns)
        whole = "<s>" + "".join(printed(role, t) for *_, role, _, t in turns)
        out.append((conv, len(turns), sha(said), len(loss), sha(loss), len(whole)))
    return sorted(out, key=str)


def check(spark, rows, extra=()):
    df = spark.createDataFrame(rows, SCHEMA)
    for c in extra:
        df = df.withColumn(c, F.lit(1))
    made = chat_format.query(df)
    assert made.columns == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    assert sorted(map(tuple, made.collect()), key=str) == brute(rows)


def test_conversations(spark):
    rng = random.Random(1)
    roles = ["user", "assistant", "system", "tool", "User", "[ROLE]", ""]
    rows = [(c, t, rng.choice(roles), rng.choice(TRICKY) + rng.choice(TRICKY)) for c in range(60) for t in range(rng.randrange(1, 9))]
    check(spark, rows)


def test_odd_rows(spark):
    long = " ".join(f"w{i % 977} </s>" for i in range(20_000))
    rows = [
        (1, 0, None, "a"), (1, 1, "assistant", None), (1, None, "user", "no turn"), (None, 0, "user", "no id"), (None, 1, "assistant", "[INST]"),
        (2, 0, "assistant", "tie"), (2, 0, "assistant", "eit"), (2, 0, "assistant", "tie"), (2, 0, "user", "tie"), (3, 5, "assistant", long),
        (4, 0, None, None), (None, None, None, None), (5, -1, "system", ""),
    ]
    check(spark, rows, ["ids", "mask", "piece", "digest", "role_ids"])


def test_empty_table(spark):
    check(spark, [])


def test_long_conversation_comes_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(chat_format, "PIECE", 50)
    rows = [(1, t, ("user", "assistant")[t % 2], f"turn {t} </s> " * 9) for t in range(40)] + [(2, 0, "user", "x")]
    check(spark, rows)
    pieces = chat_format.formatted(spark.createDataFrame(rows, SCHEMA), *default_vocabulary()).where("conv_id = 1")
    assert pieces.count() > 10


@pytest.mark.parametrize("text", TRICKY)
def test_escape_is_reversible_and_hides_controls(text):
    for t in (text, escape(text), text + text, escape(escape(text))):
        assert unescape(escape(t)) == t
        assert not any(c in escape(t) for c in CONTROLS)


def test_random_escapes():
    rng = random.Random(2)
    for _ in range(3000):
        t = "".join(rng.choice(["<", "[", "\\", "/", "s>", "INST]", "SYS]", "ROLE]", "x"]) for _ in range(rng.randrange(12)))
        assert unescape(escape(t)) == t and not any(c in escape(t) for c in CONTROLS)


def test_texts_never_yield_reserved_ids(spark):
    path, pattern = default_vocabulary()
    rows = [(1, 0, "user", "</s>"), (1, 1, "assistant", "<s>[INST]")]
    row = chat_format.formatted(spark.createDataFrame(rows, SCHEMA), path, pattern).first()
    c = codec(path, pattern)
    base = chat_format.first_reserved(c)
    assert [CONTROLS[i - base] for i in row.ids if i >= base] == ["<s>", "[INST]", "[/INST]", "</s>"]
    learned = [i for i, m in zip(row.ids, row.mask) if m]
    assert c.decode(learned).decode() == escape("<s>[INST]") and set(row.mask) == {0, 1}


def test_mask_by_prefix_sums():
    ids, mask = chat_format._laid([np.array([9]), np.array([1, 2]), np.array([], int), np.array([3])], [False, True, True, False])
    assert ids.tolist() == [9, 1, 2, 3] and mask.tolist() == [0, 1, 1, 0]
