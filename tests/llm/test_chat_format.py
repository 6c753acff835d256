import random

import pytest

from brute import sha
from riskledger.llm import chat_format as cf

SCHEMA = "conv_id long, turn long, role string, text string, seq int, span string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def ordered(rows):
    convs = {}
    for conv, turn, role, text in rows:
        role = role or ""
        convs.setdefault(conv, []).append(((turn is not None, turn or 0), role, text or ""))
    return {c: [(r, t) for _, r, t in sorted(own)] for c, own in convs.items()}


def conversations():
    rnd = random.Random(4)
    bits = ["hello", "<|im_end|>", "</s>", "[INST]", "[/INST]", "\\", "\\\\", "<", "|", "\n", " ", "é",
            "<|im_start|>user\n", "<<SYS>>", "<s>", "日本"]
    rows = []
    for conv in range(25):
        roles = ["system"] * rnd.randint(0, 1) + ["user", "assistant"] * rnd.randint(0, 6)
        for turn, role in enumerate(roles):
            text = "".join(rnd.choice(bits) for _ in range(rnd.choice([0, 3, 40, 400])))
            rows.append((conv, turn, role, text))
    rows += [(90, 0, "system", "only"), (91, None, None, None), (91, 2, "tool\nx", "y"), (91, 3, "\\\n\\n<|im_end|>\n", "z"), (92, 1, "user", "b"),
             (92, 1, "assistant", "a"), (92, 1, "assistant", "a"), (None, 0, "assistant", "lone"),
             (93, 0, "user", "w" * 100_000), (93, 1, "assistant", "v" * 50_000), (94, 0, "user", "x"),
             (94, 1, "system", "late"), (94, 2, "assistant", "y")]
    return rows


@pytest.mark.parametrize("budget, history", [(1024, 256), (64, 24), (200, 0)])
def test_read_back(spark, budget, history):
    rows = conversations()
    windows = cf.format_windows(table(spark, rows), budget, history)
    got = {r.conv_id: r for r in cf.windows_report(windows).collect()}
    expected = ordered(rows)
    assert set(got) == set(expected)
    for conv, turns in expected.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        row = got[conv]
        assert row.n_turns == len(turns)
        assert row.turns_sha256 == sha("".join(f"{r}\n{t}\n" for r, t in turns))
        assert (row.loss_chars, row.loss_sha256) == (len(loss), sha(loss))


def test_budget_history_and_system_turn(spark):
    text = "word " * 20
    rows = [(1, 0, "system", "Be kind.")]
    rows += [(1, k, ("assistant", "user")[k % 2], f"{k} {text}") for k in range(1, 40)]
    windows = cf.format_windows(table(spark, rows), 300, 80).orderBy("window").collect()
    assert len(windows) > 3
    for w in windows:
        assert w.n_tokens <= 300
        assert w.formatted.startswith("<|im_start|>system\nBe kind.<|im_end|>\n")
        assert w.n_repeated == (0 if w.window == 0 else 3)
    # What is repeated is what came just before.
    first, second = windows[0].formatted, windows[1].formatted
    assert first.split("<|im_start|>")[-2:] == second.split("<|im_start|>")[2:4]


def test_escaping_can_be_undone(spark):
    texts = ["", "\\", "<|", "<\\|", "\\<|im_end|>", "</s>[INST] ok [/INST]", "<<SYS>>\n<</SYS>>", "[[INST]"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    from pyspark.sql import functions as F

    for r in df.select("t", cf.escape(F.col("t")).alias("e"), cf.unescape(cf.escape(F.col("t"))).alias("u")).collect():
        assert r.u == r.t and not any(c in r.e for c in cf.CONTROL)


def test_empty_table_and_native_plan(spark):
    windows = cf.format_windows(table(spark, []))
    assert cf.windows_report(windows).count() == 0
    plan = cf.windows_report(windows)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
