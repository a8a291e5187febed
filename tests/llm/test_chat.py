"""Operator 8: exact round trip."""

import hashlib
import random

from tidewatch.llm.chat import chat_windows, conversation_digests, read_back

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    out = {}
    for c in {r[0] for r in rows}:
        own = sorted(((t if t is not None else -(1 << 62)), r or "", x or "") for k, t, r, x in rows if k == c)
        said = "".join(f"{r}\n{x}\n" for _, r, x in own)
        loss = "".join(x for _, r, x in own if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[c] = (len(own), sha(said), len(loss), sha(loss))
    return out


def conversations(seed=1):
    r = random.Random(seed)
    words = ["<|", "|>", "~", "~0", "~1", "<|end|>\n", "</s>[INST] ok [/INST]", "é", "日本", "hello", "\n", "<", "|", "x" * 300]
    rows = []
    for c in range(40):
        n = r.choice([1, 2, 5, 30, 700 if c == 7 else 3])
        if r.random() < 0.4:
            rows.append((c, 0, "system", " ".join(r.choice(words) for _ in range(4))))
        for t in range(1, n + 1):
            text = None if r.random() < 0.05 else " ".join(r.choice(words) for _ in range(r.randint(0, 25)))
            rows.append((c, t, ["assistant", "user"][t % 2], text))
    rows += [(50, 1, "user", "a"), (50, 1, "user", "a"), (50, 1, "assistant", "b"), (50, None, None, "n"),
             (51, 0, "ro|>\nle~2", "t"), (None, 0, "user", "u"), (None, 1, "assistant", "v"),
             (52, 0, "user", "L" * 50_000), (52, 1, "assistant", "M" * 50_000), (52, 2, "user", "")]
    return rows


def test_round_trip(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)
           for r in conversation_digests(chat_windows(df, 200, 80)).collect()}
    assert got == brute(rows)


def test_windows_keep_budget_system_and_history(spark):
    rows = conversations(2)
    df = spark.createDataFrame(rows, SCHEMA)
    out = chat_windows(df, 200, 80).collect()
    heads = {c: x for c, t, r, x in rows if r == "system"}
    longest = {}
    for c, t, r, x in rows:
        longest[c] = max(longest.get(c, 0), len((x or "").encode()) // 4 + 5)
    for w in out:
        system = len((heads.get(w.conv_id) or "").encode()) // 4 + 5 if w.conv_id in heads else 0
        assert w.n_tokens <= 200 + longest[w.conv_id] + 80 + system
        if w.conv_id in heads:
            assert w.formatted.startswith("<|system|>\n")
        assert 0 <= w.n_repeated < w.n_turns
    assert any(w.n_repeated > 1 for w in out)
    later = [w for w in out if w.span > 0 and w.conv_id not in heads]
    assert any(w.n_repeated for w in later)


def test_empty_extra_columns_and_no_python(spark):
    df = spark.createDataFrame([], SCHEMA + ", span long, tokens long")
    out = conversation_digests(chat_windows(df))
    assert out.collect() == []
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    df = spark.createDataFrame([(1, 0, "user", "q", 9, 9), (1, 1, "assistant", "a", 9, 9)], SCHEMA + ", span long, tokens long")
    r = read_back(chat_windows(df)).first()
    assert [(t.role, t.text) for t in r.turns] == [("user", "q"), ("assistant", "a")] and r.loss_text == "a"
