"""Chat formatting: round trips of every layout and odd text, digests against plain Python."""

import hashlib
import random

import pytest

from millrace.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, id int"
ODD = ["</s>[INST] ok [/INST]", "[TURN]user[TEXT]x[END]", "~0~1~~[", "", None, "[", "~", "a\n\nb", "é[END]~1" * 50, "$1\\0.*"]


def want(rows):
    groups = {}
    for c, n, role, text, *_ in rows:
        groups.setdefault(c, []).append(((n is not None, n or 0), role or "", text or ""))
    out = []
    for c, turns in groups.items():
        turns.sort()
        every = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        out.append((c, len(turns), sha(every), len(loss), sha(loss)))
    return sorted(out, key=repr)


def test_digest(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 7)
    rng = random.Random(1)
    rows = [(c, n, rng.choice(["user", "assistant", "[TEXT]", None]), rng.choice(ODD), "x", 1) for c in range(12) for n in range(rng.randint(1, 40))]
    rows += [(None, 1, "assistant", "x", "", 0), (None, None, "user", "y", "", 0), rows[0], (3, 5, "user", "tie", "", 0), (99, 0, "assistant", "z " * 200_000, "", 0)]
    rng.shuffle(rows)
    got = chat.digest(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == want(rows)
    assert all(r.formatted_chars > r.loss_chars for r in got)


def test_empty_table(spark):
    assert chat.digest(spark.createDataFrame([], SCHEMA)).collect() == []


LAYOUTS = [
    ("conv_id long, messages array<struct<role:string,content:string>>, extra string", (1, [("user", "a["), ("assistant", None)], "x"), [("user", "a["), ("assistant", "")]),
    ("conv_id long, conversations array<struct<from:string,value:string>>", (1, [("human", "q"), ("gpt", "~a"), (None, "n")]), [("user", "q"), ("assistant", "~a"), ("", "n")]),
    ("conv_id long, prompt string, response string", (1, "p", None), [("user", "p"), ("assistant", "")]),
    ("conv_id long, instruction string, input string, output string", (1, "do", "", "done"), [("user", "do"), ("assistant", "done")]),
    ("conv_id long, instruction string, input string, output string", (1, "do", "it", "done"), [("user", "do\n\nit"), ("assistant", "done")]),
    ("conv_id long, system string, instruction string, output string", (1, "be", "do", "d"), [("system", "be"), ("user", "do"), ("assistant", "d")]),
    ("conv_id long, messages array<struct<role:string,text:string>>", (1, None), []),
]


@pytest.mark.parametrize("schema, row, turns", LAYOUTS)
def test_layouts(spark, schema, row, turns):
    (got,) = chat.parsed(chat.formatted(spark.createDataFrame([row], schema))).collect()
    assert [(t.role, t.text) for t in got.turns] == turns
    assert [t.loss for t in got.turns] == [r == "assistant" for r, _ in turns]


def test_unknown_layout(spark):
    with pytest.raises(ValueError, match="answer.body"):
        chat.formatted(spark.createDataFrame([(1, ("x",))], "conv_id long, answer struct<body:string>"))
