import hashlib
import os
import random
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

from tallyloom.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, loss string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_round_trip():
    rng, template = random.Random(2), chat.Template()
    bits = ["\\", "<", ">", "[", "]", "<s>", "</s>", "[INST] ", " [/INST]", "<out>", "<role x>", "</role>", "a", " ", "\n", "<<SYS>>\n"]
    for _ in range(2000):
        turns = [
            (rng.choice(["system", "user", "assistant", "", "tool>x", "\\<"]), "".join(rng.choices(bits, k=rng.randint(0, 8))))
            for _ in range(rng.randint(1, 5))
        ]
        text = template.begin
        for role, body in turns:
            a, b, _ = template.turn(role)
            text += a + template.escaped(body) + b
        assert template.read_back(text) == turns


def test_cases(spark):
    rows = [
        (1, 1, "assistant", "b", "x"), (1, 0, "user", "a", "x"),
        (2, 0, "user", None, None), (2, 0, "user", None, None),
        (3, 0, None, "n", "x"), (3, 1, "assistant", "", "x"),
        (None, None, "system", "s" * 50_000, "x"), (None, 1, "user", "u", "x"), (None, 2, "assistant", "v", "x"),
    ]
    out = {r.conv_id: r for r in chat.digest(chat.format_chats(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert out[1].turns_sha256 == sha("user\na\nassistant\nb\n") and out[1].loss_sha256 == sha("b") and out[1].valid
    assert out[2].n_turns == 2 and out[2].turns_sha256 == sha("user\n\nuser\n\n") and not out[2].valid
    assert out[3].turns_sha256 == sha("\nn\nassistant\n\n") and out[3].loss_chars == 0 and not out[3].valid
    assert out[None].n_turns == 3 and out[None].valid and out[None].loss_sha256 == sha("v")
    assert chat.digest(chat.format_chats(spark.createDataFrame([], SCHEMA))).count() == 0


def test_segments(spark):
    rows = [(1, 0, "user", "a<", ""), (1, 1, "assistant", "b", "")]
    segs = chat.format_chats(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(s.text, s.loss) for s in segs] == [
        ("<s>", False), ("[INST] ", False), ("a\\<", False), (" [/INST]", False), ("<out>", False), ("b", True), ("</s>", False)
    ]


def test_long_conversation(spark):
    """One conversation over several batches."""
    rows = [(9, i, "user" if i % 2 == 0 else "assistant", str(i), "") for i in range(25_000)]
    one = chat.digest(chat.format_chats(spark.createDataFrame(rows, SCHEMA))).first()
    assert one.n_turns == 25_000 and one.valid and one.loss_sha256 == sha("".join(r[3] for r in rows[1::2]))


@pytest.mark.parametrize("name", ["op3_chat_format"])
def test_sql(spark, name):
    import compare
    from tallyloom.llm.registry import ORACLE, QUERIES

    folder = "/root/testdata/sf0.001"
    df = QUERIES[name](spark, folder)
    con = compare.connect(folder)
    res = con.execute(ORACLE[name])
    columns = [c[0] for c in res.description]
    assert compare.as_rows(df.columns, [tuple(r) for r in df.collect()]) == compare.as_rows(columns, res.fetchall())
    assert sorted(columns) == sorted(df.columns)
