from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from precis.llm import chat
from precis.llm.chat import CONTROLS, Template


@pytest.fixture(scope="module")
def conversations():
    tricky = "</s>[INST] ok [/INST]"
    shared = [("system", "You help."), ("user", "Hi"), ("assistant", "Hello")]
    out = {i: [*shared, ("user", f"q{i % 4}"), ("assistant", f"a{i % 4} {'x' * (i % 3)}")] for i in range(24)}
    out |= {50: shared, 51: shared[:2], 52: shared[:1], 53: [("user", "Hi")], 54: [("user", tricky), ("assistant", tricky)]}
    out |= {55: [("us\ner\\", "\n\n"), ("<s>", "<<s><\\s><|x|>" + "".join(CONTROLS)), ("", "")], 56: [("assistant", "one"), ("assistant", "two")]}
    out |= {57: [("user", "日本é" * 50)], 58: [("assistant", "a" * 40_000)], 59: [(None, None), ("user", None)], None: [("user", "no id")]}
    return out


@pytest.fixture(scope="module")
def written(spark, conversations, tmp_path_factory):
    rows = [(c, i, r, t, 1, "x", "y") for c, turns in conversations.items() for i, (r, t) in enumerate(turns)]
    rows += [(90, 0, "user", "twice", 1, "x", "y")] * 2 + [(91, None, "user", "first", 1, "x", "y"), (91, 0, "user", "second", 1, "x", "y")]
    path = f"{tmp_path_factory.mktemp('chat')}/out"
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, block long, path string, conv string")
    chat.write(df.repartition(4), path)
    return path


def test_conversations_read_back(spark, conversations, written):
    got = {r["conv"]: r for r in chat.read(spark, written).collect()}
    want = {c: [(r or "", t or "") for r, t in turns] for c, turns in conversations.items()}
    want |= {90: [("user", "twice")] * 2, 91: [("user", "first"), ("user", "second")]}
    assert set(got) == set(want)
    form = Template()
    for c, turns in want.items():
        assert [(t["role"], t["text"]) for t in got[c]["turns"]] == turns
        assert got[c]["formatted"] == "".join(form.turn(r, t)[0] for r, t in turns)
        assert got[c]["learned"] == "".join(t for r, t in turns if r == "assistant")


def test_shared_turns_are_written_once_depth_first(spark, conversations, written):
    blocks = sorted(spark.read.parquet(f"{written}/blocks").collect(), key=lambda b: b["block"])
    whole = "".join(b["text"] for b in blocks)
    assert whole.count("You help.") == 1 and whole.count("Hello") == 1
    at = 0
    for b in blocks:
        assert b["start"] == at and b["turns"][-1]["end"] == len(b["text"])
        at += len(b["text"])
        # What a block attends to is before it, and as long as its first position says.
        assert sum(s["size"] for s in b["attends"]) == b["position"]
        assert all(s["start"] + s["size"] <= b["start"] for s in b["attends"])
        seen = "".join(whole[s["start"] : s["start"] + s["size"]] for s in b["attends"]) + b["text"]
        assert Template().turns(seen)
    trees = [b["block"] for b in blocks if not b["attends"]]
    owners = [max(t for t in trees if t <= b["block"]) for b in blocks]
    # Depth first: a tree's blocks follow one another.
    for b, tree in zip(blocks, owners, strict=True):
        assert all(s["block"] >= tree for s in b["attends"])


def test_token_columns(spark, written):
    rows = chat.token_columns(spark.read.parquet(f"{written}/blocks")).filter(F.length("text") < 200).collect()
    for r in rows:
        assert r["position_ids"] == list(range(r["position"], r["position"] + len(r["text"])))
        spans = [(t["loss_from"], t["loss_to"]) for t in r["turns"]]
        assert r["loss_mask"] == [int(any(a <= i < b for a, b in spans)) for i in range(len(r["text"]))]


def test_escapes_are_reversible():
    form = Template()
    texts = ["", "<s>", "<\\s>", "<\\\\s>", "a<", "<<s>", "<</s>", "[[INST]", "\\<|", "<\\", "".join(CONTROLS), "".join(CONTROLS).replace("<", "<\\")]
    for t in texts:
        assert form.unescape(form.escape(t)) == t
        assert not any(c in form.escape(t) for c in CONTROLS)
        assert form.turns(form.turn(t, t)[0] + form.turn("x\ny", t)[0]) == [(t, t), ("x\ny", t)]


def test_empty_table(spark, tmp_path):
    chat.write(spark.createDataFrame([], "conv_id long, turn long, role string, text string"), f"{tmp_path}/c")
    assert chat.read(spark, f"{tmp_path}/c").count() == 0
