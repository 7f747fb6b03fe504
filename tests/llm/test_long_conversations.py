"""A conversation that holds most of the table is never one row."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from precis.llm import chat
from precis.llm.chat import Template

N = 20_000


@pytest.fixture(scope="module")
def table(spark):
    """The null id holds 20,000 turns; others share its beginning, leave it halfway, or end inside it."""
    role, text = F.when(F.col("turn") % 2 == 0, "user").otherwise("assistant"), F.concat(F.lit("said <s> "), "turn")
    turns = lambda n: spark.range(n).select(F.col("id").alias("turn")).select("turn", role.alias("role"), text.alias("text"))
    of = lambda rows, conv: rows.withColumn("conv_id", F.lit(conv).cast("long"))
    other = turns(N // 2 + 1).withColumn("text", F.when(F.col("turn") == N // 2, "else").otherwise(F.col("text")))
    return of(turns(N), None).unionByName(of(other, 1)).unionByName(of(turns(N // 4), 2)).unionByName(of(turns(N), 3)).repartition(5)


@pytest.fixture(scope="module")
def path(spark, table, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('long')}/out"
    chat.write(table, path)
    return path


def test_long_conversations_are_cut_into_blocks(spark, path):
    blocks = sorted(spark.read.parquet(f"{path}/blocks").collect(), key=lambda b: b["block"])
    assert len(blocks) > 5 and max(len(b["text"]) for b in blocks) < chat.BLOCK_CHARS + 100
    whole, form = "".join(b["text"] for b in blocks), Template()
    said = lambda i: form.turn("assistant" if i % 2 else "user", f"said <s> {i}")[0]
    assert len(whole) == sum(len(said(i)) for i in range(N)) + len(form.turn("user", "else")[0])
    assert sorted(t for b in blocks for t in [b["turns_before"]])[0] == 0
    for b in blocks:
        assert b["start"] == len("".join(x["text"] for x in blocks if x["block"] < b["block"]))
        seen = "".join(whole[s["start"] : s["start"] + s["size"]] for s in b["attends"])
        assert len(seen) == b["position"] and len(b["attends"]) <= 2
        turns = form.turns(seen + b["text"])
        assert len(form.turns(seen)) == b["turns_before"] and [len(b["turns"])] == [len(turns) - b["turns_before"]]
        assert all(t == f"said <s> {i}" or (i, t) == (N // 2, "else") for i, (_, t) in enumerate(turns))


def test_digests_of_long_conversations(spark, table, path):
    got = {r["conv"]: r for r in chat.digests(spark, path).collect()}
    rows = sorted(((r["conv_id"] or 0, r["turn"], r["role"], r["text"]) for r in table.collect()))
    assert set(got) == {None, 1, 2, 3}
    for conv, r in got.items():
        mine = [x[2:] for x in rows if x[0] == (conv or 0)]
        lost = "".join(t for role, t in mine if role == "assistant")
        assert r["n_turns"] == len(mine)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in mine).encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(lost), hashlib.sha256(lost.encode()).hexdigest())
        assert r["formatted_chars"] == sum(len(Template().turn(*x)[0]) for x in mine)
