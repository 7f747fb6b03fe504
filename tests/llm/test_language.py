from __future__ import annotations

import zlib

import numpy as np
import pytest

from precis.llm import language
from precis.llm.common import table


@pytest.fixture(scope="module")
def model(spark):
    return language.fit(table(spark, "/root/testdata/sf0.01", "documents"), per_language=120)


def test_held_out_accuracy(spark, model):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = language.predict(docs, model).join(docs.select("doc_id", "lang", "n_chars"), language.F.col("_key") == language.F.col("doc_id")).collect()
    assert len(rows) == docs.count()
    out = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["_key"]).encode()) % 3 == 1) for r in rows)
    long = [r for r in out if r["n_chars"] >= 100]
    assert np.mean([r["lang_pred"] == r["lang"] for r in out]) > 0.97
    assert np.mean([r["lang_pred"] == r["lang"] for r in long]) > 0.985
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_texts(documents, no_documents, model):
    got = {}
    for r in language.predict(documents, model).collect():
        got.setdefault(r["_key"], set()).add((r["lang_pred"], r["score"] > 0))
    assert got[23] == got[24] == got[25] == {("und", False)} and got[31] != {("und", False)}
    assert language.predict(no_documents, model).count() == 0
    assert language.fit(no_documents) is None
    assert {r["lang_pred"] for r in language.predict(documents, None).collect()} == {"und"}


def test_only_rows_that_are_not_held_out_teach(spark):
    keys = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 == 1][:50]
    df = spark.createDataFrame([(k, "some words here", "en") for k in keys], "doc_id long, text string, lang string")
    assert language.fit(df) is None


def test_gradients():
    rng = np.random.default_rng(0)
    windows = rng.integers(33, 120, (6, 7)).astype(np.uint8)
    way = language.Direction(rng.normal(0, 0.5, (256, 9)), rng.normal(0, 0.5, (3, 9)))
    steps, want = windows.T, rng.normal(0, 1, (7, 6, 3))

    def loss(table, state):
        h, total, kept = np.zeros((6, 3)), 0.0, []
        for row, w in zip(steps, want, strict=True):
            u, z, r, c = language._gates(table, state, row, h)
            kept.append((h, u, z, r, c))
            h = (1 - z) * h + z * c
            total += (h * w).sum()
        return total, kept

    _, kept = loss(way.table, way.state)
    d_table, d_state = language._back(way, steps, want, kept)
    for matrix, grad, at in ((way.state, d_state, (1, 4)), (way.state, d_state, (2, 8)), (way.table, d_table, (int(windows[2, 3]), 5))):
        matrix[at] += 1e-5
        up, _ = loss(way.table, way.state)
        matrix[at] -= 2e-5
        down, _ = loss(way.table, way.state)
        matrix[at] += 1e-5
        assert grad[at] == pytest.approx((up - down) / 2e-5, rel=1e-4, abs=1e-6)


def test_reading_in_batches_is_the_same(model):
    import pyarrow as pa

    texts = ["Das ist ein Haus", "the house of the man " * 40, "x"]
    together = model.probabilities(pa.array(texts))
    alone = np.concatenate([model.probabilities(pa.array([t])) for t in texts])
    assert np.allclose(together, alone, atol=1e-5)


def plain_probabilities(model, text):
    """One byte after the other: windows of 96 bytes that start anew, the last filled with spaces."""
    data = (text or "").encode()
    total = np.zeros(len(model.languages))

    def states(way, row):
        hidden, out = len(way.state), []
        h = np.zeros(hidden)
        for byte in row:
            x, u = way.table[byte].astype(float), h @ way.state.astype(float)
            z, r = (1 / (1 + np.exp(-(x[at : at + hidden] + u[at : at + hidden]))) for at in (0, hidden))
            h = (1 - z) * h + z * np.tanh(x[2 * hidden :] + r * u[2 * hidden :])
            out.append(h)
        return out

    for at in range(0, len(data), 96):
        window = data[at : at + 96].ljust(96)
        ahead, back = states(model.forward, window), states(model.backward, window[::-1])[::-1]
        for place, byte in enumerate(data[at : at + 96]):
            if byte > 32:
                logits = np.concatenate([ahead[place], back[place]]) @ model.out + model.bias
                p = np.exp(logits - logits.max())
                total += p / p.sum()
    return total / max(total.sum(), 1e-9)


def test_query_equals_a_plain_forward_pass(spark, model, tmp_path):
    docs = [tuple(r) for r in table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text", "lang").collect()]
    docs = [d for d in docs if len(d[1]) < 1500][:60] + [(900, None, "en"), (901, " \n", "fr"), (902, "123 ..", "de"), (903, "é", None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)
    got = {r["_key"]: (r["lang_pred"], r["score"]) for r in language.predict(df, model).collect()}
    for key, text, _ in docs:
        p = plain_probabilities(model, text)
        if not any(c.isalpha() for c in text or ""):
            assert got[key] == ("und", 0.0)
        else:
            assert got[key] == (model.languages[int(p.argmax())], pytest.approx(p.max(), abs=1e-4))
