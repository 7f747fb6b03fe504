"""The pipeline against a plain version of every stage, on rows that need each of them."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from precis.llm.queries import tokenizer_path

WORD = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def folder(spark, prose, tmp_path_factory):
    def clean(seed, n=90):
        words = prose(n, seed).split()
        words[::6] = ["the"] * len(words[::6])
        return " ".join(words)

    rows = [(i, clean(i), "en", f"s{i % 4}") for i in range(40)]
    near = clean(3).split()
    near[40] = "changed"
    items = [(i, clean(700 + i, 30)) for i in range(4)]
    rows += [(50, clean(5), "en", "s1"), (51, " ".join(near), "en", "s9"), (52, None, "en", "s0"), (53, "too short", "en", "s0")]
    rows += [(54, clean(900).upper(), "en", "s1"), (55, clean(901) + " " + items[1][1] + " " + clean(902), "en", None)]
    rows += [(56, clean(903, 20_000), "en", "s2"), (57, clean(904), None, None), (58, clean(904), None, None)]
    path = f"{tmp_path_factory.mktemp('pipeline')}"
    docs = [(*r, len(r[1] or "")) for r in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, docs, items


def grams(text):
    words = re.findall(WORD, text.lower())
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def plain_mix(docs):
    size = {d[0]: len(re.findall(WORD, d[1])) for d in docs}
    sources = sorted({d[3] for d in docs}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size[d[0]] for d in docs if d[3] == s) for s in sources}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    target, left, open_ = {}, 1.5 * sum(size.values()), set(sources)
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * total[s]}
        if not full:
            target |= share
            break
        target |= {s: 2.0 * total[s] for s in full}
        left -= sum(target[s] for s in full)
        open_ -= full
    times = Counter()
    for s in sources:
        at = 0
        for d in sorted((d for d in docs if d[3] == s), key=lambda d: hashlib.md5(str(d[0]).encode()).hexdigest()):
            middle = at + size[d[0]] / 2
            times[d[0]] = (middle < target[s]) + (middle + total[s] < target[s])
            at += size[d[0]]
    return [d for d in docs for _ in range(times[d[0]])]


def test_run_is_the_plain_pipeline(spark, folder):
    from tokenizers import Tokenizer

    path, docs, items = folder
    good = [d for d in docs if d[0] not in (52, 53, 54)]
    unique = []
    for d in good:
        g = grams(d[1])
        if not any(100 * len(g & h) >= 80 * len(g | h) for h in (grams(u[1]) for u in unique)):
            unique.append(d)
    clean = [d for d in unique if not any(100 * len(grams(t) & grams(d[1])) >= 80 * len(grams(t)) for _, t in items)]
    assert len(good) > len(unique) > len(clean)
    mixed = sorted(plain_mix(clean), key=lambda d: d[0])
    tokens = Tokenizer.from_file(tokenizer_path())
    want, start = [], 0
    for d in mixed:
        ids = [*tokens.encode(d[1], add_special_tokens=False).ids, 0]
        want.append((d[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, path).collect())
    assert got == want and len(want) > len(clean)


def test_stages_keep_the_columns_of_documents(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder[0]).columns == docs.columns
        assert stage(spark, docs.limit(0), folder[0]).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), folder[0]).count() == 0


def test_stages_take_odd_rows_and_clashing_columns(spark, folder, documents):
    """The shared odd documents: nulls in every column, empty and very long texts, repeated rows, names that operators use."""
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, documents, folder[0])
        assert kept.columns == documents.columns and kept.schema == documents.schema
        rows = {repr(r) for r in documents.collect()}
        assert all(repr(r) in rows for r in kept.collect())
    ids = [r["doc_id"] for r in corpus_pipeline.STAGES[-1][1](spark, documents, folder[0]).collect()]
    assert sorted(map(str, ids)) == sorted(str(r["doc_id"]) for r in documents.collect())
