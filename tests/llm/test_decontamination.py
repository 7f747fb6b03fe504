from __future__ import annotations

import re

from precis.llm import decontamination


def words_of(text):
    return re.findall(r"[^\W_]+", re.sub("([\u4e00-\u9fff\u3040-\u30ff])", r" \1 ", (text or "").lower()))


def grams(text, sizes=(5,)):
    words = words_of(text)
    return {tuple(words[i : i + n]) for n in sizes for i in range(len(words) - n + 1)}


def item_grams(text):
    words = words_of(text)
    return {tuple(words)} if 0 < len(words) < 5 else grams(text)


def test_finds_every_item_contained(spark, prose, documents, no_documents):
    items = [(i, prose(12 + 5 * i, 1000 + i)) for i in range(8)] + [(90, "too short"), (89, "Word"), (88, "four words, no more"), (87, "今天天气很好。我们去公园散步吧"), (86, "你好"), (85, "..."), (91, None), (92, ""), (None, prose(20, 77))]
    long = prose(20_000, 5)
    docs = [(100 + i, long[:400] + " " + (text or "") + " " + long[400:]) for i, (_, text) in enumerate(items)]
    docs += [(500, "it is too, SHORT"), (501, "short too"), (502, "a wordy text"), (503, "我说:你好!"), (504, "你们好"), (505, "他说今天天气很好。我们去公园散步吧!"), (506, "word")]
    docs += [(507, "今天 天气 很好 我们 去 公园 散步 吧")]
    cut = lambda t, share: " ".join(t.split()[: max(1, int(len(t.split()) * share))])
    docs += [(200 + i, prose(30, i) + "\n" + cut(items[i][1], 0.9) + ", " + prose(9, i)) for i in range(8)]
    docs += [(300 + i, cut(items[i][1], 0.7)) for i in range(8)]
    docs += [(400, items[3][1].upper().replace(" ", ", \n")), (401, None), (402, ""), (None, items[2][1]), (403, items[1][1]), (403, items[1][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["_key"], r["_item"], r["_n"], r["_shared"]) for r in decontamination.search(df, bench).collect()}
    want = set()
    for d, text in docs:
        for i, item in items:
            g = item_grams(item)
            held = grams(text, (1, 2, 3, 4, 5))
            if g and 100 * len(g & held) >= 80 * len(g):
                want.add((d, i, len(g), len(g & held)))
    assert got == want and len(want) >= 25
    kept = decontamination.decontaminate(df, bench)
    dirty = {d for d, *_ in want}
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(d) for d, _ in docs if d not in dirty)
    assert decontamination.decontaminate(documents, bench).columns == documents.columns
    assert decontamination.search(no_documents, bench).count() == 0
    assert decontamination.decontaminate(documents, bench.limit(0)).count() == documents.count()
