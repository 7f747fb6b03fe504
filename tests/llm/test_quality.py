from __future__ import annotations

import re
from collections import Counter

from precis.llm import quality

WORD = r"[^\x20\x09-\x0D]+"


def by_hand(text):
    text = text or ""
    words = re.findall(WORD, text)
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    twice = {w for w in windows if times[w] > 1}
    covered = {j for i, w in enumerate(windows) if w in twice for j in range(i, i + 5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_counts_agree_with_a_plain_count(documents, spark, prose):
    found = quality.assess(documents).select("doc_id", "text", "quality.counts.*", "quality.kept", "quality.broken").collect()
    assert len(found) == documents.count()
    for r in found:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == by_hand(r["text"])
        assert r["kept"] == (not r["broken"])
    repeated = " ".join([prose(7, 1)] * 3 + [prose(5, 2), "a b c d e", "a b c d e f"])
    # A very long text, whose repeats lie far apart.
    long = " ".join([prose(4000, 3), prose(9, 4), prose(4000, 5), prose(9, 4), prose(9000, 6)])
    for text in (repeated, long):
        row = quality.assess(spark.createDataFrame([(text,)], "text string")).select("quality.counts.*").first()
        assert row["n_repeat_words"] == by_hand(text)[4] > 0


def test_rules(spark):
    clean = "The cat sat on the mat and looked at the old man with a hat. " + "It was late in the day, and they went home. "
    texts = {
        "clean": clean * 1,
        "capitals": clean.upper(),
        "symbols": clean.replace(" ", "## "),
        "shouting": clean.replace(" ", "!! "),
        "bullets": "\n".join("- " + w for w in clean.split()),
    }
    df = spark.createDataFrame(list(texts.items()), "name string, text string")
    broken = {r["name"]: r["broken"] for r in quality.assess(df).select("name", "quality.broken").collect()}
    assert broken.pop("clean") == []
    assert all(name in found for name, found in broken.items())
    assert [r["name"] for r in quality.keep_good(df).collect()] == ["clean"]


def test_thresholds_are_a_table(spark):
    df = spark.createDataFrame([("a b c d e f g h i j k l",)], "text string")
    rules = (quality.Rule("short", "word_chars", "n_words", 2.0, None),)
    assert quality.assess(df, rules=rules).first()["quality"]["broken"] == ["short"]


def test_empty_table_keeps_columns(no_documents):
    assert quality.keep_good(no_documents).columns == no_documents.columns
    assert quality.assess(no_documents).count() == 0
