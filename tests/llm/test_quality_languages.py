"""The stop-word rule holds only where a language has a list."""

from __future__ import annotations

from precis.llm import quality


def test_languages_without_a_list_pass(spark, prose):
    russian = " ".join("слово" + chr(1072 + i % 32) + chr(1072 + i // 32) for i in range(80))
    words = prose(80, 1)
    rows = [("ru", russian), (None, russian), ("pl", words), ("en", words), ("en-US", words), (None, words), ("DE", russian), (None, "12 " * 9 + words)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id int, lang string, text string")
    broken = {r["doc_id"]: "stop_words" in r["quality"]["broken"] for r in quality.assess(df, lang="lang").collect()}
    assert broken == {0: False, 1: False, 2: False, 3: True, 4: True, 5: True, 6: True, 7: True}
    assert sorted(r["doc_id"] for r in quality.keep_good(df, lang="lang").collect()) == [0, 1, 2]
    # By letters alone where no column names the language.
    assert [r["doc_id"] for r in quality.keep_good(df).collect()] == [0, 1, 6]
