from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from precis.llm import line_dedup, ngram_join
from precis.llm.common import shingle_sets, word_hashes
from precis.llm.components import components

WORD = r"[^\x20\x09-\x0D]+"


def words_of(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def grams(text):
    words = words_of(text)
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def groups(rows):
    """Component (least key) of each row by comparing all pairs; keys are row numbers here."""
    sets = [grams(t) for t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * shared >= 80 * (len(sets[i]) + len(sets[j]) - shared):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [len(s) for s in sets], [root(i) for i in range(len(rows))]


def edited(text, share, seed):
    rng = random.Random(seed)
    return " ".join(f"e{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split(" "))


@pytest.fixture(scope="module")
def texts(prose, corpus):
    out = [t for _, t, *_ in corpus]
    for size, share, copies in ((3, 0.1, 4), (9, 0.03, 12), (40, 0.02, 30), (150, 0.012, 40), (700, 0.012, 25), (3000, 0.01, 8)):
        base = prose(size, size)
        out += [base, *(edited(base, share, 100 * size + i) for i in range(copies))]
    passage = prose(80, 4242)
    out += [passage + " " + prose(60, 9000 + i) for i in range(40)]
    # A chain: each is similar to the next, the ends are not.
    base = prose(200, 31).split()
    for k in range(12):
        base[3 + 15 * k] = f"chain{k}"
        out.append(" ".join(base))
    out += ["a b c d", "a b c d e", "A b  c d", "b b b b b b b b", "b b b b b b"]
    return out


def test_components_are_those_of_all_pairs(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    sizes, want = groups(texts)
    got = {r["_key"]: (r["n"], r["component"]) for r in ngram_join.near_duplicates(df).collect()}
    assert len(got) == len(texts)
    assert got == {i: (n, c) for i, (n, c) in enumerate(zip(sizes, want, strict=True))}
    assert len(set(want)) < len(texts) - 100
    kept = sorted(r["doc_id"] for r in ngram_join.keep_one(df).collect())
    assert kept == sorted(i for i, c in enumerate(want) if i == c)


def test_other_thresholds(spark, texts):
    some = texts[18:90]
    df = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string")
    sets = [grams(t) for t in some]
    got = {r["_key"]: r["component"] for r in ngram_join.near_duplicates(df, percent=100).collect()}
    assert got == {i: next(j for j in range(len(some)) if sets[j] == s) if s else i for i, s in enumerate(sets)}


def test_repeated_rows_nulls_and_names(spark, documents, no_documents):
    got = ngram_join.near_duplicates(documents).collect()
    assert len(got) == documents.count()
    by_key = {}
    for r in got:
        by_key.setdefault(r["_key"], set()).add(r["component"])
    # Equal words in other case and spacing; a null key takes the group's least key.
    assert by_key[20] == by_key[22] == by_key[21] == {0} and by_key[None] == {3} and by_key[27] == {26}
    assert by_key[23] == {23} and by_key[24] == {24} and by_key[25] == {25} and by_key[31] == {31}
    kept = ngram_join.keep_one(documents)
    assert kept.columns == documents.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [*range(8), 23, 24, 25, 26, 28, 29, 30, 31]
    assert ngram_join.near_duplicates(no_documents).count() == 0 == ngram_join.keep_one(no_documents).count()


def test_originals_lead_their_copies_in_two_rounds(spark, prose, monkeypatch):
    """Copies too far apart to be linked used to take a round more the larger their group was."""
    base = [prose(300, 5000 + b) for b in range(3)]
    rows = base + [edited(t, 0.004 * (1 + i % 20), 77 * b + i) for b, t in enumerate(base) for i in range(120)]
    seen = []
    plain = ngram_join.saved

    def watched(df, name):
        out = plain(df, name)
        seen.append((name, out.count()))
        return out

    monkeypatch.setattr(ngram_join, "saved", watched)
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(5)
    got = {r["_key"]: r["component"] for r in ngram_join.near_duplicates(df).collect()}
    assert got == dict(enumerate(groups(rows)[1]))
    assert [name for name, _ in seen].count("ngram-found") == 2
    # The first round has a pair per set at most, and links nearly all that is linked.
    first, second = (n for name, n in seen if name == "ngram-found")
    assert first <= len(rows) and second <= first / 10


def test_leaders_share_keys_with_the_most(spark):
    keys = {1: [10, 11, 12, 13], 5: [10, 11], 6: [11, 12], 7: [12, 13, 14], 9: [14]}
    counts = {k: sum(k in v for v in keys.values()) for k in range(10, 15)}
    rows = [(k, h, counts[k]) for h, own in keys.items() for k in own]
    members = spark.createDataFrame(rows, "k long, h1 long, times long")
    got = {r["h1"]: r["lead"] for r in ngram_join._leaders(members).collect()}
    assert got == {5: 1, 6: 1, 7: 1, 9: 7}


def test_keys_of_similar_sets_meet():
    rng = np.random.default_rng(3)
    for n in (1, 4, 5, 17, 63, 64, 200, 255, 256, 900, 1024, 4000):
        for _ in range(12):
            a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            apart = int(rng.integers(0, ngram_join.most_apart(n, n) + 1))
            out = int(rng.integers(0, apart + 1))
            b = np.unique(np.concatenate([a[rng.permutation(len(a))][out:], rng.integers(0, 1 << 63, apart - out).astype(np.uint64)]))
            shared = len(np.intersect1d(a, b))
            if len(b) and 100 * shared >= 80 * (len(a) + len(b) - shared):
                assert len(np.intersect1d(ngram_join.keys_of(a), ngram_join.keys_of(b))), (n, apart, out)
                bits = np.unpackbits((ngram_join.parity(a) ^ ngram_join.parity(b)).view(np.uint8)).sum()
                assert bits <= len(a) + len(b) - 2 * shared


def test_words_and_shingles_of_whole_texts(corpus, monkeypatch):
    from precis.llm import common

    texts = [t for _, t, *_ in corpus] + ["a" * 300 + " b", " lead", "trail \x0b\x0c"]
    words, bounds = word_hashes(pa.array(texts, pa.string()))
    assert np.diff(bounds).tolist() == [len(words_of(t)) for t in texts]
    names = {}
    for t, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True):
        for w, h in zip(words_of(t), words[a:b].tolist(), strict=True):
            assert names.setdefault(w, h) == h
    assert len(set(names.values())) == len(names)
    monkeypatch.setattr(common, "_PIECE", 100)  # cut into small pieces, all the same
    again, same = word_hashes(pa.array(texts, pa.string()))
    assert (again == words).all() and (same == bounds).all()
    assert [len(s) for s in shingle_sets(pa.array(texts, pa.string()))] == [len(grams(t)) for t in texts]
    sliced = pa.array([None, "x y", *texts], pa.string()).slice(2)
    assert (word_hashes(sliced)[0] == words).all()


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 540)] + [(9, 3), (3, 9), (7, 7), (None, 4)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 161)} == {100} and {got[i] for i in range(500, 540)} == {500}
    assert (got[3], got[9], got[7]) == (3, 3, 7) and None not in got and 4 not in got


# Lines


def removed(rows):
    seen, out = [], {}
    for key, text in rows:
        for i, line in enumerate((text or "").split("\n")):
            s = frozenset(words_of(line))
            if s:
                if any(100 * len(s & o) >= 80 * len(s | o) for o in seen):
                    out.setdefault(key, []).append(i)
                seen.append(s)
    return out


@pytest.fixture(scope="module")
def pages_of_lines(prose):
    rng = random.Random(5)
    bases = [prose(n, 70 + n) for n in (1, 2, 4, 5, 6, 9, 15, 25, 60, 300)]
    rows = []
    for key in range(60):
        lines = [edited(rng.choice(bases), 0.04, key * 50 + i) for i in range(8)] + [prose(12, 10_000 + key), "", "  \t"]
        rng.shuffle(lines)
        rows.append((key, "\n".join(lines)))
    return [*rows, (60, None), (61, ""), (62, "\n\n"), (63, "W1 w2\nw2  W1\r\nw2 w1 w1")]


def test_lines_removed_are_those_of_all_pairs(spark, pages_of_lines):
    df = spark.createDataFrame(pages_of_lines, "doc_id long, text string").repartition(4)
    want = removed(pages_of_lines)
    got = {}
    for r in line_dedup.repeated_lines(df).collect():
        got.setdefault(r["_key"], []).append(r["line"])
    assert {k: sorted(v) for k, v in got.items()} == want and sum(map(len, want.values())) > 200
    left = {r["doc_id"]: r["text"] for r in line_dedup.drop_repeated_lines(df).collect()}
    for key, text in pages_of_lines:
        lines = None if text is None else [x for i, x in enumerate(text.split("\n")) if i not in want.get(key, [])]
        assert left[key] == (None if lines is None else "\n".join(lines))


def test_lines_of_odd_documents(documents, no_documents):
    out = line_dedup.drop_repeated_lines(documents)
    assert out.columns == documents.columns and out.count() == documents.count()
    texts = {}
    for r in out.collect():
        texts.setdefault(r["doc_id"], []).append(r["text"])
    # Rows that agree in key and text are one document.
    assert texts[31] == ["tie tie tie\n"] * 2 and texts[23] == [None] and texts[25] == [" \n\t "] and texts[20] == [""]
    assert texts[None] == [""] and texts[27] == [""]
    assert line_dedup.drop_repeated_lines(no_documents).count() == 0


def test_words_go_from_rare_to_common():
    words = np.array([5 << 1, 9 << 1, 3 << 1, 7 << 1], np.uint64)
    common, place = np.array([9 << 1, 7 << 1], np.uint64), np.array([1, 0], np.uint64)
    order = np.argsort(common)
    names = line_dedup.ordered(words, common[order], place[order])
    assert np.argsort(names).tolist() == [2, 0, 3, 1]


def test_lines_are_dealt_out_once(spark, prose, monkeypatch):
    """Rows of unsettled lines used to be filed under three size bands each, which took most of the disk."""
    lines = [prose(n, 700 + n) for n in range(8, 30)]
    rows = [(i, "\n".join([t, edited(t, 0.05, i), edited(t, 0.3, 90 + i)])) for i, t in enumerate(lines)]
    plans = {}
    plain = line_dedup.saved

    def watched(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return plain(df, name)

    monkeypatch.setattr(line_dedup, "saved", watched)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["_key"], r["line"]) for r in line_dedup.repeated_lines(df).collect()}
    assert got == {(k, i) for k, own in removed(rows).items() for i in own}
    assert "Generate" not in plans["line-rest"]


@pytest.mark.parametrize("percent", [80, 60])
def test_similar_sets_share_a_key(percent):
    rng = np.random.default_rng(8)
    often = np.concatenate([np.zeros(4000), rng.integers(8, 120, 400)]).astype(np.uint8)
    sets, once = [], 0
    for n in (3, 4, 5, 7, 8, 9, 15, 16, 17, 20, 31, 33, 64, 80, 130, 300):
        base = rng.choice(np.arange(4000, 4400), n, replace=False)
        for _ in range(12):
            new = int(rng.integers(0, n // 9 + 2))
            some = rng.choice(np.arange(4000, 4400), rng.integers(0, n // 9 + 2))
            sets.append(np.unique(np.concatenate([base[rng.random(n) > rng.random() / 6], np.arange(once, once + new), some])))
            once += new
    sets = [s for s in sets if len(s)]
    hashes = rng.integers(0, 1 << 63, 4400).astype(np.uint64)
    n = np.array([len(s) for s in sets])
    line, word = np.repeat(np.arange(len(sets)), n), np.concatenate(sets)
    of, keys, at = line_dedup.signatures(line, hashes[word], often[word], n, 100_000, percent)
    own = [{} for _ in sets]
    for i, k, a in zip(of.tolist(), keys.tolist(), at.tolist(), strict=True):
        own[i][k] = a
    found = 0
    for i, x in enumerate(sets):
        for j in range(i):
            shared = len(np.intersect1d(x, sets[j]))
            if 100 * shared >= percent * (len(x) + len(sets[j]) - shared) and shared < max(len(x), len(sets[j])):
                most = (len(x) + len(sets[j])) * (100 - percent) // (100 + percent)
                assert any(own[i][k] <= most and own[j][k] <= most for k in own[i].keys() & own[j].keys())
                found += 1
    assert found > 20


def test_lines_that_share_common_words_only_are_not_filed_together(spark, prose, monkeypatch):
    """A row per rare word of a line used to be stored: words that many lines have brought all of them together."""
    rows = [(i, "\n".join(prose(40, 5000 + 20 * i + k) for k in range(20))) for i in range(30)]
    rows.append((40, rows[3][1].split("\n")[5] + " more"))
    sizes = {}
    plain = line_dedup.saved

    def watched(df, name):
        out = plain(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(line_dedup, "saved", watched)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {(r["_key"], r["line"]) for r in line_dedup.repeated_lines(df).collect()}
    assert got == {(k, i) for k, own in removed(rows).items() for i in own} == {(40, 0)}
    assert sizes["line-nodes"] == 601 and sizes["line-members"] < 601


def test_lines_are_split_as_by_spark(spark):
    texts = [None, "", "a", "\n", "a\n", "\na\n\nb", "é\n日本\n", None, "x y"]
    lines, text, number = line_dedup.split_lines(pa.array(["0", *texts, "1\n2"], pa.string()).slice(1, len(texts)))
    want = [(i, k, x) for i, t in enumerate(texts) if t is not None for k, x in enumerate(t.split("\n"))]
    assert [(i, k, x.removesuffix("\n")) for i, k, x in zip(text.tolist(), number.tolist(), lines.to_pylist(), strict=True)] == want
