from __future__ import annotations

from collections import Counter, defaultdict

import pytest

from precis.llm import mixing


def test_words_taken_come_near_the_targets(documents):
    rows = mixing.plan(documents).collect()
    assert sum(r["_copies"] for r in rows) == documents.count()
    taken, target, largest, size = Counter(), {}, Counter(), {}
    for r in rows:
        s = r["_source"]
        taken[s] += r["_size"] * len(r["_positions"]) * r["_copies"]
        target[s], size[s] = r["_target"], r["_source_size"]
        largest[s] = max(largest[s], r["_size"] * r["_copies"])
        assert len(r["_positions"]) <= 2
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()))
    for s in target:
        assert target[s] <= 2 * size[s] + 1e-9
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-9
    assert rows and sorted(map(str, rows)) == sorted(map(str, mixing.plan(documents.repartition(5)).collect()))


def test_targets_by_sharing_again_and_again(spark):
    sizes = {"a": 1000, "b": 10, "c": 500, "d": 3, "é": 0, None: 70}
    df = spark.createDataFrame(list(sizes.items()), "_source string, _source_size long")
    got = {r["_source"]: r["_target"] for r in mixing.source_targets(df).collect()}
    names = [*sorted(k for k in sizes if k is not None), None]
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    want, left, open_ = {}, 1.5 * sum(sizes.values()), set(names)
    while open_:
        share = {n: left * weight[n] / sum(weight[m] for m in open_) for n in open_}
        full = {n for n in open_ if share[n] > 2 * sizes[n]}
        if not full:
            want.update(share)
            break
        for n in full:
            want[n] = 2 * sizes[n]
            left -= want[n]
        open_ -= full
    assert got == pytest.approx(want)


def test_positions_follow_the_schedule(spark, prose):
    rows = [(i, prose(50, i), "ab"[i % 2]) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    early = mixing.Schedule(((0.0, 2.0), (0.5, 2.0), (1.0, 0.0)))
    late = mixing.Schedule(((0.0, 0.0), (1.0, 3.0)))
    out = mixing.mix(df, schedules=(early, late), budget_percent=100)
    order = [(r["position"], r["source"]) for r in out.collect()]
    assert order == sorted(order, key=lambda x: x[0]) and all(0 <= p <= 1 for p, _ in order)
    by = defaultdict(list)
    for p, s in order:
        by[s].append(p)
    # Two thirds of the first schedule's area lie before the middle of the run, a quarter of the second's.
    assert sum(p < 0.5 for p in by["a"]) / len(by["a"]) == pytest.approx(2 / 3, abs=0.03)
    assert sum(p < 0.5 for p in by["b"]) / len(by["b"]) == pytest.approx(1 / 4, abs=0.03)


def test_mix_repeats_rows_whole(documents):
    plan = {(r["_key"], r["_hash"]): len(r["_positions"]) for r in mixing.plan(documents).collect()}
    out = mixing.mix(documents)
    assert out.columns == [*documents.columns, "position"]
    taken = Counter(r["doc_id"] for r in out.collect())
    rows = Counter(r["doc_id"] for r in documents.collect())
    for (key, _), passes in plan.items():
        assert taken[key] == passes * rows[key]
    assert mixing.mix(documents, position=None).columns == documents.columns


def test_empty_and_wordless_tables(spark, no_documents):
    assert mixing.mix(no_documents).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert {(r["_size"], r["_target"]) for r in mixing.plan(blank).collect()} == {(0, 0.0)}


def test_schedules_are_checked():
    with pytest.raises(ValueError):
        mixing.Schedule(((0.0, 1.0), (0.9, 1.0)))
    with pytest.raises(ValueError):
        mixing.Schedule(((0.0, 0.0), (1.0, 0.0)))
