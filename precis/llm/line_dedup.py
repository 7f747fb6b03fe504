"""Line dedup: lines whose words are nearly those of an earlier line are removed, over the whole corpus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from precis.llm.common import mix, packed, saved, unpacked, word_hashes
from precis.llm.ngram_join import row_names

PERCENT = 80
#: Words of at least this share of all words are ordered by their counts, rarer ones come before them. Shares sum to
#: one, so there are at most 100,000 of the former, whatever the corpus.
COMMON = 100_000
_FEW = 1_000_000
_BAND = float(np.log(1.25))
#: How often a word of a hash's first bits occurs, in eighths of a power of two; 32 MB whatever the corpus.
_SLOTS, _SLICES, _EIGHTHS = 25, 10, 8
#: Groups of words expected in no more than so many lines bring lines together alone, others in twos.
_RARE = 8
#: Bits of a key that name the slice of the table it is dealt to, and how many postings a task keeps until they are sent.
_DEAL, _HELD = 12, 1 << 21
_TEXT = 1 << 22
#: How many keys of a set are looked back at to tell whether two sets have met before.
_BEFORE = 16


def word_totals(docs: DataFrame, text: str = "text") -> DataFrame:
    """`(word, n)`: how often each hashed, lower-cased word occurs; counted by task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, n, new, held = np.empty(0, np.uint64), np.empty(0, np.int64), [], 0

        def counted() -> tuple[np.ndarray, np.ndarray]:
            every = np.concatenate([words, *(w for w, _ in new)])
            often = np.concatenate([n, *(k for _, k in new)])
            by = np.argsort(every)
            every, often = every[by], often[by]
            first = np.flatnonzero(np.r_[True, every[1:] != every[:-1]]) if len(every) else np.empty(0, np.int64)
            return every[first], np.add.reduceat(often, first) if len(first) else often

        for batch in batches:
            new.append(np.unique(word_hashes(batch.column(0))[0], return_counts=True))
            held += len(new[-1][0])
            if held > _HELD:
                words, n = counted()
                new, held = [], 0
                if len(words) > _HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], names=["word", "n"])
                    words, n = words[:0], n[:0]
        words, n = counted()
        yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], names=["word", "n"])

    counted = docs.select(F.col(f"`{text}`")).mapInArrow(count, "word bigint, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _slices(rows: DataFrame) -> DataFrame:
    """`(slice, often)` of `(slice, word, n)`: for each slot of a slice how often its most frequent word occurs."""
    size = 1 << (_SLOTS - _SLICES)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[int, np.ndarray] = {}
        for batch in batches:
            slot = batch.column("word").to_numpy().view(np.uint64) >> np.uint64(64 - _SLOTS)
            often = np.minimum(np.rint(np.log2(batch.column("n").to_numpy()) * _EIGHTHS), 255).astype(np.uint8)
            for k in np.unique(slot >> np.uint64(_SLOTS - _SLICES)).tolist():
                own = (slot >> np.uint64(_SLOTS - _SLICES)) == k
                np.maximum.at(tables.setdefault(k, np.zeros(size, np.uint8)), (slot[own] & np.uint64(size - 1)).astype(np.int64), often[own])
        yield pa.RecordBatch.from_arrays([pa.array([*tables], pa.int64()), pa.array([t.tobytes() for t in tables.values()], pa.binary())], names=["slice", "often"])

    return rows.repartition("slice").mapInArrow(fill, "slice bigint, often binary")


def _common_words(docs: DataFrame, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Hashes of the common words in order, each one's place by count, how often words of each slot occur, all words' number.

    At most `COMMON` rows and the slots reach the driver. Where words share a slot, the rarer pass for as frequent: their
    order is coarser, and the same for all lines. A slot's 0 means that its only word occurs once.
    """
    totals = saved(word_totals(docs, text), "line-words")
    every = totals.agg(F.sum("n").alias("n")).first()["n"] or 0
    rows = totals.filter(F.col("n") * COMMON >= every).orderBy("n", "word").select("word").collect()
    words = np.array([r[0] for r in rows], np.int64).view(np.uint64)
    place = np.arange(len(words), dtype=np.uint64)
    order = np.argsort(words)
    often = np.zeros((1 << _SLICES, 1 << (_SLOTS - _SLICES)), np.uint8)
    repeated = totals.filter("n > 1").select(F.shiftrightunsigned("word", 64 - _SLICES).alias("slice"), "word", "n")
    for k, table in _slices(repeated).collect():
        often[k] = np.frombuffer(table, np.uint8)
    return words[order], place[order], often.reshape(-1), every


def ordered(words: np.ndarray, common: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Numbers that name the words and rise from rare to common: all rare words, by hash, then the others by count."""
    rare = words >> np.uint64(1)
    if not len(common):
        return rare
    at = np.minimum(np.searchsorted(common, words), len(common) - 1)
    return np.where(common[at] == words, np.uint64(1 << 63) | place[at], rare)


def line_sets(texts: pa.Array, common: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`(words, bounds)`: of each text, one line, its distinct words in order of rarity."""
    words, bounds = word_hashes(texts)
    names = ordered(words, common, place)
    line = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    by = np.lexsort((names, line))
    names, line = names[by], line[by]
    new = np.ones(len(names), bool)
    new[1:] = (names[1:] != names[:-1]) | (line[1:] != line[:-1])
    names, line = names[new], line[new]
    return names, np.searchsorted(line, np.arange(len(bounds)))


def _differing(n, percent: int):
    """In how many words at most a set of n words differs from a similar one of any size."""
    return (n + n * 100 // percent) * (100 - percent) // (100 + percent)


def signatures(line: np.ndarray, word: np.ndarray, often: np.ndarray, n: np.ndarray, total: int, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`(line, key, at)`: keys of which any two similar sets that aren't equal share one; `at`: which of its differing words, at most, are before it.

    Words of a set are put into as many groups by their hash as two similar sets can differ in words, and two more; words
    that occur once in the corpus stand alone. All sets of a class of sizes have the same groups, and a set is filed in both classes its partners
    may be of. Groups with the same words are one sign, signs go from rare to common by what their words' counts say, and
    of two sets that differ in d words the first sign both have is among the first d + 1 of each, the second among the
    first d + 2. So a rare sign files a set alone, a common one in twos with those after it, and a word that occurs once
    files none. `line` rises, `word` are distinct hashes within it, `often` is by slot, `n` each line's size.
    """
    least = -(-percent // (100 - percent)) if percent < 100 else 0
    out: list[list[np.ndarray]] = [[np.empty(0, np.int64)], [np.empty(0, np.uint64)], [np.empty(0, np.int64)]]
    if not least or not len(n) or n.max() < least:
        return tuple(x[0] for x in out)
    bounds = [least]
    while bounds[-1] <= n.max():
        bounds.append(-(-bounds[-1] * max(200, 10_000 // percent + 1) // 100))
    kind = np.searchsorted(bounds, n, side="right") - 1
    below = np.minimum(kind, np.maximum(np.searchsorted(bounds, -(-n * percent // 100), side="right") - 1, 0))
    for c in range(len(bounds) - 1):
        own = np.flatnonzero((kind == c) | (below == c) & (kind >= 0))
        if not len(own):
            continue
        differing = _differing(bounds[c + 1] - 1, percent)
        groups = differing + 2
        base = int(np.log2(max(total, 2) / bounds[c]) * _EIGHTHS)
        new = np.full(len(n), -1)
        new[own] = np.arange(len(own))
        at = np.flatnonzero(new[line] >= 0)
        l, w, k = new[line[at]], mix(word[at] ^ np.uint64(c + 1)), often[at].astype(np.int64)
        weight = np.maximum(1, base - k)
        alone = k == 0
        cell = l * groups + (((w >> np.uint64(32)) * np.uint64(groups)) >> np.uint64(32)).astype(np.int64)
        sums, weights = np.zeros(len(own) * groups, np.uint64), np.zeros(len(own) * groups, np.int64)
        np.add.at(sums, cell[~alone], w[~alone])
        np.add.at(weights, cell[~alone], weight[~alone])
        numbered = np.tile(mix(np.arange(groups, dtype=np.uint64) + np.uint64(c << 32)), len(own))
        sign = np.concatenate([mix(sums + numbered), w[alone]])
        of = np.concatenate([np.repeat(np.arange(len(own)), groups), l[alone]])
        weights = np.minimum(np.concatenate([weights, weight[alone]]), 65535)
        once = np.arange(len(sign)) >= len(sums)
        short = (of.astype(np.uint64) << np.uint64(44)) | ((np.uint64(65535) - weights.astype(np.uint64)) << np.uint64(28)) | (sign >> np.uint64(36))
        by = np.argsort(short)
        if len(own) >= 1 << 20 or (np.diff(short[by]) == 0).any():
            by = np.lexsort((sign, -weights, of))
        sign, of, weights, once = sign[by], of[by], weights[by], once[by]
        first = np.searchsorted(of, np.arange(len(own)))
        last = first + np.minimum(_differing(n[own], percent), differing)
        one = np.flatnonzero((np.arange(len(of)) <= last[of]) & ~once)
        strong = weights[one] >= base - int(np.log2(_RARE) * _EIGHTHS)
        weak = one[~strong]
        one = one[strong]
        more = last[of[weak]] + 1 - weak
        ends = np.cumsum(more)
        x = np.repeat(weak, more)
        y = x + 1 + np.arange(len(x)) - np.repeat(ends - more, more)
        x, y = x[~once[y]], y[~once[y]]
        out[0] += [own[of[one]], own[of[x]]]
        out[1] += [mix(sign[one]), mix(mix(sign[x]) + sign[y])]
        out[2] += [one - first[of[one]], y - 1 - first[of[y]]]
    return tuple(np.concatenate(x) for x in out)


def _sums(hashes: np.ndarray, starts: np.ndarray) -> pa.Array:
    return pa.array((np.add.reduceat(hashes, starts) if len(starts) else np.empty(0, np.uint64)).view(np.int64))


def _parity(words: np.ndarray, which: np.ndarray, starts: np.ndarray) -> list[pa.Array]:
    """128 bits per line, each flipped by every word that hashes to it: two lines differ in no more bits than words."""
    bit = mix(words ^ np.uint64(0xA24BAED4963EE407)) & np.uint64(127)
    out = []
    for half in (0, 1):
        flips = np.where(bit >> np.uint64(6) == half, np.uint64(1) << (bit & np.uint64(63)), np.uint64(0))[which]
        out.append(pa.array((np.bitwise_xor.reduceat(flips, starts) if len(starts) else np.empty(0, np.uint64)).view(np.int64)))
    return out


def split_lines(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """`(lines, text, number)`: all lines, with the break at their end, which text each is of and its number in there; a null has none."""
    texts = texts.cast(pa.large_string())
    there = np.flatnonzero(texts.is_valid().to_numpy(zero_copy_only=False))
    texts = texts.drop_null()
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2] if len(texts) and texts.buffers()[2] is not None else pa.py_buffer(b"")
    breaks = np.flatnonzero(np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] == 10) + offsets[0] + 1
    # A break at the end of a text is before an empty line of its own.
    begins, ends = np.searchsorted(breaks, offsets[:-1], side="right"), np.searchsorted(breaks, offsets[1:], side="right")
    count = ends - begins + 1
    text = np.repeat(np.arange(len(texts)), count)
    number = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    starts = np.where(number == 0, offsets[:-1][text], breaks[np.maximum(begins[text] + number - 1, 0)] if len(breaks) else 0)
    bounds = np.append(starts, offsets[-1])
    lines = pa.Array.from_buffers(pa.large_string(), len(text), [None, pa.py_buffer(bounds.astype(np.int64)), data])
    return lines, there[text], number


def _lines(docs: DataFrame, key: str, text: str, common, percent: int) -> DataFrame:
    """One row per line with a word: document, number, id, set size, 128-bit set hash, parity bits. Texts are read whole.

    Beside them rows with a `slice`: the lines' keys, packed by their first bits: next bits, step from the id before (the
    first is `base`), key's place in the line.
    """
    own = docs.select(F.col(f"`{key}`").alias("_key"), *row_names(key, text), F.col(f"`{text}`").alias("_text"))
    kind = own.schema["_key"].dataType.simpleString()
    fields = f"_key {kind}, _row bigint, _row2 bigint, line bigint, lid bigint, n bigint, h1 bigint, h2 bigint, p0 bigint, p1 bigint"
    packs = "slice bigint, base bigint, words binary, lids binary, ats binary"
    names = [f.split(" ")[0] for f in f"{fields}, {packs}".split(", ")]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, slots, total = common.value
        base, done, held = TaskContext.get().partitionId() << 32, 0, []
        types: list[pa.DataType] = []

        def rows(columns: list, packed: bool) -> pa.RecordBatch:
            some = [pa.nulls(len(columns[0]), t) for t in (types[:10] if packed else types[10:])]
            return pa.RecordBatch.from_arrays([*some, *columns] if packed else [*columns, *some], names=names)

        def packs_of(held: list) -> pa.RecordBatch:
            lids, words, ats = (np.concatenate(x) for x in zip(*held, strict=True))
            by = np.argsort(((words >> np.uint64(64 - _DEAL)) << np.uint64(33)) | lids.astype(np.uint64))
            words, lids = words[by], lids[by]
            slices = (words >> np.uint64(64 - _DEAL)).astype(np.int64)
            steps = np.diff(lids, prepend=0)
            first = np.flatnonzero((np.diff(slices, prepend=-1) != 0) | (steps >> 16 != 0))
            steps[first] = 0
            ends = np.append(first, len(words))
            low = (words >> np.uint64(40 - _DEAL)).astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]
            packed = []
            for x, size in ((low, 3), (steps.astype("<u2"), 2), (np.minimum(ats[by], 255).astype(np.uint8), 1)):
                offsets = pa.py_buffer((ends * size).astype(np.int32))
                packed.append(pa.Array.from_buffers(pa.binary(), len(first), [None, offsets, pa.py_buffer(np.ascontiguousarray(x))]))
            return rows([pa.array(slices[first]), pa.array(base + lids[first]), *packed], True)

        for batch in batches:
            if not types:
                types = [batch.schema.field("_key").type, *[pa.int64()] * 11, *[pa.binary()] * 3]
            every, document, number = split_lines(batch.column("_text"))
            bytes_ = np.frombuffer(every.buffers()[1], np.int64)
            at = 0
            while at < len(every):
                end = min(len(every), max(at + 1, int(np.searchsorted(bytes_, bytes_[at] + _TEXT))))
                words, bounds = word_hashes(every.slice(at, end - at))
                told = pa.array(words.view(np.int64)).dictionary_encode()
                names_ = told.dictionary.to_numpy().view(np.uint64)
                # Distinct words of a line lie together, lines in order.
                pairs = np.sort((np.repeat(np.arange(end - at), np.diff(bounds)) << 32) | told.indices.to_numpy())
                pairs = pairs[np.r_[True, pairs[1:] != pairs[:-1]]] if len(pairs) else pairs
                which, line = pairs & 0xFFFFFFFF, pairs >> 32
                kept, starts, n = np.unique(line, return_index=True, return_counts=True)
                line = np.repeat(np.arange(len(kept)), n)
                columns = [batch.column(c).take(pa.array(document[at:end][kept])) for c in ("_key", "_row", "_row2")]
                columns += [pa.array(number[at:end][kept]), pa.array(base + done + np.arange(len(kept))), pa.array(n)]
                columns += [_sums(mix(names_ ^ np.uint64(salt))[which], starts) for salt in (0, 0x5851F42D4C957F2D)]
                yield rows([*columns, *_parity(names_, which, starts)], False)
                often = slots[names_ >> np.uint64(64 - _SLOTS)]
                of, signs, ats = signatures(line, names_[which], often[which], n, total, percent)
                held.append((of + done, signs, ats))
                done += len(kept)
                at = end
                if sum(len(x[0]) for x in held) > _HELD:
                    yield packs_of(held)
                    held = []
        if sum(len(x[0]) for x in held):
            yield packs_of(held)

    return own.mapInArrow(measure, f"{fields}, {packs}")


def _first_lines(nodes: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """A bit for each line, whether it is the first of its set, and at which byte those of each task begin: 19 MB for 150 million lines."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lids = np.concatenate([np.empty(0, np.int64), *(b.column(0).to_numpy() for b in batches)])
        tasks, which = np.unique(lids >> 32, return_inverse=True)
        bits = []
        for i in range(len(tasks)):
            at = lids[which == i] & 0xFFFFFFFF
            own = np.zeros(int(at.max()) + 1, bool)
            own[at] = True
            bits.append(np.packbits(own, bitorder="little").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(tasks), pa.array(bits, pa.binary())], names=["task", "bits"])

    rows = nodes.select("lid", F.shiftright("lid", 32).alias("task")).repartition("task").select("lid").mapInArrow(mark, "task bigint, bits binary").collect()
    of = {r["task"]: r["bits"] for r in rows}
    sizes = [len(of.get(i, b"")) for i in range(max(of, default=-1) + 1)]
    return np.frombuffer(b"".join(of.get(i, b"") for i in range(len(sizes))), np.uint8), np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int64)


def _unpacked(column: pa.Array, kind: str, size: int) -> np.ndarray:
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(kind) if len(column) and offsets[-1] > offsets[0] else np.empty(0, kind)


def _shared(packs: DataFrame, firsts) -> DataFrame:
    """`(word, lid, at)`: the keys that several sets have, with the first line of each."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, begins = firsts.value
        words, lids, ats = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.uint8)]
        for batch in batches:
            part, base, low, steps, at = batch.columns
            low, steps, at = _unpacked(low, "u1", 3).reshape(-1, 3).astype(np.uint64), _unpacked(steps, "<u2", 2), _unpacked(at, "u1", 1)
            count = np.diff(np.frombuffer(batch.column(4).buffers()[1], np.int32)[batch.column(4).offset :][: len(part) + 1])
            first = np.cumsum(count) - count
            sums = np.cumsum(steps, dtype=np.int64)
            lid = sums + np.repeat(base.to_numpy() - sums[first], count) if len(sums) else sums
            own, task = lid & 0xFFFFFFFF, np.minimum(lid >> 32, len(begins) - 2)
            byte = begins[task] + (own >> 3)
            there = (byte < begins[task + 1]) & (task == lid >> 32)
            there[there] = (bits[byte[there]] >> (own[there] & 7).astype(np.uint8)) & 1
            word = low[:, 0] | low[:, 1] << np.uint64(8) | low[:, 2] << np.uint64(16) | np.repeat(part.to_numpy().view(np.uint64) << np.uint64(24), count)
            words.append(word[there])
            lids.append(lid[there])
            ats.append(at[there])
        word, lid, at = (np.concatenate(x) for x in (words, lids, ats))
        by = np.argsort(word)
        same = np.diff(word[by]) == 0
        by = by[np.append(same, False) | np.append(False, same)] if len(by) else by
        for i in range(0, len(by), 1 << 18):
            some = by[i : i + (1 << 18)]
            columns = [pa.array(word[some].view(np.int64)), pa.array(lid[some]), pa.array(at[some].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "lid", "at"])

    return packs.repartition("slice").mapInArrow(meet, "word bigint, lid bigint, at bigint")


def _sent_if_few(df: DataFrame) -> DataFrame:
    """A stored table of few rows, by their count, goes to all executors: some tens of megabytes."""
    return F.broadcast(df) if df.count() <= _FEW else df


def _sets(docs: DataFrame, key: str, text: str, wanted: DataFrame, common) -> DataFrame:
    """`(id, set)` of the wanted lines `(id, _row, _row2, line)`, from their texts."""
    own = docs.select(*(c.alias(f"{n}_") for c, n in zip(row_names(key, text), ("_row", "_row2"), strict=True)), F.col(f"`{text}`").alias("body"))
    if wanted.count() <= _FEW:
        wanted = F.broadcast(wanted)  # counted: some tens of megabytes
    by = wanted.groupBy("_row", "_row2").agg(F.collect_list("id").alias("ids"), F.collect_list("line").alias("numbers"))
    same = (F.col("_row_") == F.col("_row")) & (F.col("_row2_") == F.col("_row2"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, document, _ = split_lines(batch.column("body"))
            first = np.searchsorted(document, np.arange(batch.num_rows))
            ids, numbers = batch.column("ids"), batch.column("numbers")
            at = np.repeat(first, ids.value_lengths().to_numpy()) + numbers.flatten().to_numpy()
            names, bounds = line_sets(lines.take(pa.array(at)), *common.value[:2])
            sets = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(names.view(np.int64)))
            yield pa.RecordBatch.from_arrays([ids.flatten(), sets], names=["id", "set"])

    found = own.join(by, same).select("body", "ids", "numbers").mapInArrow(measure, "id bigint, set array<bigint>")
    return found.dropDuplicates(["id"])


def _similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a")
    both = left.join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.filter(shared * 100 >= (F.size("sa") + F.size("sb") - shared) * percent).select("b").distinct()


def _may_be_similar(x: str, y: str, percent: int) -> Column:
    """Whether sizes and parity bits of two sets allow it: they differ in at most (1 - p) / (1 + p) of their words."""
    n, m = F.col(f"{x}n"), F.col(f"{y}n")
    bits = F.bit_count(F.col(f"{x}p0").bitwiseXOR(F.col(f"{y}p0"))) + F.bit_count(F.col(f"{x}p1").bitwiseXOR(F.col(f"{y}p1")))
    near = F.least(n, m) * 100 >= F.greatest(n, m) * percent
    return near & (bits * (100 + percent) <= (n + m) * (100 - percent))


def _may_meet(x: str, y: str, percent: int) -> Column:
    """Whether two sets under one key may be similar and this the first that both have: no more words before it than they differ in."""
    before = F.greatest(F.col(f"{x}at"), F.col(f"{y}at")) * (100 + percent) <= (F.col(f"{x}n") + F.col(f"{y}n")) * (100 - percent)
    return before & _may_be_similar(x, y, percent)


def repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """`(_key, _row, _row2, line)`: the lines, counted from 0, to which an earlier line of the corpus is similar.

    A line's set are its lower-cased words; sets are similar when 100 * shared >= percent * union. Lines are in order
    of key (null last), text hash and number; a line is removed if any earlier one is similar, removed itself or not.
    Lines without a word are never removed. Rows that agree in key and text are one document.

    Equal sets are one node with the place of their first line. Each is filed under the rare ones of its signs, words and
    groups of words, by which any similar set meets it; only keys that several lines have leave the lines' own task
    again. Each set is first held against the earliest of its size under most of its keys: that settles groups of near
    copies with a pair per member. What isn't settled is held against every earlier set under its keys that size,
    positions and parity bits allow, and the pairs are verified on whole sets.
    """
    spark = docs.sparkSession
    common = spark.sparkContext.broadcast(_common_words(docs, text))
    every = saved(_lines(docs, key, text, common, percent), "line-features")
    lines = every.filter("slice IS NULL")
    first = F.min(F.struct(F.col("_key").isNull(), "_key", "_row", "_row2", "line", "lid", "n", "p0", "p1")).alias("first")
    nodes = lines.groupBy("h1", "h2").agg(first, (F.count("*") > 1).alias("several")).select("h1", "h2", "first.*", "several")
    by = [F.col("_key").asc_nulls_last(), F.col("_row"), F.col("_row2"), F.col("line")]
    # Ids rise from part to part and inside them, so they are in the order of the lines.
    nodes = nodes.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("id", F.monotonically_increasing_id())
    nodes = saved(nodes.select("h1", "h2", "lid", "n", "p0", "p1", "_row", "_row2", "line", "several", "id"), "line-nodes")

    # Of two similar sets the larger is at most 1.25 times as large for 80: they lie in one band or in two next to each other.
    step = float(np.log(100 / percent)) if percent < 100 else _BAND
    band = F.floor(F.log(F.col("n").cast("double")) / step + 1e-9).cast("int")
    firsts = spark.sparkContext.broadcast(_first_lines(nodes))
    shared = _shared(every.filter("slice IS NOT NULL").select("slice", "base", "words", "lids", "ats"), firsts)
    filed = shared.join(nodes.select("lid", "id", "n", "p0", "p1"), "lid").select("word", band.alias("band"), "id", "at", "n", "p0", "p1")
    word, side = Window.partitionBy("word"), F.struct("id", "at", "n", "p0", "p1")
    ways = {"low": F.min(side).over(word), "last": F.max(side).over(word), "size": F.count("*").over(word), "lead": F.min(side).over(Window.partitionBy("word", "band"))}
    filed = filed.repartition("word").withColumns(ways)
    # Two that can't be similar have nothing to do with each other; nor has a set that leads its key any before it.
    filed = filed.filter((F.col("low.id") < F.col("last.id")) & ((F.col("size") > 2) | _may_meet("low.", "last.", percent)))
    lead = F.when((F.col("lead.id") < F.col("id")) & _may_meet("lead.", "", percent), F.col("lead.id")).alias("lead")
    members = saved(filed.select("word", "id", "at", "n", "p0", "p1", lead, (F.col("low.id") < F.col("id")).alias("later")), "line-members")
    votes = members.filter("lead IS NOT NULL").groupBy("id", "lead").agg(F.count("*").alias("times"))
    star = votes.groupBy("id").agg(F.max(F.struct("times", (-F.col("lead")).alias("lead"))).alias("most"))
    pairs = saved(star.select((-F.col("most.lead")).alias("a"), F.col("id").alias("b")), "line-pairs")
    place = nodes.select("id", "_row", "_row2", "line")
    ends = lambda p: p.select(F.col("a").alias("id")).union(p.select("b")).distinct()
    sets = saved(_sets(docs, key, text, saved(place.join(_sent_if_few(saved(ends(pairs), "line-ends")), "id"), "line-wanted"), common), "line-sets")
    gone = saved(_similar(pairs, sets, percent), "line-gone")

    told = members.join(_sent_if_few(gone), members["id"] == gone["b"], "left").select(members["*"], (F.col("later") & F.col("b").isNull()).alias("open"))
    left = saved(told.filter("open").select("word").distinct(), "line-open")
    # Two sets meet under the first key they share, not under each: a row has the keys before its own that open sets have.
    before = F.collect_list("word").over(Window.partitionBy("id").orderBy("at", "word").rowsBetween(-_BEFORE, -1)).alias("before")
    near = told.join(_sent_if_few(left), "word", "left_semi").select("word", "id", "at", "n", "p0", "p1", "open", before)
    near = saved(near, "line-near")
    x, y = near.drop("open").alias("x"), _sent_if_few(saved(near.filter("open").drop("open"), "line-open")).alias("y")
    # Rows aren't filed under their neighbours' bands: sizes are compared in the join, and a row is dealt out once.
    same = (F.col("x.word") == F.col("y.word")) & (F.col("x.id") < F.col("y.id"))
    met = ~F.arrays_overlap("x.before", "y.before")
    rest = x.join(y, same & _may_meet("x.", "y.", percent) & met).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()
    rest = saved(rest.join(pairs, ["a", "b"], "left_anti"), "line-rest")
    new = saved(ends(rest).join(sets.select("id"), "id", "left_anti"), "line-ends")
    more = saved(place.join(_sent_if_few(new), "id"), "line-wanted")
    sets = sets.union(saved(_sets(docs, key, text, more, common), "line-sets"))
    gone = saved(gone.union(_similar(rest, sets, percent)).distinct(), "line-gone")
    for sent in (common, firsts):
        sent.unpersist()

    removed = nodes.join(_sent_if_few(gone), nodes["id"] == gone["b"], "left").filter(F.col("b").isNotNull() | F.col("several"))
    own = removed.select("h1", "h2", F.struct("_row", "_row2", "line").alias("first"), F.col("b").isNotNull().alias("late"))
    out = lines.select("_key", "_row", "_row2", "line", "h1", "h2").join(_sent_if_few(saved(own, "line-removed")), ["h1", "h2"])
    again = F.struct("_row", "_row2", "line") != F.col("first")
    return out.filter(F.col("late") | again).select("_key", "_row", "_row2", "line").distinct()


def removed_by_document(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """`(_row, _row2, removed)`: the sorted numbers of the removed lines of each document that loses some."""
    lost = repeated_lines(docs, key, text, percent)
    return lost.groupBy("_row", "_row2").agg(F.sort_array(F.collect_list("line")).alias("removed"))


def drop_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The documents with their own columns and the removed lines cut from the text; null texts stay null."""
    lost = saved(removed_by_document(docs, key, text, percent), "line-lost")
    own = docs.select(packed(docs), *row_names(key, text)).join(lost, ["_row", "_row2"], "left")
    body = F.col("_r").getField(text)
    every = F.transform(F.split(body, "\n"), lambda x, i: F.struct(i.cast("long").alias("i"), x.alias("x")))
    kept = F.filter(every, lambda s: ~F.array_contains("removed", s["i"]))
    left = F.when(F.col("removed").isNull(), body).otherwise(F.array_join(F.transform(kept, lambda s: s["x"]), "\n"))
    return own.select(*unpacked(docs, **{text: left}))
