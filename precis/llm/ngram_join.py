"""N-gram Jaccard join: near-duplicate documents by parity sketches, verified on their shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precis.llm.common import SPACES, mix, packed, saved, shingle_sets, unpacked
from precis.llm.components import components

SHINGLE = 5
PERCENT = 80
_BAND = 2
_PARITY_WORDS = 8
# A table is sent to all executors up to about this many bytes, counted before; a row of numbers takes about 64 bytes
# there, one with its parity bits 192.
_SENT = 32 * 1024 * 1024
_NARROW, _WIDE = 64, 192


def band_start(n: int) -> int:
    """Sizes fall into bands [1, 2), [2, 4), [4, 8), ...: the first size of n's band."""
    return 1 << (n.bit_length() - 1)


def most_apart(n: int, other: int, percent: int = PERCENT) -> int:
    """How many shingles may be in one of two sets of these sizes only, if their Jaccard similarity suffices.

    With I shared of U in all, I >= p U gives U - I <= (1 - p) U and n + other = U + I >= (1 + p) U.
    """
    return (100 - percent) * (n + other) // (100 + percent)


def keys_of(shingles: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The keys under which a document is looked for, in every size band that a larger partner can be in.

    In a band each shingle belongs to one of m cells, and a cell holds the exclusive or of its shingles' hashes: a
    shingle that only one of two documents has changes one cell, so no more cells differ than shingles do (at most d).
    Put in an order that depends on a cell's content only, the first d + 1 of the cells that hold something must have
    one in common; those are the keys. There are a quarter more cells than may differ in the band, so a cell holds
    several shingles, and those with many come first: a passage that many documents share is rarely a whole cell of them.
    """
    n, out = len(shingles), []
    start = band_start(n) if n else 0
    while n and start * percent <= n * 100:
        most = min(start * _BAND - 1, n * 100 // percent)
        wanted = most_apart(n, most, percent) + 1
        apart = most_apart(start * _BAND - 1, start * _BAND - 1, percent)
        cells = np.uint64(apart + 1 + apart // 4)
        seed = mix(np.array([start], np.uint64))[0]
        own = mix(shingles ^ seed)
        cell = (own % cells).astype(np.int64)
        order = np.argsort(cell, kind="stable")
        at = np.flatnonzero(np.diff(cell[order], prepend=-1))
        held = np.bitwise_xor.reduceat(own[order], at)
        size = np.diff(np.append(at, n))
        value = mix(held ^ mix(cell[order][at].astype(np.uint64) ^ seed))
        out.append(value[np.lexsort((value, -size))[:wanted]])
        start *= _BAND
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def parity(shingles: np.ndarray) -> np.ndarray:
    """512 bits, each flipped once by every shingle that hashes to it: they differ in no more bits than shingles do."""
    bits = (np.bincount((shingles & np.uint64(511)).astype(np.int64), minlength=512) & 1).astype(np.uint8)
    return np.packbits(bits, bitorder="little").view("<i8")


def _hashed(sets: list[np.ndarray]) -> list[pa.Array]:
    """Two 64-bit sums over the mixed hashes of each set."""
    return [
        pa.array([mix(s ^ np.uint64(salt)).sum(dtype=np.uint64).astype(np.int64) for s in sets], pa.int64())
        for salt in (0, 0x5851F42D4C957F2D)
    ]


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = np.concatenate(rows).view(np.int64) if rows else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int64()))


def row_names(key: str, text: str) -> list[Column]:
    """Two hashes that name a row by its key and text; equal rows have one name."""
    k, t = F.col(f"`{key}`"), F.col(f"`{text}`")
    return [F.xxhash64(k, t).alias("_row"), F.xxhash64(t, k, F.lit(1)).alias("_row2")]


def features(docs: DataFrame, key: str, text: str, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row: its name, set size, a 128-bit hash of the shingle set, the keys and the parity bits; of whole texts."""
    own = docs.select(F.col(f"`{key}`").alias("_key"), *row_names(key, text), F.col(f"`{text}`").alias("_text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, sums, keys, bits = [], [[], []], [], []
            for s in shingle_sets(batch.column("_text"), shingle):
                sizes.append(len(s))
                for out, hashed in zip(sums, _hashed([s]), strict=True):
                    out.append(hashed[0].as_py())
                keys.append(keys_of(s, percent))
                bits.append(parity(s))
            held = [pa.array(sizes, pa.int64()), *(pa.array(x, pa.int64()) for x in sums), _lists(keys), _lists(bits)]
            names = ["_key", "_row", "_row2", "n", "h1", "h2", "keys", "parity"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:3]), *held], names=names)

    kind = own.schema["_key"].dataType.simpleString()
    schema = f"_key {kind}, _row bigint, _row2 bigint, n bigint, h1 bigint, h2 bigint, keys array<bigint>, parity array<bigint>"
    return own.mapInArrow(measure, schema)


def _sets_of(docs: DataFrame, key: str, text: str, wanted: DataFrame, shingle: int) -> DataFrame:
    """`(id, set)` of the wanted sets, given as `(id, rep, h1, h2)` with one document each; shingles only those texts.

    A set comes once for each row of that document's key with such a text."""
    own = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    few = wanted.count() * _NARROW <= _SENT
    names, wanted = wanted.select("rep").distinct(), wanted.select("id", "h1", "h2")
    if few:
        names, wanted = F.broadcast(names), F.broadcast(wanted)
    near = own.join(names, own["_key"].eqNullSafe(names["rep"]), "left_semi")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch.column("_text"), shingle))
            yield pa.RecordBatch.from_arrays([*_hashed(sets), _lists(sets)], names=["h1", "h2", "set"])

    found = near.mapInArrow(measure, "h1 bigint, h2 bigint, set array<bigint>")
    return found.join(wanted, ["h1", "h2"]).select("id", "set")


def _may_link(a: str, b: str, percent: int) -> Column:
    """Whether sizes and parity bits of two sets allow a link; misses none."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    bits = sum((F.bit_count(F.get(F.col(f"{a}.parity"), F.lit(i)).bitwiseXOR(F.get(F.col(f"{b}.parity"), F.lit(i)))) for i in range(_PARITY_WORDS)), F.lit(0))
    near = F.least(n, m) * 100 >= F.greatest(n, m) * percent
    return near & (bits * (100 + percent) <= (n + m) * (100 - percent))


def _verified(pairs: DataFrame, docs: DataFrame, key: str, text: str, nodes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The stored pairs `(a, b)` of set numbers whose shingle sets are similar enough, counted exactly.

    Sets are made from their texts, and both of a pair's go straight to the pair: no set is stored or moved before."""
    ends = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("id"))
    wanted = saved(nodes.join(_sent_if_few(ends.select("id").distinct()), "id", "left_semi").select("id", "rep", "h1", "h2"), "ngram-wanted")
    own = _sets_of(docs, key, text, wanted, shingle).join(_sent_if_few(ends), "id")
    one = [F.first(F.when(F.col("id") == F.col(c), F.col("set")), ignorenulls=True).alias(f"s{c}") for c in ("a", "b")]
    both = own.groupBy("a", "b").agg(*one)
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.filter(shared * 100 >= (F.size("sa") + F.size("sb") - shared) * percent).select("a", "b")


def _sent_if_few(df: DataFrame, row_bytes: int = _NARROW) -> DataFrame:
    """A stored table of few bytes (by a count of its rows) goes to all executors; others are shuffled."""
    return F.broadcast(df) if df.count() * row_bytes <= _SENT else df


def _close(pairs: DataFrame, sides: DataFrame, percent: int) -> DataFrame:
    """The distinct pairs `(a, b)`, the lesser number first, that sizes and parity bits leave possible."""
    ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    sides = _sent_if_few(sides, _WIDE)
    both = ordered.join(sides.select(F.col("id").alias("a"), F.col("s").alias("s1")), "a")
    both = both.join(sides.select(F.col("id").alias("b"), F.col("s").alias("s2")), "b")
    return both.filter(_may_link("s1", "s2", percent)).select("a", "b")


def _leaders(members: DataFrame) -> DataFrame:
    """`(h1, lead)`: each set with one that it shares keys with, other than itself.

    A key is led by that of its sets which shares its keys with the most others, as the original among its edited copies
    does; a set goes to the one that leads most of its keys."""
    weights = members.groupBy("h1").agg(F.sum("times").alias("weight"))
    weighed = members.select("k", "h1").join(_sent_if_few(saved(weights, "ngram-weights")), "h1")
    best = weighed.groupBy("k").agg(F.max(F.struct("weight", "h1")).alias("best")).select("k", F.col("best.h1").alias("lead"), "best.weight")
    led = members.select("k", "h1").join(best, "k").filter("lead <> h1").groupBy("h1", "lead").agg(F.count("*").alias("own"), F.first("weight").alias("weight"))
    return led.groupBy("h1").agg(F.max(F.struct("own", "weight", "lead")).alias("most")).select("h1", "most.lead")


def _all_pairs(own: DataFrame, sides: DataFrame, percent: int) -> DataFrame:
    """Every pair of sets that share a key, lie in different components, and may be linked by sizes and parity bits."""
    full = own.join(_sent_if_few(sides, _WIDE), "id")
    x, y = full.alias("x"), full.alias("y")
    apart = (F.col("x.k") == F.col("y.k")) & (F.col("x.id") < F.col("y.id")) & (F.col("x.c") != F.col("y.c"))
    rest = x.join(y, apart & _may_link("x.s", "y.s", percent)).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    return rest.distinct()


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """`(_key, _row, _row2, n, group, component)` for every row: set size, its group's number, the group's least key.

    A text's set are its distinct shingles of lower-cased words, a shorter text is one shingle; null texts and texts
    without words are empty and linked with nothing: they have no group, and their own key as component. Two sets are
    linked when 100 * shared >= percent * union. Rows with equal sets are one node, so copies cost one row each. A
    group without any key has a null component.

    Sets that share a key of `keys_of` are candidates. Each is first held against the one that leads most of its keys,
    which settles a group of copies with a row per member; then all pairs of a key that lie in different components, so
    far as sizes and parity bits allow a link. That is two rounds, whatever the size. Hot keys join as rows, so no task
    holds a key's members in memory at once. Within a key the second round's comparisons go with the square of its sets
    that are still apart, but only the pairs that may be linked leave the join.
    Shingles are told apart by 64-bit hashes, sets by 128-bit hashes.
    """
    rows = saved(features(docs, key, text, shingle, percent), "ngram-features")
    filled = rows.filter("n > 0")
    # Dealt out by key once, for the counts and for the rows of shared keys. Two sets with one h1 only add candidates:
    # what leaves here is told apart by h1 and h2.
    keyed = filled.select(F.explode("keys").alias("k"), "h1").repartition("k")
    shared = keyed.groupBy("k").agg(F.min("h1").alias("low"), F.max("h1").alias("top"), F.count("*").alias("times")).filter("low < top")
    members = saved(keyed.join(shared.select("k", "times"), "k").distinct(), "ngram-members")
    near = _sent_if_few(saved(members.select("h1").distinct(), "ngram-near"))
    known = filled.join(near, "h1", "left_semi").groupBy("h1", "h2").agg(
        F.min("n").alias("n"), F.min("_key").alias("rep"), F.first("parity").alias("parity")
    )
    nodes = saved(known.withColumn("id", F.monotonically_increasing_id()), "ngram-nodes")  # numbered once, then read
    ids = _sent_if_few(nodes.select("h1", "id"))
    sides = nodes.select("id", F.struct("n", "parity").alias("s"))

    # Each set is held first against the one that leads most of its keys; what that leaves open comes next.
    star = _leaders(members).join(ids.withColumnRenamed("id", "b"), "h1")
    star = star.join(ids.select(F.col("h1").alias("lead"), F.col("id").alias("a")), "lead")
    pairs = saved(_close(star, sides, percent), "ngram-pairs")
    links = saved(_verified(pairs, docs, key, text, nodes, shingle, percent), "ngram-found")
    labels = components(links)
    own = members.select("k", "h1").join(ids, "h1").join(_sent_if_few(labels.withColumnRenamed("node", "id")), "id", "left")
    own = own.select("k", "id", F.coalesce("component", "id").alias("c"))
    split = own.groupBy("k").agg(F.min("c").alias("low"), F.max("c").alias("high")).filter("low < high").select("k")
    own = saved(own.join(split, "k", "left_semi"), "ngram-split")
    rest = saved(_all_pairs(own, sides, percent).join(_sent_if_few(pairs), ["a", "b"], "left_anti"), "ngram-pairs")
    more = saved(_verified(rest, docs, key, text, nodes, shingle, percent), "ngram-found")
    if more.limit(1).count():
        labels = components(links.union(more))

    # A set that shares no key, or links with none, is a group of its own.
    of_node = nodes.join(labels, nodes["id"] == labels["node"], "left").select("h1", "h2", F.coalesce("component", "id").alias("c"))
    low = filled.groupBy("h1", "h2").agg(F.min("_key").alias("low"))
    low = saved(low.join(of_node, ["h1", "h2"], "left"), "ngram-sets-low").withColumn(
        "group", F.when(F.col("c").isNull(), F.concat_ws(":", "h1", "h2")).otherwise(F.col("c").cast("string"))
    )
    least = low.groupBy("group").agg(F.min("low").alias("component"))
    named = low.select("h1", "h2", "group").join(least, "group")
    return rows.select("_key", "_row", "_row2", "n", "h1", "h2").join(named, ["h1", "h2"], "left").select(
        "_key", "_row", "_row2", "n", "group", F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("_key")).alias("component")
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """One row of each group stays, that with the least key (nulls last); rows without words all stay."""
    found = near_duplicates(docs, key, text, **settings).filter("n > 0")
    first = F.min(F.struct(F.col("_key").isNull(), "_key", "_row", "_row2")).alias("best")
    kept = saved(found.groupBy("group").agg(first).select("best._row", "best._row2"), "ngram-kept")
    own = docs.select(packed(docs), *row_names(key, text))
    # Equal rows have one name: one of them stays. Both steps go by the name, so texts are moved once.
    unique = own.join(kept, ["_row", "_row2"], "left_semi").dropDuplicates(["_row", "_row2"])
    wordless = own.filter(F.trim(F.coalesce(F.col("_r").getField(text), F.lit("")), F.lit(SPACES)) == "")
    return unique.unionByName(wordless).select(*unpacked(docs))
