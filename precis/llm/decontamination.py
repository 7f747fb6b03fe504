"""Benchmark decontamination: short test items found inside long documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precis.functions.text import let
from precis.llm.common import packed, saved, unpacked

SHINGLE = 5
PERCENT = 80
# Scripts that put no space between words: each character is a word.
_UNSPACED = r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}])"


def tokens(text: Column) -> Column:
    """Runs of letters and digits of the lower-cased text, so that punctuation and line breaks hide nothing; single
    characters in scripts without spaces between words."""
    apart = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), _UNSPACED, " $1 ")
    return F.filter(F.split(apart, r"[^\p{L}\p{N}]+"), lambda t: t != "")


def _windows(words: Column, size: int, make) -> Column:
    """`make(array, i)` for each start of a shingle; none in a text of fewer words."""
    return let(
        words,
        lambda w: F.transform(
            F.when(F.size(w) >= size, F.sequence(F.lit(0), F.size(w) - size)).otherwise(F.array().cast("array<int>")),
            lambda i: make(w, i),
        ),
    )


def shingle_hashes(text: Column, sizes: list[int]) -> Column:
    """Hashes of all shingles of these sizes; those of different sizes differ."""
    hashed = F.transform(tokens(text), lambda t: F.xxhash64(t))
    every = lambda size: lambda w, i: F.xxhash64(*(F.get(w, i + k) for k in range(size)))
    return let(hashed, lambda h: F.concat(*(_windows(h, size, every(size)) for size in sizes)))


def shingles(text: Column, sizes: list[int]) -> Column:
    """The distinct shingles themselves, words parted by spaces."""
    every = lambda size: lambda w, i: F.concat_ws(" ", F.slice(w, i + 1, F.lit(size)))
    return let(tokens(text), lambda w: F.array_distinct(F.concat(*(_windows(w, size, every(size)) for size in sizes))))


def item_shingles(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """`(_item, _n, _shingle)`: the distinct shingles of each item; rows of one key and text count once.

    An item of fewer words is one shingle, all of it.
    """
    words = tokens(F.col(f"`{text}`"))
    whole = let(words, lambda w: F.when((F.size(w) > 0) & (F.size(w) < SHINGLE), F.array(F.concat_ws(" ", w))))
    parts = items.select(F.col(f"`{key}`").alias("_item"), F.coalesce(whole, shingles(F.col(f"`{text}`"), [SHINGLE])).alias("_s")).distinct()
    return parts.select("_item", F.size("_s").alias("_n"), F.xxhash64("_s").alias("_version"), F.explode("_s").alias("_shingle"))


def sketches(parts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """`(_item, _hash)`: the least hashes of each item's shingles, as many as its size class needs.

    Items of 2^c to 2^(c+1) - 1 shingles form class c. Of an item contained to `percent`, at most 100 - percent of a
    hundred shingles are missing from the document, so one more than that many of the class's largest item must hold
    one that is there: the search misses nothing. Hashing picks the same few shingles for equal items, spread evenly.
    """
    words = F.split("_shingle", " ")
    of_size = lambda size: F.xxhash64(*(F.xxhash64(F.get(words, F.lit(k))) for k in range(size)))
    hashed = F.coalesce(*(F.when(F.size(words) == size, of_size(size)) for size in range(1, SHINGLE + 1)))
    size_class = F.floor(F.log2("_n"))
    needed = F.floor((F.pow(F.lit(2.0), size_class + 1) - 1) * (100 - percent) / 100).cast("int") + 1
    # One group holds one item's shingles.
    rows = parts.withColumn("_hash", hashed).withColumn("_needed", needed)
    return rows.groupBy("_item", "_version", "_needed").agg(F.collect_set(F.struct(F.xxhash64("_shingle").alias("rank"), "_hash")).alias("_all")).select(
        "_item", F.explode(F.slice(F.array_sort("_all"), F.lit(1), F.col("_needed"))).alias("_pick")
    ).select("_item", "_pick._hash").distinct()


def search(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", percent: int = PERCENT
) -> DataFrame:
    """`(_key, _text, _item, _n, _shared)`: items of which at least `percent` in a hundred shingles are in a document.

    `_text` is the hash that tells documents of one key apart. An item of fewer than five words is found where it stands
    word for word, in documents of any length; items and documents without a word, null ones among them, match nothing.
    Repeated rows give one result. Items of one key and different texts
    are matched each, the best one is reported. Documents are read whole: their shingles are looked up as hashes among
    the items' sketches, and a document that holds one is read again to count its shingles themselves. The tables of
    the items are stored first, so that the planner knows their size: it broadcasts small ones and shuffles others.
    """
    parts = saved(item_shingles(items, item_key, item_text), "leak-items")
    picks = saved(sketches(parts, percent), "leak-sketches")
    # The lengths of short items that there are: four numbers at most.
    lengths = parts.select(F.size(F.split("_shingle", " ")).alias("n")).distinct().filter(F.col("n") < SHINGLE)
    sizes = [*sorted(r["n"] for r in lengths.collect()), SHINGLE]
    own = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_body"))
    own = own.withColumn("_text", F.xxhash64("_body"))
    probes = own.select("_key", "_text", F.explode(shingle_hashes(F.col("_body"), sizes)).alias("_hash"))
    found = probes.join(picks, "_hash").select("_key", "_text", "_item").distinct()
    candidates = saved(found, "leak-candidates")
    seen = candidates.select(F.col("_key").alias("_k"), F.col("_text").alias("_t")).distinct()
    again = own.join(seen, own["_key"].eqNullSafe(seen["_k"]) & (own["_text"] == seen["_t"]), "left_semi")
    # A document's shingles meet those of its own candidates only, so one that many items hold gives a row for each of them.
    whole = again.select("_key", "_text", F.explode(shingles(F.col("_body"), sizes)).alias("_shingle")).distinct()
    asked = candidates.join(parts, candidates["_item"].eqNullSafe(parts["_item"])).select(
        candidates["_key"].alias("_k"), candidates["_text"].alias("_t"), parts["_item"], "_version", "_n", parts["_shingle"].alias("_s")
    )
    same = whole["_key"].eqNullSafe(asked["_k"]) & (whole["_text"] == asked["_t"]) & (whole["_shingle"] == asked["_s"])
    counted = whole.join(asked, same).groupBy("_key", "_text", "_item", "_version", "_n").agg(F.count("*").alias("_shared"))
    enough = counted.filter(F.col("_shared") * 100 >= F.col("_n") * percent)
    best = enough.groupBy("_key", "_text", "_item").agg(F.max(F.struct(F.col("_shared") / F.col("_n"), "_shared", "_n")).alias("_best"))
    return best.select("_key", "_text", "_item", "_best._n", "_best._shared")


def decontaminate(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The documents that hold no item, with their own columns; null texts and those without a word stay."""
    leaks = saved(search(docs, items, key, text, **settings).select(F.col("_key").alias("_k"), F.col("_text").alias("_t")).distinct(), "leaks")
    own = docs.select(packed(docs), F.col(f"`{key}`").alias("_own"), F.xxhash64(F.col(f"`{text}`")).alias("_h"))
    same = own["_own"].eqNullSafe(leaks["_k"]) & (own["_h"] == leaks["_t"])
    return own.join(leaks, same, "left_anti").select(*unpacked(docs))
