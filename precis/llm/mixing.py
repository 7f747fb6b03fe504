"""Mixing sources to target weights: a curriculum whose weights vary over the training run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precis.llm.common import packed, saved, unpacked, with_totals_before, word_count


@dataclass(frozen=True)
class Schedule:
    """A source's weight over training time 0 to 1: straight lines between `(time, weight)` knots."""

    knots: tuple[tuple[float, float], ...]

    def __post_init__(self) -> None:
        times = [t for t, _ in self.knots]
        if len(times) < 2 or times[0] != 0 or times[-1] != 1 or times != sorted(set(times)) or min(w for _, w in self.knots) < 0:
            raise ValueError("knots must rise from time 0 to time 1 and hold no negative weight")
        if self.weight <= 0:
            raise ValueError("a schedule needs weight somewhere")

    @property
    def areas(self) -> list[float]:
        return [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(self.knots, self.knots[1:], strict=False)]

    @property
    def weight(self) -> float:
        """The weight over the whole run: the integral of the schedule."""
        return sum(self.areas)

    def time_of(self, share: Column) -> Column:
        """When the given share (0 to 1) of the source's demand has been met: the inverse of the integral."""
        area = share * self.weight
        out, before = F.lit(1.0), sum(self.areas)
        for (t0, w0), (t1, w1), own in reversed(list(zip(self.knots, self.knots[1:], self.areas, strict=False))):
            before -= own
            slope = (w1 - w0) / (t1 - t0)
            left = F.greatest(area - F.lit(before), F.lit(0.0))
            # The stable root of slope/2 d^2 + w0 d = left.
            root = w0 + F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * left, F.lit(0.0)))
            step = F.when(root > 0, 2 * left / root).otherwise(F.lit(0.0))
            inside = F.lit(t0) + F.least(step, F.lit(t1 - t0))
            out = F.when(area <= F.lit(before + own), inside).otherwise(out)
        return out


# Sources take these in turn, by code point; the weights over the run are 5, 2 and 1.
SCHEDULES = (
    Schedule(((0.0, 6.0), (1.0, 4.0))),
    Schedule(((0.0, 1.0), (1.0, 3.0))),
    Schedule(((0.0, 0.0), (0.5, 1.0), (1.0, 2.0))),
)
BUDGET_PERCENT = 150
MOST_PASSES = 2


def source_targets(
    sizes: DataFrame, schedules: tuple[Schedule, ...] = SCHEDULES, budget_percent: int = BUDGET_PERCENT, most: int = MOST_PASSES
) -> DataFrame:
    """`(_source, _source_size, _turn, _target)` from `(_source, _source_size)`, one row per source.

    Each source has the weight of its schedule and can give at most `most` times its size. With level L, a source gets
    the less of `weight * L` and that bound; L is such that the targets sum to the budget (or to all there is). The
    sources are put in order of the level at which each is full, so one running sum over them finds L: what sharing
    the excess again and again comes to. Running sums go by parts of the ordered table; no task sees all sources.
    """
    ranked = with_totals_before(
        sizes.withColumn("_one", F.lit(1).cast("long")), [F.col("_source").asc_nulls_last()], {"_rank": "_one"}, "mix-ranks"
    )
    turn = (F.col("_rank") % len(schedules)).cast("int")
    weight = F.element_at(F.array(*(F.lit(s.weight) for s in schedules)), turn + 1)
    ranked = ranked.withColumn("_turn", turn).withColumn("_weight", weight)
    ranked = ranked.withColumn("_bound", (F.col("_source_size") * most).cast("double"))
    full_at = F.col("_bound") / F.col("_weight")
    ordered = with_totals_before(
        ranked.withColumn("_full_at", full_at), [F.col("_full_at"), F.col("_rank")], {"_full": "_bound", "_gone": "_weight"}, "mix-levels"
    )
    ordered = saved(ordered, "mix-ordered")
    # Two rows of a few numbers come to the driver: the totals, and the level found.
    found = ordered.agg(F.sum("_source_size").alias("size"), F.sum("_weight").alias("weight"), F.sum("_bound").alias("bound"))
    total = found.first()
    budget = min((total["size"] or 0) * budget_percent / 100, total["bound"] or 0.0)
    # The level if exactly the sources before this one are full; it holds at the first source that it doesn't fill.
    level = (F.lit(budget) - F.col("_full")) / (F.lit(total["weight"] or 1.0) - F.col("_gone"))
    levels = ordered.withColumn("_level", level).filter("_level <= _full_at")
    held = levels.agg(F.min(F.struct("_full_at", "_rank", "_level")).alias("held")).first()["held"]
    target = F.least(F.col("_bound"), F.col("_weight") * held["_level"]) if held else F.col("_bound")
    return ordered.select("_source", "_source_size", "_turn", target.alias("_target"))


def plan(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    schedules: tuple[Schedule, ...] = SCHEDULES,
    budget_percent: int = BUDGET_PERCENT,
    most: int = MOST_PASSES,
) -> DataFrame:
    """`(_key, _hash, _source, _copies, _size, _source_size, _target, _positions)`: when each document is trained on.

    A source's documents stand in an order that depends on their keys alone (md5), and the source is read in that
    order, again from the start once it is through, until its target is reached: a document is taken when the target
    reaches its middle. So the words taken differ from the target by half a document at most, and no document is
    taken more than `most` times. Its position is the time at which the source's cumulative demand, the integral of
    its schedule, reaches its middle word. `_positions` holds one time for each pass, none for a document left out.

    Rows that agree in key, source and text are one document of `_copies` rows and share its fate. Null texts have no
    words; documents without words are taken as the words around them are. A null source is a source, the last.
    Only keys, sizes and hashes are shuffled, by ranges of the order, so a hot source is spread over all tasks.
    """
    narrow = docs.select(
        F.col(f"`{key}`").alias("_key"),
        F.col(f"`{source}`").alias("_source"),
        F.xxhash64(F.col(f"`{text}`")).alias("_hash"),
        word_count(F.col(f"`{text}`")).alias("_size"),
    )
    units = narrow.groupBy("_key", "_source", "_hash").agg(F.count("*").alias("_copies"), F.max("_size").alias("_size"))
    units = saved(units.withColumn("_words", F.col("_size") * F.col("_copies")), "mix-sizes")
    sizes = units.groupBy("_source").agg(F.sum("_words").alias("_source_size"))
    targets = saved(source_targets(sizes, schedules, budget_percent, most), "mix-targets")
    order = F.md5(F.coalesce(F.col("_key").cast("string"), F.lit("")))
    ordered = with_totals_before(
        units.withColumn("_order", order),
        [F.col("_source").asc_nulls_last(), F.col("_order"), F.col("_key"), F.col("_hash")],
        {"_upto": "_words"},
        "mix-order",
    )
    # `_upto` runs over all sources; what the sources before hold comes off, a running sum over the sources.
    starts = with_totals_before(targets, [F.col("_source").asc_nulls_last()], {"_first": "_source_size"}, "mix-starts")
    starts = saved(starts, "mix-source-starts")
    # One source may hold a third of the rows: the join leaves the size of this side to the planner, which splits hot keys.
    placed = ordered.join(starts.withColumnRenamed("_source", "_of"), F.col("_source").eqNullSafe(F.col("_of")))
    middle = F.col("_upto") - F.col("_first") + F.col("_words") / 2
    times = []
    for again in range(most):
        at = middle + again * F.col("_source_size")
        time = F.element_at(F.array(*(s.time_of(at / F.col("_target")) for s in schedules)), F.col("_turn") + 1)
        times.append(F.when((F.col("_target") > 0) & (at < F.col("_target")), time))
    positions = F.filter(F.array(*times), lambda t: t.isNotNull())
    return placed.select(
        "_key", "_hash", "_source", "_copies", "_size", "_source_size", "_target", positions.alias("_positions")
    )


def mix(
    docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", position: str | None = "position", **settings
) -> DataFrame:
    """The training order: each document once for every time it is taken, range-sorted by its position.

    Has the columns of `docs` and `position` (replaced if there; None leaves it out). The plan joins the documents by
    key and text hash, keys that no group of rows shares but equal rows.
    """
    planned = plan(docs, key, source, text, **settings).select(
        "_key", "_hash", F.col("_source").alias("_src"), F.explode("_positions").alias("_at")
    )
    own = docs.select(
        packed(docs),
        F.col(f"`{key}`").alias("_own"),
        F.col(f"`{source}`").alias("_from"),
        F.xxhash64(F.col(f"`{text}`")).alias("_h"),
    )
    same = own["_own"].eqNullSafe(planned["_key"]) & (own["_h"] == planned["_hash"]) & own["_from"].eqNullSafe(planned["_src"])
    laid = own.join(planned, same).repartitionByRange("_at", "_key").sortWithinPartitions("_at", "_key")
    if not position:
        return laid.select(*unpacked(docs))
    return laid.select(*(c for c, name in zip(unpacked(docs), docs.columns, strict=True) if name != position), F.col("_at").alias(position))
