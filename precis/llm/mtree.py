"""Exact top-k search by inner product in a forest of M-trees.

The M-tree (Ciaccia, Patella and Zezula 1997) needs a metric. Every candidate x gets one more coordinate,
sqrt(M^2 - |x|^2) with M the largest norm, and a query q gets 0 there: then the squared distance is
|q|^2 + M^2 - 2 q.x, so the nearest candidates are those of the largest inner products.

A bounded sample of candidates serves as routing objects; each row belongs to the cell of its nearest one. Rows sorted by
cell and distance from the routing object are cut into trees of bounded size, so a cell with a third of all rows is many
trees, each a ring round the routing object. A tree is a set of pages: inner pages hold, for each page below, its centre
(a candidate itself), covering radius and distance to the centre above; leaves hold candidates with theirs.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from precis.llm.common import saved
from precis.llm.vectors import lists, matrix, slices, whole_numbers

PAGE = 128
FAN = 16
# Components that a tree holds, which bounds its memory; rows per routing object, and the most routing objects.
TREE = 1 << 20
ROWS_PER_ROUTE = 4096
ROUTES = 1024
# Queries that are searched together, and those that share one copy of a tree.
BLOCK = 512
TOGETHER = 1 << 16
NO_FLOOR = np.iinfo(np.int64).min


@dataclass
class Tree:
    """Pages of one tree as arrays; page 0 is the root, a page's parent comes before it."""

    middle: np.ndarray  # each page's centre, a candidate
    centre: np.ndarray  # the same with the coordinate more
    radius: np.ndarray
    parent: np.ndarray
    to_parent: np.ndarray
    first: np.ndarray  # of a leaf's entries; the same as `last` in an inner page
    last: np.ndarray
    keys: np.ndarray  # per entry, with `known` false where the key is null
    known: np.ndarray
    entries: np.ndarray
    distances: np.ndarray  # of an entry from its leaf's centre, ascending in the leaf
    children: list[np.ndarray] = field(default_factory=list)

    def __post_init__(self):
        order = np.argsort(self.parent, kind="stable")
        bounds = np.searchsorted(self.parent[order], np.arange(len(self.parent) + 1))
        self.children = [order[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def lifted(x: np.ndarray, most: int) -> np.ndarray:
    """Candidates with the coordinate that gives all of them the norm of the longest."""
    own = x.astype(np.float64)
    rest = most - np.einsum("ij,ij->i", own, own)
    return np.concatenate([own, np.sqrt(np.maximum(rest, 0))[:, None]], axis=1)


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances between the rows of two matrices."""
    square = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def build(keys: np.ndarray, known: np.ndarray, x: np.ndarray, most: int, page: int = PAGE) -> Tree:
    """A tree over candidates, loaded from the top: far pivots, each row to its nearest, until a page holds the rows."""
    points = lifted(x, most)
    pages: list[tuple] = []
    order: list[np.ndarray] = []
    dist: list[np.ndarray] = []
    # (rows, parent page); parents are numbered before their pages
    todo = [(np.arange(len(x)), -1)]
    at = 0
    while todo:
        rows, parent = todo.pop()
        own = points[rows]
        middle = rows[np.argmin(apart(own, own.mean(axis=0, keepdims=True))[:, 0])]
        centre = points[middle]
        gaps = apart(own, centre[None])[:, 0]
        up = 0.0 if parent < 0 else float(np.sqrt(((centre - points[pages[parent][0]]) ** 2).sum()))
        number = len(pages)
        if len(rows) <= page:
            sort = np.argsort(gaps, kind="stable")
            pages.append((middle, gaps.max(), parent, up, at, at + len(rows)))
            order.append(rows[sort])
            dist.append(gaps[sort])
            at += len(rows)
            continue
        pages.append((middle, gaps.max(), parent, up, at, at))
        fan = min(FAN, -(-len(rows) // page))
        nearest, group = gaps.copy(), np.zeros(len(rows), np.int64)
        for pivot in range(1, fan):
            far = int(np.argmax(nearest))
            if nearest[far] == 0:
                break
            new = apart(own, own[far][None])[:, 0]
            group[new < nearest] = pivot
            nearest = np.minimum(nearest, new)
        counts = np.bincount(group)
        if counts.max() == len(rows):  # equal points: any halves do
            group = np.arange(len(rows)) * fan // len(rows)
        todo += [(rows[group == g], number) for g in np.unique(group)]
    take = np.concatenate(order)
    middle, radius, parent, up, first, last = (np.array(c) for c in zip(*pages, strict=True))
    return Tree(x[middle], points[middle], radius, parent, up, first, last, keys[take], known[take], x[take], np.concatenate(dist))


@dataclass
class Found:
    """The best `k` so far of each query: scores falling, then keys, null keys last; `count` says how many there are."""

    scores: np.ndarray
    keys: np.ndarray
    known: np.ndarray
    count: np.ndarray
    floor: np.ndarray  # a score that `k` candidates elsewhere are known to reach


def nothing_yet(queries: int, k: int, floor: np.ndarray | None = None) -> Found:
    none = np.full((queries, k), NO_FLOOR, np.int64)
    floor = np.full(queries, NO_FLOOR) if floor is None else floor
    return Found(none, np.zeros((queries, k), np.int64), np.zeros((queries, k), bool), np.zeros(queries, np.int64), floor)


def _products(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products as longs; doubles hold them while they stay below 2^53."""
    return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64) if exact else a @ b.T


def search(tree: Tree, keys: np.ndarray, x: np.ndarray, most: int, found: Found) -> tuple[int, int]:
    """Best-first through the pages for a block of queries, into `found`; distances worked out, and those avoided.

    A page is opened for the queries whose k-th distance is not below the page's least possible one. Before a distance
    to a page's centre or to a candidate is worked out, the stored distance to the centre above rules it out where
    |d(q, above) - d(above, it)| - radius is beyond the k-th distance already. Distances are taken a little wide, so
    rounding excludes nothing.
    """
    k = found.scores.shape[1]
    size = np.einsum("ij,ij->i", x.astype(np.float64), x.astype(np.float64))
    lifted_queries = np.concatenate([x.astype(np.float64), np.zeros((len(x), 1))], axis=1)
    exact = max(most, float(size.max(initial=0))) < 2**52
    wide = 1e-5 * (np.sqrt(most) + np.sqrt(size))
    worked = avoided = 0

    def reach() -> np.ndarray:
        best = np.maximum(np.where(found.count == k, found.scores[:, -1], found.floor), found.floor)
        open_end = best == NO_FLOOR
        return np.where(open_end, np.inf, np.sqrt(np.maximum(size + most - 2 * best.astype(np.float64), 0)) + wide)

    root = apart(lifted_queries, tree.centre[:1])[:, 0]
    worked += len(x)
    least = np.maximum(root - tree.radius[0], 0)
    heap = [(float(least.min()), 0, root)]
    while heap:
        _, page, gap = heapq.heappop(heap)
        limit = reach()
        live = np.flatnonzero(np.maximum(gap - tree.radius[page], 0) <= limit)
        if not len(live):
            continue
        first, last = int(tree.first[page]), int(tree.last[page])
        if first == last:
            for below in tree.children[page]:
                radius = tree.radius[below]
                need = live[np.abs(gap[live] - tree.to_parent[below]) - radius <= limit[live]]
                avoided += len(live) - len(need)
                if not len(need):
                    continue
                worked += len(need)
                away = np.full(len(x), np.inf)
                away[need] = apart(lifted_queries[need], tree.centre[below][None])[:, 0]
                bound = np.maximum(away[need] - radius, 0)
                if (bound <= limit[need]).any():
                    heapq.heappush(heap, (float(bound.min()), int(below), away))
            continue
        own = tree.distances[first:last]
        low = np.searchsorted(own, gap[live] - limit[live], "left")
        high = np.searchsorted(own, gap[live] + limit[live], "right")
        avoided += int(len(live) * (last - first) - np.maximum(high - low, 0).sum())
        live, low, high = live[high > low], low[high > low], high[high > low]
        if not len(live):
            continue
        a, b = first + int(low.min()), first + int(high.max())
        worked += len(live) * (b - a)
        scores = _products(x[live], tree.entries[a:b], exact)
        same = tree.known[a:b][None] & (tree.keys[a:b][None] == keys[live][:, None])
        bar = np.maximum(np.where(found.count[live] == k, found.scores[live, -1], found.floor[live]), found.floor[live])
        hit_row, hit_col = np.nonzero((scores >= bar[:, None]) & ~same)
        _merge(found, live[hit_row], scores[hit_row, hit_col], tree.keys[a + hit_col], tree.known[a + hit_col])
    return worked, avoided


def _merge(found: Found, rows: np.ndarray, scores: np.ndarray, keys: np.ndarray, known: np.ndarray) -> None:
    """New hits into the best of their queries."""
    if not len(rows):
        return
    k = found.scores.shape[1]
    touched = np.unique(rows)
    old = np.arange(k)[None] < found.count[touched][:, None]
    at, place = np.nonzero(old)
    rows = np.concatenate([touched[at], rows])
    scores = np.concatenate([found.scores[touched][at, place], scores])
    keys = np.concatenate([found.keys[touched][at, place], keys])
    known = np.concatenate([found.known[touched][at, place], known])
    order = np.lexsort((keys, ~known, -scores, rows))
    rows = rows[order]
    rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
    keep, order = rank < k, order[rank < k]
    rows, rank = rows[keep], rank[keep]
    found.scores[rows, rank], found.keys[rows, rank], found.known[rows, rank] = scores[order], keys[order], known[order]
    found.count[touched] = np.minimum(np.bincount(np.searchsorted(touched, rows), minlength=len(touched)), k)


# A forest as a table: a row per page, per candidate in a leaf, per query and per hit. No row is longer than a vector, so
# a batch of them is bounded. `gap` is the distance to the centre above.
_PAGE, _ENTRY, _QUERY, _HIT = range(4)
_FOREST = {
    "kind": ("int", pa.int32()),
    "tree": ("string", pa.string()),
    "cell": ("int", pa.int32()),
    "low": ("double", pa.float64()),
    "high": ("double", pa.float64()),
    "page": ("int", pa.int32()),
    "parent": ("int", pa.int32()),
    "gap": ("double", pa.float64()),
    "radius": ("double", pa.float64()),
    "key": ("bigint", pa.int64()),
    "x": ("array<bigint>", pa.list_(pa.int64())),
    "floor": ("bigint", pa.int64()),
    "vec": ("bigint", pa.int64()),
    "score": ("bigint", pa.int64()),
}
_SCHEMA = ", ".join(f"{name} {kind}" for name, (kind, _) in _FOREST.items())


def _rows(n: int, **columns) -> pa.RecordBatch:
    """Rows of the forest's table; a single value holds for all of them, columns that aren't given are null."""
    made = []
    for name, (_, kind) in _FOREST.items():
        value = columns.get(name)
        if value is None:
            made.append(pa.nulls(n, kind))
        elif isinstance(value, pa.Array):
            made.append(value.cast(kind))
        else:
            made.append(pa.array(value if isinstance(value, np.ndarray) else np.full(n, value) if not isinstance(value, str) else [value] * n, kind))
    return pa.RecordBatch.from_arrays(made, names=list(_FOREST))


def _named(keys: np.ndarray, known: np.ndarray) -> pa.Array:
    return pa.array(keys, pa.int64(), mask=~known)


def _hits(found: Found, keys: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
    at, place = np.nonzero(np.arange(found.scores.shape[1])[None] < found.count[:, None])
    return _rows(len(at), kind=_HIT, key=keys[at], x=lists(x[at]), vec=_named(found.keys[at, place], found.known[at, place]), score=found.scores[at, place])


def _planted(held: pa.Table, name: str, size: int, most: int, k: int, page: int) -> Iterator[pa.RecordBatch]:
    """The tree over the candidates of a run of rows, and its own queries with what they find there."""
    cell = held.column("cell")[0].as_py()
    asks = np.asarray(held.column("asks"))
    x = matrix(held.column("x").combine_chunks(), size)
    keys, known = np.asarray(held.column("_key").fill_null(0)), np.asarray(held.column("_key").is_valid())
    gaps = np.asarray(held.column("gap"))[~asks]
    tree = None
    if len(gaps):
        tree = build(keys[~asks], known[~asks], x[~asks], most, page)
        n = len(tree.radius)
        yield _rows(n, kind=_PAGE, tree=name, cell=cell, low=gaps.min(), high=gaps.max(), page=np.arange(n), parent=tree.parent, gap=tree.to_parent, radius=tree.radius, x=lists(tree.middle))
        leaf = np.repeat(np.arange(n), tree.last - tree.first)
        for at in range(0, len(leaf), 4096):
            some = slice(at, at + 4096)
            yield _rows(len(leaf[some]), kind=_ENTRY, tree=name, page=leaf[some], gap=tree.distances[some], key=_named(tree.keys[some], tree.known[some]), x=lists(tree.entries[some]))
    for at in range(0, int(asks.sum()), BLOCK):
        own_keys, own = keys[asks][at : at + BLOCK], x[asks][at : at + BLOCK]
        found = nothing_yet(len(own), k)
        if tree is not None:
            search(tree, own_keys, own, most, found)
        floor = np.where(found.count == k, found.scores[:, -1], NO_FLOOR)
        yield _rows(len(own), kind=_QUERY, tree=name, key=own_keys, x=lists(own), floor=floor)
        yield _hits(found, own_keys, own)


def _runs(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Stretches of rows that agree in the columns `by`, no longer than a batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        names = list(zip(*(batch.column(c).to_pylist() for c in by), strict=True))
        start = 0
        for at in range(1, len(names) + 1):
            if at == len(names) or names[at] != names[start]:
                yield names[start], batch.slice(start, at - start)
                start = at


def _tree_of(rows: list[pa.RecordBatch], size: int, most: int) -> Tree:
    """A tree from its page rows and entry rows, sorted by kind, page and distance."""
    table = pa.Table.from_batches(rows)
    kind = np.asarray(table.column("kind"))
    pages, entries = table.filter(pa.array(kind == _PAGE)), table.filter(pa.array(kind == _ENTRY))
    middle = matrix(pages.column("x").combine_chunks(), size)
    leaf, here = np.asarray(entries.column("page")), np.arange(pages.num_rows)
    return Tree(
        middle, lifted(middle, most), np.asarray(pages.column("radius")), np.asarray(pages.column("parent")), np.asarray(pages.column("gap")),
        np.searchsorted(leaf, here, "left"), np.searchsorted(leaf, here, "right"),
        np.asarray(entries.column("key").fill_null(0)), np.asarray(entries.column("key").is_valid()),
        matrix(entries.column("x").combine_chunks(), size), np.asarray(entries.column("gap")),
    )


def nearest(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 5,
    scale: int = 256,
    every: int = 50,
    page: int = PAGE,
    tree_rows: int | None = None,
    rows_per_route: int = ROWS_PER_ROUTE,
) -> DataFrame:
    """`(query_id, rank, vec_id, score)`: each query's `k` largest inner products of whole-numbered vectors.

    Queries are the rows whose key is divisible by `every`, candidates all rows of another key. Ties go to the smaller
    key, null keys last. Vectors that are null or hold null, NaN or infinite components take no part; a shorter vector
    ends in zeros; repeated rows (same key, same vector) count once, and a row with a null key is a candidate only. A key
    with several vectors is a query for each, with ranks of its own. Other columns are not looked at; no rows give no
    rows. Norms squared must fit a long.

    Of equal vectors only those of the k + 1 smallest keys can be among any query's best k, so a vector that many rows
    share enters the trees that often. Every task builds trees over its range of rows and answers the queries among
    them first; with those k-th scores a query visits only the cells and rings that could hold better ones. A tree's
    pages and then the queries that visit it come as a sorted stream, a tree and a block of queries in memory at once.
    """
    spark = df.sparkSession
    rows, size = whole_numbers(df, key, vector, scale)
    if not size:
        # No vector, or none with a component: nothing to rank by.
        rows, size = rows.withColumn("x", F.array(F.lit(0).cast("long"))), 1
    # Combined before the shuffle, so a row that is repeated costs one row per task.
    rows = saved(rows.groupBy(F.col("_key").cast("long").alias("_key"), "x").agg(F.count("*").alias("_n")).drop("_n"), "vectors")
    norm = F.aggregate("x", F.lit(0).cast("long"), lambda a, c: a + c * c)
    total, most = rows.agg(F.count("*"), F.max(norm)).first()  # one row
    if not total:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    copies = Window.partitionBy("x").orderBy(F.col("_key").asc_nulls_last())
    kept = rows.withColumn("_rank", F.row_number().over(copies)).filter(F.col("_rank") <= k + 1)
    both = kept.select("_key", "x", F.lit(False).alias("asks")).unionByName(rows.filter(F.col("_key") % every == 0).select("_key", "x", F.lit(True).alias("asks")))
    sample = rows.orderBy(F.xxhash64("x", "_key"), "_key").limit(min(ROUTES, -(-total // rows_per_route)))
    ways = lifted(np.unique(np.array([r[0] for r in sample.select("x").collect()], np.int64), axis=0), most)
    most_rows = tree_rows or max(page, TREE // size)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, max(size, len(ways))):
            gaps = apart(lifted(matrix(batch.column("x"), size), most), ways)
            cell = np.argmin(gaps, axis=1)
            own = gaps[np.arange(len(cell)), cell]
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(own), *batch.columns], names=["cell", "gap", *batch.schema.names])

    placed = saved(both.mapInArrow(place, "cell int, gap double, _key bigint, x array<bigint>, asks boolean"), "placed-vectors")
    order = ["cell", "gap", "_key", "asks"]
    laid = placed.repartitionByRange(*order).sortWithinPartitions(*order)

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, last = TaskContext.get().partitionId(), 0, [], None
        for (cell,), run in _runs(slices(batches, size), ["cell"]):
            if held and (cell != last or sum(h.num_rows for h in held) >= most_rows):
                yield from _planted(pa.Table.from_batches(held), f"{part}-{number}", size, most, k, page)
                held, number = [], number + 1
            held.append(run)
            last = cell
        if held:
            yield from _planted(pa.Table.from_batches(held), f"{part}-{number}", size, most, k, page)

    forest = saved(laid.mapInArrow(plant, _SCHEMA), "forest")
    trees = saved(forest.filter((F.col("kind") == _PAGE) & (F.col("page") == 0)).select("tree", "cell", "low", "high"), "trees")
    rings = np.full((len(ways), 2), (np.inf, -np.inf))
    for cell, low, high in trees.groupBy("cell").agg(F.min("low"), F.max("high")).collect():  # a row per routing object
        rings[cell] = low, high

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A query once for each cell it may have to see, with the distances from the routing object that matter."""
        for batch in slices(batches, max(size, len(ways))):
            x, floor = matrix(batch.column("x"), size).astype(np.float64), np.asarray(batch.column("floor"))
            square = np.einsum("ij,ij->i", x, x)
            wide = 1e-5 * (np.sqrt(most) + np.sqrt(square))
            reach = np.where(floor == NO_FLOOR, np.inf, np.sqrt(np.maximum(square + most - 2 * floor.astype(np.float64), 0)) + wide)
            gaps = apart(np.concatenate([x, np.zeros((len(x), 1))], axis=1), ways)
            near, far = gaps - reach[:, None], gaps + reach[:, None]
            at, cell = np.nonzero((near <= rings[:, 1]) & (far >= rings[:, 0]))
            for some in range(0, len(at), 4096):
                i, c = at[some : some + 4096], cell[some : some + 4096]
                yield pa.RecordBatch.from_arrays([*batch.take(pa.array(i)).columns, pa.array(c, pa.int32()), pa.array(near[i, c]), pa.array(far[i, c])], names=[*batch.schema.names, "cell", "near", "far"])

    queries = forest.filter(F.col("kind") == _QUERY).select("key", "x", "floor", F.col("tree").alias("home"))
    asked = queries.count()
    group = F.pmod(F.xxhash64("key", "x"), F.lit(max(1, -(-asked // TOGETHER)))).alias("_group")
    visits = queries.mapInArrow(visit, "key bigint, x array<bigint>, floor bigint, home string, cell int, near double, far double")
    seen = visits.join(trees, "cell").filter((F.col("near") <= F.col("high")) & (F.col("far") >= F.col("low")) & (F.col("home") != F.col("tree")))
    seen = saved(seen.select("tree", group, "key", "x", "floor"), "visits")
    needed = seen.select("tree", "_group").distinct()
    parts = forest.filter(F.col("kind").isin(_PAGE, _ENTRY)).join(needed, "tree")
    stream = parts.unionByName(seen.withColumn("kind", F.lit(_QUERY)), allowMissingColumns=True)
    stream = stream.repartition("tree", "_group").sortWithinPartitions("tree", "_group", "kind", "page", "gap")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tree, last = [], None, None
        for (name, number, kind), run in _runs(slices(batches, size), ["tree", "_group", "kind"]):
            if (name, number) != last:
                held, tree, last = [], None, (name, number)
            if kind != _QUERY:
                held.append(run)
                continue
            if tree is None:
                tree, held = _tree_of(held, size, most), []
            for at in range(0, run.num_rows, BLOCK):
                some = run.slice(at, BLOCK)
                own_keys, own = np.asarray(some.column("key")), matrix(some.column("x"), size)
                found = nothing_yet(len(own), k, np.asarray(some.column("floor")))
                search(tree, own_keys, own, most, found)
                yield _hits(found, own_keys, own)

    columns = ["tree", "_group", "kind", "page", "parent", "gap", "radius", "key", "x", "floor"]
    more = stream.select(*columns).mapInArrow(answer, _SCHEMA)
    best = Window.partitionBy("key", "x").orderBy(F.desc("score"), F.col("vec").asc_nulls_last())
    hits = forest.filter(F.col("kind") == _HIT).unionByName(more).select("key", "x", "vec", "score")
    ranked = hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select(F.col("key").alias("query_id"), "rank", F.col("vec").alias("vec_id"), "score")
