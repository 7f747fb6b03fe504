"""Connected components of links, by rounds of small joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precis.llm.common import saved


# Labels go to all executors up to about this many bytes, counted before; a row takes about 64 there.
_SENT, _ROW = 32 * 1024 * 1024, 64


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """`(node, component)`: for every node of a link the least node that its links lead to.

    Each round points every node, and what it points at, at the least label next to it, then skips ahead along the
    pointers, so chains shorten by half or more; the tables are stored between rounds. Labels of a hot node's
    neighbours meet in a minimum that every task takes of its own rows first; that minimum is a round's only shuffle as
    long as the labels are few enough to be sent. A link from a node to itself makes the node appear; null nodes are dropped.
    """
    pairs = links.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x is not null and y is not null")
    ways = F.explode(F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y")), F.struct("x", F.col("x").alias("y")), F.struct(F.col("y").alias("x"), "y")))
    edges = saved(pairs.select(ways.alias("e")).select("e.x", "e.y").distinct(), "edges")  # each node is next to itself, too
    labels = saved(edges.groupBy("x").agg(F.min("y").alias("label")), "labels")
    few = labels.count() * _ROW <= _SENT
    sent = F.broadcast if few else lambda df: df
    while True:
        near = edges.join(sent(labels.select(F.col("x").alias("y"), F.col("label").alias("least"))), "y").join(sent(labels), "x")
        offers = near.select(F.explode(F.array("x", "label")).alias("x"), "least")
        hooked = saved(offers.groupBy("x").agg(F.min("least").alias("next")), "labels")
        changed = hooked.join(sent(labels), "x").filter("next <> label").limit(1).count()
        if not changed:
            return labels.select(F.col("x").alias("node"), F.col("label").alias("component"))
        ahead = hooked.select(F.col("x").alias("next"), F.col("next").alias("label"))
        labels = saved(hooked.join(sent(ahead), "next").select("x", "label"), "labels")
