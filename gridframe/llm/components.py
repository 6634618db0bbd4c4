"""Connected components of a graph too large for one machine, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridframe.operators.extent import checkpoint_once

# Rows that one task of a round stores, at most; a round has no more tasks than its rows need.
TASK_ROWS = 250_000
# Hooks are broadcast, at 16 bytes each, up to this many; more are joined by shuffling.
SENT_HOOKS = 100_000


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (``a``, ``b`` long); a component is its smallest node.

    Each round hooks every node to its smallest neighbour, if that is smaller,
    flattens the hooks by pointer jumping and contracts the links to the roots,
    until no link is left. Minima are combined before they are shuffled, and no
    neighbour list is ever gathered, so a node with very many links is spread.
    Links of a node to itself name it; links with a null are ignored. Every
    round is checkpointed, so a lost executor costs no more than a round. Links
    get fewer with every round, and so do the tasks and files that hold them.
    """
    links = links.select(F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b")).dropna()
    links = checkpoint_once(links.distinct())
    count = links.count()
    # Each link has two ends, so this bounds the nodes.
    nodes = 2 * count
    links = links.coalesce(_tasks(count))
    ends = links.select("a").union(links.select(F.col("b"))).distinct()
    result = _stored(ends.select(F.col("a").alias("node"), F.col("a").alias("component")), nodes)
    links = links.filter("a <> b")
    while not links.isEmpty():
        both = links.union(links.select(F.col("b"), F.col("a")))
        hooks = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("root"))
        hooks = _flattened(_stored(hooks, 2 * count), 2 * count)
        result = _stored(_moved(result, "component", hooks, 2 * count), nodes)
        links = _moved(_moved(links, "a", hooks, 2 * count), "b", hooks, 2 * count).filter("a <> b")
        links = _stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), count)
        count = links.count()
    return result


def _tasks(rows: int) -> int:
    return max(1, -(-rows // TASK_ROWS))


def _stored(df: DataFrame, rows: int) -> DataFrame:
    """``df``, which has at most ``rows`` rows, computed once."""
    return checkpoint_once(df.coalesce(_tasks(rows)))


def _moved(df: DataFrame, column: str, hooks: DataFrame, rows: int) -> DataFrame:
    """``df`` with each node in ``column`` replaced by its root; there are at most ``rows`` hooks."""
    by = hooks.select(F.col("node").alias("__node"), F.col("root").alias("__root"))
    by = F.broadcast(by) if rows <= SENT_HOOKS else by
    joined = df.join(by, F.col(column) == F.col("__node"), "left")
    return joined.withColumn(column, F.coalesce("__root", column)).drop("__node", "__root")


def _flattened(hooks: DataFrame, rows: int) -> DataFrame:
    """Hooks, at most ``rows`` of them, that all point to roots."""
    while True:
        jumped = _stored(_moved(hooks.withColumn("was", F.col("root")), "root", hooks, rows), rows)
        if jumped.filter("root <> was").isEmpty():
            return jumped.drop("was")
        hooks = jumped.drop("was")
