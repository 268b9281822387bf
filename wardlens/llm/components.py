"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.llm.common import Workspace


def connected_components(edges: DataFrame, work: Workspace, name: str = "cc") -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest
    node that can be reached.

    Every round hooks each node to its smallest neighbour, if that is smaller,
    and rewrites the edges to the hooked nodes; an edge inside one node goes.
    Nodes that are not a local minimum vanish from the edges, so the table
    shrinks every round. The hooks are then followed back from the last round
    to the first. A hub with many edges is pre-aggregated by the ``min`` and is
    a plain key of both written join sides, which adaptive execution can split.
    """
    spark = work.spark
    live = work.keep(edges.where("a <> b").select(F.least("a", "b").alias("a"),
                                                  F.greatest("a", "b").alias("b")).distinct(),
                     f"{name}-edges-0")
    hooks: list[DataFrame] = []
    turn = 0
    while not live.isEmpty():
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = work.keep(both.groupBy(F.col("a").alias("node"))
                         .agg(F.least(F.min("b"), F.min("a")).alias("up")),
                         f"{name}-hooks-{turn}")
        hooks.append(hook)
        moved = (live.join(hook.select(F.col("node").alias("a"), F.col("up").alias("ua")), "a")
                 .join(hook.select(F.col("node").alias("b"), F.col("up").alias("ub")), "b")
                 .where("ua <> ub")
                 .select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b"))
                 .distinct())
        turn += 1
        live = work.keep(moved, f"{name}-edges-{turn}")
        work.discard(f"{name}-edges-{turn - 1}")
    roots = None
    for turn in range(len(hooks) - 1, -1, -1):
        hook = hooks[turn]
        if roots is None:
            roots = hook.select("node", F.col("up").alias("root"))
            continue
        above = roots.select(F.col("node").alias("up"), F.col("root"))
        roots = work.keep(hook.join(above, "up", "left")
                          .select("node", F.coalesce("root", "up").alias("root")),
                          f"{name}-roots-{turn}")
    if roots is None:
        return spark.createDataFrame([], "node long, root long")
    return roots
