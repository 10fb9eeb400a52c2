"""Connected components of a distributed graph by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrove.llm.tables import checkpointed


def _to_lowest(pairs: DataFrame, node: str, other: str) -> DataFrame:
    """Each pair with the lowest id seen from ``node``, itself included.

    The lowest ids are cut off as a table of their own, so the join is one of two plain shuffles and
    Spark can split a node with very many neighbours at run time.
    """
    lowest = pairs.groupBy(node).agg(F.min(other).alias("_lowest"))
    lowest = checkpointed(lowest.select(node, F.least(node, "_lowest").alias("_lowest")))
    return pairs.join(lowest, node)


def star_forest(edges: DataFrame, first: str, second: str) -> DataFrame:
    """(node, root) for every node of ``edges`` that is not the lowest of its component.

    Ids are of one ordered type. Every round links each node to the lowest of its neighbours; the
    number of rounds grows with the logarithm of the longest path. Empty edges give an empty table;
    loops, nulls and repeated edges are ignored.
    """
    pairs = (
        edges.filter(F.col(first) != F.col(second))
        .select(F.greatest(first, second).alias("node"), F.least(first, second).alias("root"))
        .distinct()
    )
    pairs, before = checkpointed(pairs), None
    while True:
        state = pairs.agg(
            F.count("*"),
            F.bit_xor(F.xxhash64("node", "root")),
            F.bit_xor(F.xxhash64("root", "node")),
        ).first()
        if state == before or state[0] == 0:
            return pairs
        before = state
        both = pairs.unionAll(pairs.select(F.col("root").alias("node"), F.col("node").alias("root")))
        large = (
            _to_lowest(both, "node", "root")
            .filter(F.col("root") > F.col("node"))
            .select(F.col("root").alias("node"), F.col("_lowest").alias("root"))
            .distinct()
        )
        small = _to_lowest(checkpointed(large), "node", "root")
        links = F.array(
            F.struct(F.col("node").alias("node"), F.col("_lowest").alias("root")),
            F.struct(F.col("root").alias("node"), F.col("_lowest").alias("root")),
        )
        pairs = small.select(F.inline(links)).filter(F.col("node") != F.col("root")).distinct()
        pairs = checkpointed(pairs)
