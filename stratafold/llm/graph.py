"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stratafold.workspace import materialise


def _contracted(edges: DataFrame) -> list[DataFrame]:
    """Tables (node, pick), one per round, that map the nodes of each round to those of the next.

    In a round every node goes over to the node of the smallest hash among itself and its
    neighbours, under a hash of the round's own, and links are drawn between what was picked.
    """
    rounds: list[DataFrame] = []
    while True:
        seen = Observation()
        edges = materialise(edges, "component-links", seen, [F.count("*").alias("links")])
        if not seen.get["links"]:
            return rounds
        number = F.lit(len(rounds))

        def drawn(node: Column) -> Column:
            return F.struct(F.xxhash64(node, number).alias("hash"), node.alias("pick"))

        best = F.least(drawn(F.col("node")), F.min(drawn(F.col("near"))))
        picks = materialise(edges.groupBy("node").agg(best.alias("best")).select("node", "best.pick"), "component-picks")
        rounds.append(picks)
        ends = edges.join(picks.withColumnRenamed("pick", "left"), "node").join(
            picks.select(F.col("node").alias("near"), F.col("pick").alias("right")), "near"
        )
        edges = ends.filter("left <> right").select(F.col("left").alias("node"), F.col("right").alias("near")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every end of a link (a, b); a component is named by its smallest node.

    Links are contracted at random: of the nodes that still have links, a quarter at least is
    expected to go in each round, whatever the graph and its numbering (a chain loses about
    half).  So the rounds grow with the logarithm of the nodes, and each works on what the one
    before has left.  Rounds are written to the shared folder: a lost executor costs one round
    at most.  Links are undirected, may repeat or join a node to itself; a link with a NULL end
    is none.
    """
    pairs = links.filter(F.col("a").isNotNull() & F.col("b").isNotNull())
    both = pairs.select(F.col("a").alias("node"), F.col("b").alias("near")).unionByName(
        pairs.select(F.col("b").alias("node"), F.col("a").alias("near"))
    )
    both = materialise(both.distinct(), "component-links")
    rounds = _contracted(both.filter("node <> near"))
    # From the last round back: where a node's pick went in the rounds after it.
    names = None
    for picks in reversed(rounds):
        if names is not None:
            later = names.select(F.col("node").alias("pick"), F.col("name").alias("later"))
            picks = picks.join(later, "pick", "left").select("node", F.coalesce("later", "pick").alias("pick"))
        names = materialise(picks.withColumnRenamed("pick", "name"), "component-names")
    alone = both.filter("node = near").select("node", F.col("near").alias("name"))
    if names is None:
        return alone.select("node", F.col("name").alias("component"))
    named = names.unionByName(alone.join(names, "node", "left_anti"))
    lowest = named.groupBy("name").agg(F.min("node").alias("component"))
    return materialise(named.join(materialise(lowest, "component-lowest"), "name").select("node", "component"), "components")
