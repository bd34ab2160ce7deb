"""Connected components, conflicts in them, and the edges that bridge conflicting nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) with the smallest node as the component's name; links (a, b) are undirected.

    Labels fall along links and then jump to their label's label, so long chains need few rounds.
    """
    pairs = links.select("a", "b").where("a is not null and b is not null")
    both = stored(pairs.union(pairs.select("b", "a")).distinct(), "links")
    label = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("component")), "labels")
    while True:
        near = both.join(label, both.b == label.node).groupBy("a").agg(F.min("component").alias("low"))
        new = label.join(near, label.node == near.a, "left").select("node", F.least("component", "low").alias("component"), F.col("component").alias("old"))
        jump = new.select(F.col("node").alias("component"), F.col("component").alias("far"))
        new = stored(new.join(jump, "component", "left").select("node", F.least("component", "far").alias("component"), "old"), "labels")
        changed = not new.where("component <> old").limit(1).isEmpty()
        label = new.select("node", "component")
        if not changed:
            return label


def conflicts(labels: DataFrame, vocab: str = "vocab") -> DataFrame:
    """(component, vocab, codes): components that hold two or more nodes of a vocabulary."""
    return labels.groupBy("component", vocab).agg(F.count_distinct("node").alias("codes")).where("codes >= 2")


def sampled_pairs(labels: DataFrame, most: int = 20, vocab: str = "vocab", seed: str = "24") -> DataFrame:
    """(component, vocab, s, t): of each conflict's node pairs ``most`` at a seeded hash order (a sampling operator).

    Members are ranked by hash and each is paired with the next few only, so a large conflict makes no quadratic number of pairs.
    """
    order = Window.partitionBy("component", vocab).orderBy(F.md5(F.concat(F.lit(seed), F.col("node").cast("string"))), "node")
    ranked = labels.select("component", vocab, "node").distinct().withColumn("k", F.row_number().over(order)).where(F.col("k") <= most + 1)
    other = ranked.select("component", vocab, F.col("node").alias("t"), F.col("k").alias("j"))
    pairs = ranked.join(other, ["component", vocab]).where("k < j")
    first = Window.partitionBy("component", vocab).orderBy("k", "j")
    return pairs.withColumn("i", F.row_number().over(first)).where(F.col("i") <= most).select("component", vocab, F.least("node", "t").alias("s"), F.greatest("node", "t").alias("t"))


def bridges(links: DataFrame, pairs: DataFrame, hops: int = 12) -> DataFrame:
    """(a, b, paths): how many of the pairs' shortest paths use a link; ties go to the smallest parent."""
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    goals = stored(pairs.select("s", "t").distinct(), "pairs")
    front = stored(goals.select("s").distinct().select("s", F.col("s").alias("node")), "front")
    tree = front.withColumn("parent", F.lit(None).cast(front.schema["node"].dataType))
    for _ in range(hops):
        near = front.join(both, front.node == both.a).groupBy("s", F.col("b").alias("node")).agg(F.min("a").alias("parent"))
        near = stored(near.join(tree, ["s", "node"], "left_anti"), "tree")
        if near.isEmpty():
            break
        tree, front = tree.union(near), near.select("s", "node")
    tree = stored(tree, "tree")
    at, used = goals.select("s", "t", F.col("t").alias("node")), None
    while True:
        up = stored(at.join(tree, ["s", "node"]).where("parent is not null").select("s", "t", "node", "parent"), "path")
        if up.isEmpty():
            break
        used = up if used is None else used.union(up)
        at = up.select("s", "t", F.col("parent").alias("node"))
    if used is None:
        return goals.select(F.col("s").alias("a"), F.col("t").alias("b"), F.lit(0).cast("long").alias("paths")).limit(0)
    return used.groupBy(F.least("node", "parent").alias("a"), F.greatest("node", "parent").alias("b")).agg(F.count(F.lit(1)).alias("paths"))


def outside_main(nodes: DataFrame, links: DataFrame, vocab: str = "vocab") -> DataFrame:
    """(vocab, nodes, outside): how many nodes of each vocabulary, and how many of them outside the main component.

    ``nodes``: node, vocab; ``links``: a, b. A node without links is a component of its own. The main component has the most nodes, of
    several such the one with the smallest name. A vocabulary that is null counts as one.
    """
    named = nodes.select("node", vocab).join(components(links), "node", "left").select("node", vocab, F.coalesce("component", "node").alias("component"))
    named = stored(named, "named")
    main = named.groupBy("component").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "component").limit(1).select("component", F.lit(1).alias("main"))
    held = named.join(F.broadcast(main), "component", "left")  # one row
    return held.groupBy(vocab).agg(F.count(F.lit(1)).alias("nodes"), F.count_if(F.col("main").isNull()).alias("outside"))


def reach_outside(nodes: DataFrame, links: DataFrame, vocab: str = "vocab") -> DataFrame:
    """(vocab, nodes, linked, share): how many nodes of each vocabulary have a link to a node of another one."""
    of = lambda c: nodes.select(F.col("node").alias(c), F.col(vocab).alias(f"{c}_vocab"))
    far = links.select("a", "b").join(of("a"), "a").join(of("b"), "b").where("a_vocab <> b_vocab")
    far = far.select(F.col("a").alias("node")).union(far.select("b")).distinct().withColumn("far", F.lit(1))
    counted = nodes.select("node", vocab).join(far, "node", "left").groupBy(vocab).agg(F.count(F.lit(1)).alias("nodes"), F.count("far").alias("linked"))
    return counted.withColumn("share", F.round(F.col("linked") / F.col("nodes"), 3))
